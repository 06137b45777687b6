import re
from collections import Counter

from llm_cases import SCHEMA, SF_MID, empty, odd, prose  # noqa: F401
from txnscope.llm import decontaminate as D

BENCHMARK = "item_id long, text string"


def shingles(words):
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(docs, items):
    """Best similarity of every item-sized window, edges cut, by exact shingle counts."""
    out = {}
    for i, text in docs:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for j, item in items:
            want = re.findall(r"[^\W_]+", (item or "").lower())
            n, s = len(want), shingles(want)
            for start in range(-n, len(words)):
                w = shingles(words[max(0, start):max(0, start + n)])
                total = sum(w.values()) + sum(s.values())
                if w and s:
                    out[i, j] = max(out.get((i, j), 0), 2 * sum((w & s).values()) / total)
    return {k: v for k, v in out.items() if v >= D.SIMILARITY}


def test_small_corpus_matches_brute_force(spark):
    items = [(k, prose(100 + k, n)) for k, n in enumerate((8, 20, 45, 3, 60))]
    items += [(5, items[1][1]), (6, None)]
    w = [t.split() for _, t in items[:5]]
    docs = [
        (1, prose(1, 30) + " " + items[1][1] + " " + prose(2, 30)),          # exact
        (2, prose(3, 50)),                                                   # clean
        (3, prose(4, 9) + " " + items[2][1].upper().replace(" ", ", ")),     # other case and marks
        (4, " ".join(w[4][:30] + ["changed"] + w[4][31:]) + " " + prose(5, 9)),
        (5, " ".join(w[2][:20])),                                            # too little of it
        (6, " ".join(w[4][8:])),                                             # cut at the edge
        (7, items[3][1]), (8, None), (9, items[0][1]),
        (10, " ".join(w[1] + w[1] + w[0])),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, BENCHMARK)
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(frame, bench).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and len(want) >= 8
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    kept = {r.doc_id for r in D.decontaminated(frame, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_documents_hold_the_planted_passages(spark):
    read = lambda t: spark.read.parquet(f"{SF_MID}/{t}.parquet")
    normal = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [(r.item_id, normal(r.text)) for r in read("benchmark").collect()]
    want = {(r.doc_id, i) for r in read("documents").collect()
            for i, t in items if t in normal(r.text)}
    got = {(r.doc_id, r.item_id) for r in D.op6_simhash_decontamination(spark, SF_MID).collect()}
    assert want and got >= want and len(got - want) <= 2


def test_fingerprints_within_the_radius_share_a_block():
    import random
    r = random.Random(5)
    size = D.BLOCKS * D.BLOCK_BITS
    for _ in range(500):
        a = r.getrandbits(size)
        b = a
        for bit in r.sample(range(size), D.RADIUS):
            b ^= 1 << bit
        low = (1 << D.BLOCK_BITS) - 1
        assert any((((a ^ b) >> (D.BLOCK_BITS * k)) & low).bit_count() <= D.BLOCK_RADIUS
                   for k in range(D.BLOCKS))


def test_edited_passages_just_above_the_bound_are_found(spark):
    """Items with words substituted until their similarity is 0.80 to 0.85."""
    import random
    r, items, docs, want = random.Random(11), [], [], set()
    for k in range(150):
        w = prose(1000 + k, 120).split()
        whole, edited, last = shingles(w), list(w), None
        for at in r.sample(range(len(w)), len(w)):
            trial = edited[:at] + [f"x{at}"] + edited[at + 1:]
            similar = sum((shingles(trial) & whole).values()) / sum(whole.values())
            if similar >= D.SIMILARITY:
                edited, last = trial, similar
        if last < 0.85:
            items.append((k, " ".join(w)))
            docs.append((k, f"{prose(5000 + k, 40)} {' '.join(edited)} {prose(9000 + k, 40)}",
                         "en", "s", 0))
            want.add((k, k))
    got = D.contaminated(spark.createDataFrame(docs, SCHEMA).repartition(8),
                         spark.createDataFrame(items, BENCHMARK)).select("doc_id", "item_id")
    found = {tuple(x) for x in got.collect()}
    assert len(want) >= 130 and len(want - found) <= 1


def test_odd_rows(spark, odd, empty):  # noqa: F811
    item = odd.where("doc_id = 1").first().text
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], BENCHMARK)
    assert {r.doc_id for r in D.contaminated(odd, bench).collect()} == {1, 6}
    kept = D.decontaminated(odd, bench)
    assert kept.dtypes == odd.dtypes and kept.count() == odd.count() - 2
    assert D.contaminated(empty, bench).count() == 0
    assert D.decontaminated(odd, spark.createDataFrame([], BENCHMARK)).count() == odd.count()


def test_plan_runs_no_python(spark):
    plan = D.op6_simhash_decontamination(spark, SF_MID)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
