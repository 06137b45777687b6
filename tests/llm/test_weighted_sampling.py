import hashlib
from collections import Counter

import numpy as np

from llm_cases import SCHEMA, SF_SMALL, empty, odd, prose  # noqa: F401
from txnscope.llm import weighted_sampling as W


def likeness(a, b):
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    words = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in words) / max(1, sum(max(x[w], y[w]) for w in words))


def edits(rows):
    """Brute force: (id, text, edited, next text), descending id."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        yield i, t, t[:len(t) - half] + following[:half], following


def check(rows, got):
    got = {r.doc_id: r for r in got}
    errors, prints = [], {}
    assert len(got) == len(rows)
    for i, text, edited, following in edits(rows):
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        same = [r.fingerprint[k:k + 8] == r.edited_fingerprint[k:k + 8]
                for k in range(0, len(r.fingerprint), 8)]
        assert np.mean(same) == r.near_edited
        errors += [r.near_edited - likeness(text, edited), r.near_next - likeness(text, following)]
    return np.array(errors)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    errors = check(rows, W.op2_weighted_sampling(spark, SF_SMALL).collect())
    assert abs(errors.mean()) < 0.03 and errors.std() < 0.11


def test_collisions_equal_generalised_jaccard(spark):
    a, b = prose(1, 60), prose(2, 60)
    texts = [" ".join([a] * 3 + [b]), " ".join([a] + [b] * 2)]
    # many pairs of the same weights, under different words
    rows = [(2 * k + j, " ".join(f"{w}{k}" for w in t.split()), "en", "s", 0)
            for k in range(60) for j, t in enumerate(texts)]
    got = {r.doc_id: r for r in W.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    seen = [got[2 * k + 1].near_next for k in range(60)]
    assert abs(np.mean(seen) - likeness(*texts)) < 0.03


def test_many_ranges(spark):
    rows = [(7 * i - 50, prose(i % 5, 1 + i % 9)) for i in range(60)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    check(rows, W.fingerprints(df).collect())
    check(rows[:1], W.fingerprints(df.where(f"doc_id = {rows[0][0]}")).collect())


def test_odd_rows(spark, odd, empty):  # noqa: F811
    got = W.fingerprints(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[2].fingerprint == by[3].fingerprint == by[4].fingerprint
    assert by[1].fingerprint == by[6].fingerprint
    assert by[2].n_chars == 0 and by[4].n_chars == 5
    assert W.fingerprints(empty).count() == 0


def test_plan_runs_no_python(spark):
    plan = W.op2_weighted_sampling(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
