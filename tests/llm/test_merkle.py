import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm_cases import SCHEMA, SF_SMALL, empty, odd  # noqa: F401
from txnscope.llm import merkle
from txnscope.llm.common import exact_columns


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text=None):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"],
              row["text"] if text is None else text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(digests):
    """(top, per leaf the sibling lists level by level)."""
    level, proofs, at = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % 3:p - p % 3 + 3]
            proofs[i].append((run[:p % 3], run[p % 3 + 1:]))
            at[i] = p // 3
        level = [H(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = []
    for s in names:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        tops.append(climb([leaf_of(r) for r in by[s]]))
    root, upper = climb([t for t, _ in tops])
    out = []
    for (top, proofs), above, s in zip(tops, upper, names):
        for r, proof in zip(by[s], proofs):
            steps = proof + above
            start = leaf_of(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 \
                    and r["text"] is not None:
                start = leaf_of(r, r["text"].replace("\n", ""))
            fold = start
            for left, right in steps:
                fold = H(*left, fold, *right)
            out.append((r["doc_id"], leaf_of(r), top, root,
                        H(*[x for left, right in steps for x in left + right]), fold,
                        fold == root))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("bound", [0, 2_000])
@pytest.mark.parametrize("shares", [(1,), (1, 1, 1, 1), (90, 9, 3, 1, 2, 27, 28, 4, 1, 1, 82)])
def test_manifest_against_brute_force(spark, monkeypatch, shares, bound):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", bound)
    rnd = random.Random(3)
    rows, names = [], [None, "é", "z", "a", "", "B", "\U0001f600", "￿", "q", "r", "s"]
    ids = rnd.sample(range(-50, 10_000), sum(shares))
    for name, n in zip(names, shares):
        rows += [(ids.pop(), rnd.choice(["a\nb", "plain é", None, ""]), "en", name, rnd.randrange(9))
                 for _ in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.checked_manifest(df)) == brute([r.asDict() for r in df.collect()])


def test_odd_rows(spark, odd, empty):
    rows = odd.withColumn("leaf", F.lit(1)).withColumn("TEXT2", F.lit(1))
    apart = rows.toDF(*[("Text" if c == "TEXT2" else c) for c in rows.columns])
    plain = exact_columns(apart, *merkle.FIELDS)
    want = brute([r.asDict() for r in plain.collect()])
    assert len(want) == odd.count() and got(merkle.checked_manifest(plain)) == want
    assert merkle.checked_manifest(empty.select(*merkle.FIELDS)).count() == 0


def test_changed_rows_fail_and_others_hold(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found = got(merkle.op13_merkle_manifest(spark, SF_SMALL))
    assert found == brute(rows)
    changed = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
               and "\n" in (r["text"] or "")}
    assert changed and {r[0] for r in found if not r[-1]} == changed
