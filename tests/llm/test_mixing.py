import numpy as np
import pytest

from llm_cases import SF_MID, empty, odd  # noqa: F401
from txnscope.llm import mixing


def brute_targets(sizes):
    """Round by round: share by weight, stop at 3 times, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: mixing.CYCLE[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        if not open_:
            return fixed
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: unit * weight[s] for s in open_}
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 5, "c": 70, "d": 1, "e": 900},
    {"a": 10, None: 5}, {"x": 7}, {"a": 0, "b": 10}, {"é": 4, "z": 400, "A": 3, "zz": 2}])
def test_targets(spark, sizes):
    rows = [(s, 1 + 0 * n) for s, n in sizes.items() for _ in range(n)] + [(s, 0) for s in sizes]
    df = spark.createDataFrame(rows, "_mix_source string, _mix_size long")
    got = {r["_mix_source"]: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(0)
    weight = np.array([5.0, 3, 8, 1, 1, 2, 13])
    start = np.array([0.3, 0.7, 0.5, 0.2, 1.0, 0.0, 0.9])
    seen = np.zeros(len(start))
    for _ in range(20_000):
        p = start.copy()
        left = mixing.pivot(weight, p, rng.random(len(p)))
        assert abs((weight * p).sum() - (weight * start).sum()) < 1e-9
        closed = np.delete(p, left) if left >= 0 else p
        assert np.isin(closed, (0.0, 1.0)).all() and ((p >= 0) & (p <= 1)).all()
        seen += p
    assert np.abs(seen / 20_000 - start).max() < 0.02


def test_mix_of_the_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)      # several buckets and tree levels
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    got = mixing.op4_pivotal_mix(spark, SF_MID).toPandas()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    both = got.merge(docs[["doc_id", "source", "text"]], on="doc_id")
    import re
    words = both.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert (words == both["size"]).all()
    sizes = both.groupby("source")["size"].sum()
    want = brute_targets(sizes.to_dict())
    for s, g in both.groupby("source"):
        assert (g.source_size == sizes[s]).all() and abs(g.target.iloc[0] - want[s]) < 1e-6 * want[s]
        assert abs(g.taken.sum() - want[s]) <= g["size"].max()
    assert (both.taken <= 3 * both["size"]).all()
    assert (both.taken % both["size"].clip(lower=1) == 0).all()
    again = mixing.op4_pivotal_mix(spark, SF_MID).toPandas()
    assert (got.sort_values("doc_id").taken.to_numpy()
            == again.sort_values("doc_id").taken.to_numpy()).all()


def test_odd_rows(spark, odd, empty):
    got = mixing.mix(odd)
    assert got.columns[:len(odd.columns)] == odd.columns
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r["_mix_copies"] <= 3 for r in rows)
    assert {r["_mix_size"] for r in rows if not (r.text or "").strip()} == {0}
    mixed = mixing.mixed_rows(odd)
    assert mixed.dtypes == odd.dtypes
    assert mixed.count() == sum(r["_mix_copies"] for r in rows)
    assert mixing.mixed_rows(empty).count() == 0
