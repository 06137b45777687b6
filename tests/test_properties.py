"""Property tests (hypothesis) for the column helpers against pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnscope.functions.columns import clip, cut_right_closed
from txnscope.sources.intake import normalise_name

BINS = (0.0, 0.2, 0.5, 0.8, 1.0)
LABELS = ("Low", "Medium", "High", "Critical")
values = st.lists(st.one_of(st.sampled_from(list(BINS) + [-0.0, 1.0000001, 0.1999999]),
                            st.floats(-0.5, 1.5, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(values)
def test_cut_equals_pandas(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x DOUBLE")
    got = [r[0] for r in df.select(cut_right_closed(F.col("x"), BINS, LABELS)).collect()]
    want = pd.cut(pd.Series(xs, dtype=float), bins=list(BINS), labels=list(LABELS))
    assert got == [None if pd.isna(w) else str(w) for w in want]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-10, 10, allow_nan=False), st.just(math.nan)),
                min_size=1, max_size=30))
def test_clip_equals_pandas(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE")
    got = [r[0] for r in df.select(clip(F.col("x"), 0, 5)).collect()]
    want = pd.Series(xs, dtype=float).clip(0, 5)
    for g, w in zip(got, want):
        assert (g is None and pd.isna(w)) or g == w


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=20))
def test_normalise_name_rule(name):
    out = normalise_name(name)
    assert out == out.strip("_")
    assert all(c.isascii() and (c.isalnum() or c == "_") for c in out)
    assert normalise_name(out) == out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=60),
       st.integers(1, 3))
def test_exact_quantiles_match_numpy(spark, values, groups):
    from pyspark.sql import functions as F
    from txnscope.operators.quantiles import exact_quantiles
    rows = [(i % groups, v, None if v is None else v * v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k INT, x DOUBLE, y DOUBLE")
    wanted = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, wanted, by="k")
    for k in range(groups):
        for name, at in (("x", 1), ("y", 2)):
            own = [r[at] for r in rows if r[0] == k and r[at] is not None]
            if not own:
                assert (k, name) not in got
                continue
            d = got[k, name]
            assert (d.n, d.low, d.high) == (len(own), min(own), max(own))
            assert np.allclose(d.at, np.quantile(own, wanted), atol=1e-9)


@pytest.mark.parametrize("few", [3, 5_000])
def test_quantiles_of_ties_and_extremes(spark, monkeypatch, few):
    """Brackets that end in ties, hold few values, or must be narrowed or widened."""
    from txnscope.operators import quantiles
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(few)
    frames = {"ties": np.repeat([0.0, 1.0], 3000), "mixed": np.concatenate(
        [np.full(2000, 5.0), rng.normal(5, 1e-3, 3000), rng.exponential(1e6, 1000)]),
        "flat": np.full(6000, -2.5), "one": np.concatenate([[1e9], np.zeros(5999)])}
    df = spark.createDataFrame([tuple(float(v[i]) for v in frames.values()) for i in range(6000)],
                               ", ".join(f"{c} DOUBLE" for c in frames)).withColumn(
        "k", (F.monotonically_increasing_id() % 2).cast("int")).checkpoint()
    wanted = [0.0, 0.25, 0.5, 0.75, 0.95, 0.9999, 1.0]
    got = quantiles.exact_quantiles(df, {c: F.col(c) for c in frames}, wanted)
    for c, v in frames.items():
        np.testing.assert_allclose(got[None, c].at, np.quantile(v, wanted), rtol=1e-12)
    rows = df.toPandas()
    got = quantiles.exact_quantiles(df, {c: F.col(c) for c in frames}, wanted, by="k")
    for k, g in rows.groupby("k"):
        for c in frames:
            np.testing.assert_allclose(got[k, c].at, np.quantile(g[c], wanted), rtol=1e-12)
