"""Data profiling: the aggregates behind the exploratory report.

Plots are not drawn; each function returns the data a chart would show. All
are single-pass aggregations (partial aggregation before the shuffle), and
every per-column statistic of a wide table is computed in ONE job by building
the aggregate list programmatically instead of looping over columns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_side, with_scalars
from .quantiles import exact_quantiles

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _stack(df: DataFrame, names: list[str], cols_per: list[list[str]], out: list[str]) -> DataFrame:
    """Turn one wide row into one row per column name (long form)."""
    parts = []
    for name, cols in zip(names, cols_per):
        parts.append(f"'{name}'")
        parts += [f"`{c}`" for c in cols]
    return df.selectExpr(f"stack({len(names)}, {', '.join(parts)}) AS ({', '.join(out)})")


def schema_info(df: DataFrame) -> DataFrame:
    """Column name, Spark type and non-null count per column (``df.info()``)."""
    aggs = [F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs).select(*[F.col(f"nn_{i}") for i in range(len(df.columns))],
                               *[F.lit(t).alias(f"ty_{i}") for i, (_, t) in enumerate(df.dtypes)])
    return _stack(one, df.columns, [[f"ty_{i}", f"nn_{i}"] for i in range(len(df.columns))],
                  ["column_name", "data_type", "non_null_count"])


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass (``isnull().sum()``)."""
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    return _stack(one, df.columns, [[f"n_{i}"] for i in range(len(df.columns))],
                  ["column_name", "null_count"])


def drop_nulls(df: DataFrame) -> DataFrame:
    """Drop rows holding any null (``dropna()``)."""
    return df.dropna(how="any")


def head_n(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in an explicit order (Spark keeps no file order), e.g. the
    preview of a loaded file or a first-rows scoring batch. Planned as a
    top-k (TakeOrderedAndProject): each task keeps n rows, so no full sort."""
    return df.orderBy(*(order or [df.columns[0]])).limit(n)


def shape_report(df: DataFrame, sub: DataFrame | None = None) -> DataFrame:
    """Row and column counts of a frame (and of an optional sub-frame)."""
    rows = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("full").alias("frame"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
    if sub is not None:
        rows = rows.unionByName(sub.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit("sub").alias("frame"), "n_rows", F.lit(len(sub.columns)).alias("n_columns")))
    return rows


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max per numeric column (``describe()``).

    Quantiles are exact with linear interpolation, as pandas computes them, at every
    size (``quantiles.exact_quantiles``); ``summary()`` is approximate and is not used.
    """
    cols = columns or [c for c, t in df.dtypes if t in NUMERIC]
    found = exact_quantiles(df, {c: F.col(f"`{c}`") for c in cols}, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    at = [found[None, c].at if (None, c) in found else (None, None, None) for c in cols]
    one = df.agg(*aggs).select("*", *[
        F.lit(v).cast("double").alias(f"{name}_{i}") for i, three in enumerate(at)
        for name, v in zip(("p25", "p50", "p75"), three)])
    return _stack(one, cols, [[f"c{i}", f"m{i}", f"s{i}", f"lo{i}", f"p25_{i}", f"p50_{i}",
                               f"p75_{i}", f"hi{i}"] for i in range(len(cols))],
                  ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def temporal_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour, weekday name and month name columns."""
    return df.withColumns({"transaction_hour": F.hour(ts),
                           "day_of_week": F.date_format(ts, "EEEE"),
                           "transaction_month": F.date_format(ts, "MMMM")})


def amount_histogram(df: DataFrame, col: str = "amount_inr", bins: int = 100) -> DataFrame:
    """Equal-width histogram between min and max; the last bin is closed.

    min/max come from a one-row aggregate attached by broadcast.
    """
    stats = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    x = F.col(col).cast("double")
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1))).cast("int")
    return (with_scalars(df.where(F.col(col).isNotNull()).select(col), stats)
            .groupBy(idx.alias("bin"), F.col("_lo"), width.alias("_w"))
            .agg(F.count(F.lit(1)).alias("frequency"))
            .select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
                    "frequency"))


def amount_kde(df: DataFrame, col: str = "amount_inr", gridsize: int = 200, cut: float = 0.0,
               bins: int = 100) -> DataFrame:
    """Gaussian kernel density of ``col`` on an even grid (Scott bandwidth).

    bandwidth = n^(-1/5) * sample std; the grid spans [min - cut*bw, max + cut*bw].
    The input is first reduced to (distinct value, multiplicity), then each
    distinct value adds its kernel to every grid point: work is O(distinct *
    gridsize) with partial aggregation on the grid index, exact (no binning).
    ``scaled_count`` rescales the density to histogram counts (n * bin width).
    """
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    stats = x.agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("x").alias("_sd"),
                  F.min("x").alias("_lo"), F.max("x").alias("_hi")).select(
        "*", (F.pow(F.col("_n"), -0.2) * F.col("_sd")).alias("_bw"))
    stats = stats.select("*", (F.col("_lo") - F.col("_bw") * cut).alias("_g0"),
                         (F.col("_hi") + F.col("_bw") * cut).alias("_g1"))
    values = x.groupBy("x").agg(F.count(F.lit(1)).alias("m"))
    g = F.col("_g0") + (F.col("_g1") - F.col("_g0")) * F.col("gi") / (gridsize - 1)
    z = (g - F.col("x")) / F.col("_bw")
    return (with_scalars(values, stats)
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("gi"))
            .groupBy("gi", g.alias("grid_x"), "_n", "_bw", "_lo", "_hi")
            .agg(F.sum(F.col("m") * F.exp(-0.5 * z * z)).alias("_k"))
            .select(F.col("gi").alias("grid_index"), "grid_x",
                    (F.col("_k") / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi)))
                    .alias("density"), "_n", "_lo", "_hi")
            .select("grid_index", "grid_x", "density",
                    (F.col("density") * F.col("_n") * (F.col("_hi") - F.col("_lo")) / bins)
                    .alias("scaled_count")))


#: Binned density: error allowed, as a share of the kernel's peak; most bins.
KDE_TOLERANCE, KDE_MOST_BINS = 1e-5, 1 << 20


def amount_kde_binned(df: DataFrame, col: str = "amount_inr", gridsize: int = 200,
                      tolerance: float = KDE_TOLERANCE) -> DataFrame:
    """The density of ``amount_kde`` from values dealt to an even fine grid, whose work does
    not depend on the number of distinct values.

    Each value gives its weight to the two grid points around it, in proportion (one
    aggregation); then kernels of the grid points with weight are summed. Linear binning
    at a step d errs by at most d^2 / 8 times the kernel's largest second derivative, that
    is (d / bandwidth)^2 / 8 of the kernel's peak 1 / (bandwidth sqrt(2 pi)); the step is
    chosen so that this stays below ``tolerance``."""
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    one = x.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if not one["n"] or not one["sd"]:
        return (df.sparkSession.createDataFrame([], "grid_index INT, grid_x DOUBLE, density DOUBLE, "
                                                "max_error DOUBLE"))
    n, lo, hi = one["n"], one["lo"], one["hi"]
    bw = n ** -0.2 * one["sd"]
    steps = min(KDE_MOST_BINS, math.ceil((hi - lo) / (bw * math.sqrt(8 * tolerance))))
    d = (hi - lo) / steps
    place = F.least(F.floor((F.col("x") - lo) / d), F.lit(steps - 1))
    part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("x") - lo) / d - F.col("k")))
    weights = (x.withColumn("k", place).groupBy("k")
               .agg(F.sum(1.0 - part).alias("here"), F.sum(part).alias("next"))
               .select(F.inline(F.array(F.struct("k", F.col("here").alias("w")),
                                        F.struct((F.col("k") + 1).alias("k"), F.col("next").alias("w")))))
               .groupBy("k").agg(F.sum("w").alias("w")))
    at = F.lit(lo) + (hi - lo) * F.col("gi") / (gridsize - 1)
    z = (at - (F.lit(lo) + F.col("k") * d)) / bw
    peak = 1.0 / (bw * math.sqrt(2 * math.pi))
    return (weights.select("k", "w", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("gi"))
            .groupBy("gi").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
            .select(F.col("gi").alias("grid_index"), at.alias("grid_x"),
                    (F.col("s") * (peak / n)).alias("density"),
                    F.lit((d / bw) ** 2 / 8 * peak).alias("max_error")))


def fraud_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("fraud_flag").agg(F.count(F.lit(1)).alias("n_transactions"))


def hourly_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("transaction_hour")).agg(
        F.count(F.lit(1)).alias("n_transactions"))


def hourly_fraud_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("transaction_hour"), "fraud_flag").agg(
        F.count(F.lit(1)).alias("n_transactions"))


def device_fraud_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("device_type", "fraud_flag").agg(F.count(F.lit(1)).alias("n_transactions"))


def amount_boxstats_by_fraud(df: DataFrame, col: str = "amount_inr",
                             by: str = "fraud_flag") -> DataFrame:
    """Box-plot statistics per group: quartiles, 1.5*IQR whiskers (most extreme
    points inside the fences) and the number of points outside them.

    Pass 1: exact quartiles per group. Pass 2 finds whiskers and outliers; the
    per-group figures (one row per group value) go to every task as a checked
    broadcast, so the rows are not shuffled on the few group values.
    """
    x = F.col(col).cast("double")
    found = exact_quantiles(df, {"x": x}, [0.25, 0.5, 0.75], by=by)
    key = df.schema[by].dataType.simpleString()
    q = df.sparkSession.createDataFrame(
        [(g, *d.at) for (g, _), d in found.items()],
        f"`{by}` {key}, q1 DOUBLE, median DOUBLE, q3 DOUBLE")
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"_lo_fence": F.col("q1") - 1.5 * F.col("iqr"),
                       "_hi_fence": F.col("q3") + 1.5 * F.col("iqr")})
    joined = df.select(by, x.alias("_x")).where(F.col("_x").isNotNull()).join(bounded_side(q), by)
    inside = (F.col("_x") >= F.col("_lo_fence")) & (F.col("_x") <= F.col("_hi_fence"))
    return (joined.groupBy(by, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n")))
