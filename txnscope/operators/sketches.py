"""Distinct counts over look-backs from stored daily sketches.

An exact distinct count over 365 days reads 365 days of payments, and again for every
other period. Here each day's values are kept as one mergeable sketch (HLL) per group, in
a table partitioned by day; any look-back merges the sketches of its days, so it reads one
small row per day and group. The exact counts of the reports stay as they are: this is the
cheap option beside them, with a stated error.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two.
LG_K = 12


def relative_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Relative error that an estimate exceeds only beyond so many standard errors."""
    return sigmas * 1.04 / math.sqrt(2 ** lg_k)


def daily_sketches(t: DataFrame, value: Column, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """(day, group columns, sketch) of the distinct values of ``value``, null left out.
    Partial sketches are merged, so no values are shuffled."""
    return (t.withColumns({"day": F.to_date("timestamp"), "_v": value.cast("string")})
            .where("_v IS NOT NULL").groupBy("day", *by)
            .agg(F.hll_sketch_agg("_v", lg_k).alias("sketch")))


def store_days(sketches: DataFrame, path: str) -> None:
    """Write the days of ``sketches``, replacing what is stored of those days only."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def lookback_counts(spark: SparkSession, path: str, as_of: dt.datetime, days: list[int],
                    by: list[str]) -> DataFrame:
    """(lookback_days, group columns, estimate, days_read) of each look-back of whole days
    that ends before ``as_of``'s day. Other days' folders are not read."""
    until = as_of.date()
    stored = spark.read.parquet(path).where(
        (F.col("day") < F.lit(until)) & (F.col("day") >= F.lit(until - dt.timedelta(days=max(days)))))
    age = F.datediff(F.lit(until), F.col("day"))
    spans = F.filter(F.lit(sorted(days)).cast("array<int>"), lambda d: age <= d)
    return (stored.select("day", *by, "sketch", F.explode(spans).alias("lookback_days"))
            .groupBy("lookback_days", *by)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
                 F.count_distinct("day").alias("days_read")))
