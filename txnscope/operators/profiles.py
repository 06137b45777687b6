"""Behaviour profiles per (age group, state, device) cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, ratio

KEYS = ("sender_age_group", "sender_state", "device_type")


def user_profiles(df: DataFrame) -> DataFrame:
    """Cohort profile and risk score.

    Statistics are rounded half-to-even to 2 places before the derived metrics
    (as NumPy rounding does). ``active_days`` is the floor of the elapsed time
    between the first and last transaction in days (not a date difference).
    With ``active_days = 0`` the daily rate is +infinity and its clipped score
    term is 1. Cohorts with a NULL key are dropped (grouping semantics of the
    original, D10). ``preferred_type`` is the most frequent type, the smallest
    on ties.
    """
    keyed = df.where(F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
                     & F.col(KEYS[2]).isNotNull())
    a = F.col("amount_inr").cast("double")
    span_us = F.timestamp_diff("MICROSECOND", F.min("timestamp"), F.max("timestamp"))
    g = keyed.groupBy(*KEYS).agg(
        F.bround(F.avg(a), 2).alias("avg_amount"),
        F.bround(F.stddev_samp(a), 2).alias("std_amount"),
        F.count("amount_inr").alias("txn_count"),
        F.max("amount_inr").alias("max_amount"),
        F.mode("transaction_type", deterministic=True).alias("preferred_type"),
        F.countDistinct("merchant_category").alias("merchant_diversity"),
        F.sum("fraud_flag").cast("bigint").alias("fraud_count"),
        F.floor(span_us / F.lit(86_400_000_000)).cast("bigint").alias("active_days"))
    fraud_rate = ratio("fraud_count", "txn_count")
    daily = F.when(F.col("active_days") == 0, F.lit(float("inf"))).otherwise(
        F.col("txn_count") / F.col("active_days"))
    daily_term = F.when(F.col("active_days") == 0, F.lit(1.0)).otherwise(clip(daily / 10, 0, 1))
    # max/avg: a zero average gives +inf (clipped to 5) or NaN (stays NULL)
    peak = F.when(F.col("avg_amount") == 0,
                  F.when(F.col("max_amount") > 0, F.lit(5.0))).otherwise(
        clip(F.col("max_amount") / F.col("avg_amount"), 0, 5))
    return g.select("*", fraud_rate.alias("fraud_rate"), daily.alias("daily_avg_txns"),
                    (fraud_rate * 0.4 + peak * 0.3 + daily_term * 0.3).alias("risk_score"))
