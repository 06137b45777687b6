"""Fraud insight summary: overview, risky hours, amount and state patterns,
model summary and the pattern sentences built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.columns import ratio
from .common import with_scalars
from .quantiles import exact_quantiles


def overview(t: DataFrame) -> DataFrame:
    """Total, fraud total and fraud percentage (rounded half-even to 4)."""
    return t.agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.sum("fraud_flag").cast("bigint").alias("total_fraud_cases")).select(
        "*", F.bround(ratio("total_fraud_cases", "total_transactions") * 100, 4)
        .alias("fraud_rate_percent"))


def _overall_rate(t: DataFrame) -> DataFrame:
    return t.agg(F.avg(F.col("fraud_flag").cast("double")).alias("_overall"))


def risky_hours(t: DataFrame) -> DataFrame:
    """Hours whose fraud mean exceeds the overall fraud rate."""
    h = t.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.sum("fraud_flag").cast("bigint").alias("fraud_sum"), F.count(F.lit(1)).alias("n"),
        F.avg(F.col("fraud_flag").cast("double")).alias("fraud_mean"))
    return with_scalars(h, _overall_rate(t)).where(F.col("fraud_mean") > F.col("_overall")) \
        .drop("_overall")


def high_amount(t: DataFrame) -> DataFrame:
    """p50/p95/p99 of the amount and the fraud mean above p95 vs overall."""
    found = exact_quantiles(t, {"a": F.col("amount_inr")}, [0.5, 0.95, 0.99])
    at = found[None, "a"].at if found else (None, None, None)
    flag, above = F.col("fraud_flag").cast("double"), F.col("amount_inr").cast("double") > at[1] \
        if at[1] is not None else F.lit(False)
    out = t.agg(F.avg(flag).alias("overall_fraud_rate"),
                F.avg(F.when(above, flag)).alias("high_amount_fraud_rate")).select(
        *[F.lit(v).cast("double").alias(p) for p, v in zip(("p50", "p95", "p99"), at)],
        "overall_fraud_rate", "high_amount_fraud_rate")
    return out.withColumn("elevated", F.coalesce(
        F.col("high_amount_fraud_rate") > F.col("overall_fraud_rate"), F.lit(False)))


def risky_states(t: DataFrame, k: int = 3) -> DataFrame:
    """Top k sender states whose fraud mean exceeds twice the overall rate."""
    s = t.groupBy("sender_state").agg(
        F.sum("fraud_flag").cast("bigint").alias("fraud_sum"), F.count(F.lit(1)).alias("n"),
        F.avg(F.col("fraud_flag").cast("double")).alias("fraud_mean"))
    return (with_scalars(s.where(F.col("sender_state").isNotNull()), _overall_rate(t))
            .where(F.col("fraud_mean") > 2 * F.col("_overall")).drop("_overall")
            .orderBy(F.desc("fraud_mean"), "sender_state").limit(k))


def patterns(t: DataFrame) -> DataFrame:
    """The pattern sentences (only those whose condition holds)."""
    hours = risky_hours(t).agg(F.array_sort(F.collect_list("hour")).alias("hs"))
    hours = hours.where(F.size("hs") > 0).select(
        F.lit("risky_hours").alias("pattern"),
        F.concat(F.lit(fixed.RISKY_HOURS_MESSAGE), F.array_join("hs", ", "), F.lit("]"))
        .alias("message"))
    amt = high_amount(t).where("elevated").select(
        F.lit("high_amount").alias("pattern"),
        F.format_string(fixed.HIGH_AMOUNT_MESSAGE, F.col("p95")).alias("message"))
    st = risky_states(t).agg(F.collect_list(F.struct((-F.col("fraud_mean")).alias("_m"),
                                                     F.col("sender_state"))).alias("_s"))
    st = st.where(F.size("_s") > 0).select(
        F.lit("risky_states").alias("pattern"),
        F.concat(F.lit(fixed.RISKY_STATES_MESSAGE),
                 F.array_join(F.transform(F.array_sort("_s"), lambda x: x["sender_state"]),
                              ", ")).alias("message"))
    return hours.unionByName(amt).unionByName(st)


def model_summary(graph, clusters) -> DataFrame:
    """Counts describing the bank graph and the clusters of a fitted model."""
    from . import graph as g
    sus = graph.suspicious.agg(F.count(F.lit(1)).alias("fraud_clusters_detected"))
    anom = clusters.anomalies.agg(F.count(F.lit(1)).alias("anomaly_clusters"))
    return with_scalars(with_scalars(sus, anom), g.graph_size(graph.edges))


def insights(t: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Overview, pattern sentences and (with a fitted model's ``model_summary``) the
    model's counts as one table of (section, name, value)."""
    def tall(section: str, one: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                          for c in one.columns])
        return one.select(F.lit(section).alias("section"), F.inline(pairs))
    out = tall("overview", overview(t)).unionByName(patterns(t).select(
        F.lit("patterns").alias("section"), F.col("pattern").alias("name"),
        F.col("message").alias("value")))
    return out if summary is None else out.unionByName(tall("model", summary))
