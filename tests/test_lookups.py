"""Lookups beyond the broadcast bound, stored sketches, the binned density."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, txn_frame
from txnscope.operators import graph as g
from txnscope.operators import profiling, sketches
from txnscope.operators.common import lookup_join
from txnscope.sources.adapters import events_transactions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_frequent_key_is_dealt_over_the_tasks(spark):
    n = 8000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"))
    side = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 500, 2)],
                                 "k STRING, v DOUBLE")
    salted, plain = lookup_join(df, side, ["k"], most=0), lookup_join(df, side, ["k"])
    assert rows(salted.select("id", "k", "v")) == rows(plain.select("id", "k", "v"))
    assert "BroadcastHashJoin" in plain._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = sorted(r["n"] for r in lookup_join(df, side, ["k"], most=0)
                       .groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == n and sizes[-1] <= 2 * np.median(sizes)


def test_graph_lookups_without_broadcast_agree(spark):
    t = events_transactions(spark, SF_SMALL)
    edges = g.bank_edges(t).checkpoint()
    sus = g.graph_nodes(edges).select("node", F.lit(0.01).alias("fraud_rate"))
    assert rows(g.graph_risk_scores(t, edges, sus, most=0).select("transaction_id", "graph_risk_score")) \
        == rows(g.graph_risk_scores(t, edges, sus).select("transaction_id", "graph_risk_score"))
    assert rows(g.fraud_subgraph(t, most=0)) == rows(g.fraud_subgraph(t))


def test_sketches_merge_days_and_replace_only_their_own(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    frame = txn_frame(spark, [dict(timestamp=day + dt.timedelta(days=i % 10, hours=i % 20),
                                   amount_inr=i % 400) for i in range(3000)])
    path = str(tmp_path / "s")
    made = sketches.daily_sketches(frame, F.col("amount_inr"), ["device_type"])
    sketches.store_days(made, path)
    sketches.store_days(made.where("day = '2024-01-05'"), path)      # a repeated day
    got = {r["lookback_days"]: r for r in sketches.lookback_counts(
        spark, path, dt.datetime(2024, 1, 11, 5), [2, 7, 30], ["device_type"]).collect()}
    for days, row in got.items():
        since = day + dt.timedelta(days=max(0, 10 - days))
        exact = frame.where(F.col("timestamp") >= F.lit(since)).select("amount_inr").distinct().count()
        assert abs(row["estimate"] - exact) <= exact * sketches.relative_error() + 1
        assert row["days_read"] == min(days, 10)
    plan = sketches.lookback_counts(spark, path, dt.datetime(2024, 1, 11), [2], [])
    assert "PartitionFilters" in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("values", [np.random.default_rng(1).lognormal(5, 1.2, 3000),
                                    np.array([0.0, 1e6] + [3.0] * 500), np.arange(50.0)])
def test_binned_density_stays_within_its_error(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "amount_inr DOUBLE")
    exact = {r["grid_index"]: r["density"] for r in profiling.amount_kde(df).collect()}
    got = profiling.amount_kde_binned(df).collect()
    assert len(got) == 200
    for r in got:
        assert abs(r["density"] - exact[r["grid_index"]]) <= r["max_error"] + 1e-15
    assert profiling.amount_kde_binned(df.limit(0)).count() == 0
