"""The two fixture adapters reproduce the counts documented in FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_MID
from txnscope.sources.adapters import (TRANSACTION_COLUMNS, events_transactions,
                                       lineitem_transactions)


def _stats(t):
    return t.agg(F.count(F.lit(1)).alias("n"), F.sum("fraud_flag").alias("fraud"),
                 F.count_if(F.col("transaction_status") == "FAILED").alias("failed"),
                 F.countDistinct("transaction_id").alias("ids"),
                 F.countDistinct("sender_bank", "receiver_bank").alias("pairs")).first()


def test_events_adapter_counts(spark):
    t = events_transactions(spark, SF_MID)
    assert tuple(t.columns) == TRANSACTION_COLUMNS
    s = _stats(t)
    assert (s["n"], s["fraud"], s["failed"], s["ids"], s["pairs"]) == (10000, 29, 205, 10000, 120)


def test_lineitem_adapter_counts(spark):
    as_of = dt.datetime(1998, 12, 20)
    t = lineitem_transactions(spark, SF_MID, until=as_of).where(
        F.col("timestamp") < F.lit(as_of).cast("timestamp_ntz"))
    s = _stats(t)
    assert (s["n"], s["ids"], s["fraud"], s["failed"]) == (35107, 29892, 134, 1001)


def test_lineitem_adapter_keeps_every_row(spark):
    t = lineitem_transactions(spark, SF_MID)
    assert t.count() == spark.read.parquet(f"{SF_MID}/lineitem.parquet").count()


def test_events_beyond_the_usual_keys_are_kept(spark):
    """A part key of 100 or more is a key like any other."""
    events = spark.read.parquet(f"{SF_MID}/events.parquet").limit(3).withColumn(
        "props", F.lit('{"k": 150}'))
    t = events_transactions(spark, SF_MID, events=events)
    assert t.count() == 3


def test_schema_types(spark):
    t = events_transactions(spark, SF_MID)
    types = dict(t.dtypes)
    assert types["timestamp"] == "timestamp_ntz" and types["amount_inr"] == "bigint"
    assert types["fraud_flag"] == "int"
