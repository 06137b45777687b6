"""Adapters from the driver's star-schema tables to the canonical transaction table.

Canonical schema (one row per payment):
  transaction_id STRING, timestamp TIMESTAMP_NTZ, transaction_type STRING,
  merchant_category STRING, amount_inr BIGINT, transaction_status STRING,
  sender_age_group STRING, sender_state STRING, receiver_state STRING,
  sender_bank STRING, receiver_bank STRING, device_type STRING,
  network_type STRING, fraud_flag INT

Two mappings exist (rules are ours, invented for coverage):
  * ``events``   -- one row per event, 30 days of real time-of-day;
  * ``lineitem`` -- one row per order line, several years (monthly queries).

Join strategy: nation (25 rows) is broadcast by hint. The events mapping joins
supplier on ``k % 10`` and part on ``k`` with k in [0, 100), so those sides are
filtered to at most 10 and 100 keys first and are broadcast with a proven bound.
Every other dimension (customer, orders, supplier, part of lineitem) grows with
the data, so no hint is given: Catalyst broadcasts it only under
``spark.sql.autoBroadcastJoinThreshold`` (the size check) and otherwise plans a
sort-merge join; AQE re-plans at run time and splits skewed partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ts_literal
from .tables import read_table

TRANSACTION_COLUMNS = (
    "transaction_id", "timestamp", "transaction_type", "merchant_category", "amount_inr",
    "transaction_status", "sender_age_group", "sender_state", "receiver_state",
    "sender_bank", "receiver_bank", "device_type", "network_type", "fraud_flag")

EVENTS_AS_OF = _dt.datetime(2024, 1, 31)
LINEITEM_AS_OF = _dt.datetime(1998, 12, 20)

# events.props holds {"k": n}; the supplier is n modulo 10
SUPPLIER_KEYS = 10


def _bank(prefix_col) -> F.Column:
    return F.concat(F.lit("BANK"), prefix_col.cast("string"))


def _network(n) -> F.Column:
    return F.when(n == 0, "4G").when(n == 1, "5G").otherwise("WiFi")


def events_transactions(spark: SparkSession, sf_dir: str,
                        events: DataFrame | None = None) -> DataFrame:
    """Transactions from ``events`` (see module docstring). ``events`` may be a
    streaming DataFrame of the same table (stream-static joins)."""
    ev = (events if events is not None else read_table(spark, sf_dir, "events"))
    ev = (ev.select("event_id", "ts", "user_id", "event_type", "value", "props")
          .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
          .withColumn("supp", F.col("k") % SUPPLIER_KEYS))
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    cust = (read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_mktsegment", F.col("n_name").alias("sender_state")))
    supp = (read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
            .where(F.col("s_suppkey") < SUPPLIER_KEYS)
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("receiver_state")))
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    j = (ev.join(cust, ev.user_id == cust.c_custkey)
         .join(F.broadcast(supp), F.col("supp") == F.col("s_suppkey"))
         .join(part, F.col("k") == F.col("p_partkey")))
    is_error = F.col("event_type") == "error"
    return j.select(
        F.concat(F.lit("TXN"), F.lpad(F.col("event_id").cast("string"), 10, "0"))
        .alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type").isin("purchase", "click"), "P2M").otherwise("P2P")
        .alias("transaction_type"),
        F.col("p_brand").alias("merchant_category"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount_inr"),
        F.when(is_error & (F.col("k") < 10), "FAILED").otherwise("SUCCESS")
        .alias("transaction_status"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "18-25")
        .when(F.col("c_mktsegment") == "BUILDING", "26-35")
        .when(F.col("c_mktsegment") == "FURNITURE", "36-45")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "46-55")
        .otherwise("55+").alias("sender_age_group"),
        "sender_state", "receiver_state",
        _bank(F.col("user_id") % 12).alias("sender_bank"),
        _bank(F.col("supp")).alias("receiver_bank"),
        F.when(F.col("user_id") % 4 == 0, "iOS").otherwise("Android").alias("device_type"),
        _network(F.col("event_id") % 3).alias("network_type"),
        F.when(((F.col("user_id") % 12 == 3) & (F.col("supp") == 7) & is_error)
               | (F.col("event_id") % 997 == 0), 1).otherwise(0).cast("int")
        .alias("fraud_flag"),
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str, since=None,
                          until=None) -> DataFrame:
    """Transactions from ``lineitem`` joined to its dimensions.

    ``since``/``until`` are optional event-time bounds. The derived timestamp is
    ``l_shipdate`` plus 0..1439 minutes, so ``timestamp >= since`` implies
    ``l_shipdate > since - 1 day`` and ``timestamp < until`` implies
    ``l_shipdate < until``; those bounds are applied on the raw column so that
    parquet row groups outside the window are skipped (the exact filter stays
    with the caller).
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    if since is not None:
        li = li.where(F.col("l_shipdate") > ts_literal(since) - F.expr("INTERVAL 1 DAY"))
    if until is not None:
        li = li.where(F.col("l_shipdate") < ts_literal(until))
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    cust = (read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_name").alias("sender_state")))
    supp = (read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("receiver_state")))
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    minutes = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131 + F.col("l_partkey")) % 1440
    prio = F.substring("o_orderpriority", 1, 1)
    return j.select(
        F.concat(F.lit("TXN"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int")))
        .alias("timestamp"),
        F.when(F.col("l_returnflag") == "A", "P2P").otherwise("P2M").alias("transaction_type"),
        F.col("p_brand").alias("merchant_category"),
        F.round(F.col("l_extendedprice") / 10).cast("bigint").alias("amount_inr"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("l_linenumber") == 7), "FAILED")
        .otherwise("SUCCESS").alias("transaction_status"),
        F.when(prio == "1", "18-25").when(prio == "2", "26-35").when(prio == "3", "36-45")
        .when(prio == "4", "46-55").otherwise("55+").alias("sender_age_group"),
        "sender_state", "receiver_state",
        _bank(F.col("c_custkey") % 12).alias("sender_bank"),
        _bank(F.col("s_suppkey") % 10).alias("receiver_bank"),
        F.when(F.col("o_custkey") % 4 == 0, "iOS").otherwise("Android").alias("device_type"),
        _network(F.col("l_linenumber") % 3).alias("network_type"),
        F.when(((F.col("c_custkey") % 12 == 3) & (F.col("s_suppkey") % 10 == 7)
                & (F.col("l_linenumber") < 3)) | (F.col("l_orderkey") % 997 == 0), 1)
        .otherwise(0).cast("int").alias("fraud_flag"),
    )


# DuckDB SQL text of the same two mappings (used only by the oracle check).
EVENTS_TRANSACTIONS_SQL = """
transactions AS (
  SELECT 'TXN' || lpad(CAST(e.event_id AS VARCHAR), 10, '0') AS transaction_id,
         e.ts AS "timestamp",
         CASE WHEN e.event_type IN ('purchase', 'click') THEN 'P2M' ELSE 'P2P' END AS transaction_type,
         p.p_brand AS merchant_category,
         CAST(round(e.value * 100) AS BIGINT) AS amount_inr,
         CASE WHEN e.event_type = 'error' AND e.k < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '18-25' WHEN 'BUILDING' THEN '26-35'
              WHEN 'FURNITURE' THEN '36-45' WHEN 'HOUSEHOLD' THEN '46-55' ELSE '55+' END AS sender_age_group,
         n.n_name AS sender_state,
         m.n_name AS receiver_state,
         'BANK' || CAST(e.user_id % 12 AS VARCHAR) AS sender_bank,
         'BANK' || CAST(e.k % 10 AS VARCHAR) AS receiver_bank,
         CASE WHEN e.user_id % 4 = 0 THEN 'iOS' ELSE 'Android' END AS device_type,
         CASE e.event_id % 3 WHEN 0 THEN '4G' WHEN 1 THEN '5G' ELSE 'WiFi' END AS network_type,
         CAST(CASE WHEN (e.user_id % 12 = 3 AND e.k % 10 = 7 AND e.event_type = 'error')
                     OR e.event_id % 997 = 0 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = e.k % 10
  JOIN nation m ON m.n_nationkey = s.s_nationkey
  JOIN part p ON p.p_partkey = e.k
)"""

LINEITEM_TRANSACTIONS_SQL = """
transactions AS (
  SELECT 'TXN' || lpad(CAST(l.l_orderkey AS VARCHAR), 10, '0') || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         l.l_shipdate + to_minutes(CAST((l.l_orderkey * 7 + l.l_linenumber * 131 + l.l_partkey) % 1440 AS BIGINT)) AS "timestamp",
         CASE WHEN l.l_returnflag = 'A' THEN 'P2P' ELSE 'P2M' END AS transaction_type,
         p.p_brand AS merchant_category,
         CAST(round(l.l_extendedprice / 10) AS BIGINT) AS amount_inr,
         CASE WHEN o.o_orderpriority = '5-LOW' AND l.l_linenumber = 7 THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN '18-25' WHEN '2' THEN '26-35'
              WHEN '3' THEN '36-45' WHEN '4' THEN '46-55' ELSE '55+' END AS sender_age_group,
         n.n_name AS sender_state,
         m.n_name AS receiver_state,
         'BANK' || CAST(c.c_custkey % 12 AS VARCHAR) AS sender_bank,
         'BANK' || CAST(s.s_suppkey % 10 AS VARCHAR) AS receiver_bank,
         CASE WHEN o.o_custkey % 4 = 0 THEN 'iOS' ELSE 'Android' END AS device_type,
         CASE l.l_linenumber % 3 WHEN 0 THEN '4G' WHEN 1 THEN '5G' ELSE 'WiFi' END AS network_type,
         CAST(CASE WHEN (c.c_custkey % 12 = 3 AND s.s_suppkey % 10 = 7 AND l.l_linenumber < 3)
                     OR l.l_orderkey % 997 = 0 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation m ON m.n_nationkey = s.s_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey
)"""
