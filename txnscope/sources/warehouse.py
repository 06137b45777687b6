"""Materialised transaction table (the "fact table" the reports read).

Production shape: the star join of the adapters runs ONCE, and the result is
written as parquet partitioned by ``txn_month`` (first day of the month) and
sorted by event time inside each partition. Every report then reads only the
months that intersect its look-back window (partition pruning), and parquet
row-group statistics on ``timestamp`` skip most of the rest. At 100 TB a
30-day report touches about 1/12 of a year of data instead of all of it.

The table is written to the shared folder named by ``spark.checkpoint.dir``
(never a machine-local temp folder), so it survives executor loss.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import TS
from ..session import checkpoint_dir

PARTITION = "txn_month"


def materialize(t: DataFrame, name: str, spark: SparkSession | None = None,
                partitions: int | None = None) -> str:
    """Write the transaction table partitioned by month; return its path.

    Rows are range-partitioned on (month, timestamp): a month is spread over
    many write tasks (hash-partitioning on the month alone would send a whole
    month, terabytes at scale, to one task), and each task writes
    time-sorted files of one or two months, so row-group statistics on
    ``timestamp`` stay tight.
    """
    spark = spark or t.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(checkpoint_dir(spark), "warehouse", f"{name}-{uuid.uuid4().hex[:10]}")
    (t.withColumn(PARTITION, F.trunc(F.to_date(TS), "month"))
     .repartitionByRange(n, PARTITION, TS)
     .sortWithinPartitions(PARTITION, TS)
     .write.mode("overwrite").partitionBy(PARTITION).parquet(path))
    return path


def read_window(spark: SparkSession, path: str, since: _dt.datetime | None = None,
                until: _dt.datetime | None = None) -> DataFrame:
    """Read the table, pruning to the months that intersect [since, until)."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where(F.col(PARTITION) >= F.lit(_dt.date(since.year, since.month, 1)))
    if until is not None:
        df = df.where(F.col(PARTITION) <= F.lit(until.date()))
    return df.drop(PARTITION)
