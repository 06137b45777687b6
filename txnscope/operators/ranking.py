"""Global ordering helpers that do not funnel all rows into one task.

``Window.orderBy`` without ``partitionBy`` moves every row to one task. Here the
rows are range-partitioned on the full order (which must be a total order:
end it with unique tie-breakers), processed inside each range, and shifted by
the totals of all earlier ranges. The range-partitioned frame is checkpointed
to the shared checkpoint folder so both consumers see the same partition
assignment, also after a lost executor forces recomputation. The offsets table
has one row per partition (bounded by the partition count): broadcast is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _ranged(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *order)
            .withColumn("_range_part", F.spark_partition_id())
            .checkpoint(eager=True))


def _offsets(ranged: DataFrame, value: Column) -> DataFrame:
    return (ranged.groupBy("_range_part").agg(F.sum(value).alias("_range_n"))
            .withColumn("_range_offset",
                        F.coalesce(F.sum("_range_n").over(Window.orderBy("_range_part"))
                                   - F.col("_range_n"), F.lit(0)))
            .drop("_range_n"))


def global_running_sum(df: DataFrame, order: list[Column], value: Column | str, name: str,
                       partitions: int | None = None) -> DataFrame:
    """Inclusive running ``SUM(value) OVER (ORDER BY order)``, in parallel."""
    v = F.col(value) if isinstance(value, str) else value
    ranged = _ranged(df, order, partitions)
    local = (Window.partitionBy("_range_part").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.withColumn("_local", F.sum(v).over(local))
            .join(F.broadcast(_offsets(ranged, v)), "_range_part")
            .withColumn(name, F.col("_range_offset") + F.col("_local"))
            .drop("_range_part", "_range_offset", "_local"))


def global_row_number(df: DataFrame, order: list[Column], name: str,
                      partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)``, in parallel."""
    out = global_running_sum(df, order, F.lit(1).cast("bigint"), name, partitions)
    return out.withColumn(name, F.col(name).cast("int"))
