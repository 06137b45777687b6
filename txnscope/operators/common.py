"""Small shared building blocks for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach a ONE-row aggregate (global statistics) to every row of ``df``.

    The statistics row is a bounded result (a few numbers), so it is fetched
    to the driver and added as typed literals, which Catalyst folds into the
    expressions that use them. No join of any kind is planned, and ``df``
    itself is never collected.
    """
    rows = scalars.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected a one-row statistics frame, got {len(rows)} rows")
    row = rows[0]
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType)
                           for f in scalars.schema.fields})


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation of float-heavy outputs)."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


#: Rows up to which a side whose growth is known (banks, bank pairs, flags, clusters)
#: is sent to every task; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000


def bounded_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``most`` rows. ``df`` should be
    small to count (checkpointed, or an aggregate over a checkpointed table)."""
    return F.broadcast(df) if df.count() <= most else df


#: Pieces of an even share that a frequent key is cut into, so that they spread evenly.
PIECES = 16


def lookup_join(df: DataFrame, side: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """``df`` left-joined with ``side`` (at most one row per key) on a few codes that may be
    very frequent in ``df``.

    A side of at most ``most`` rows goes to every task. A larger one is joined by shuffle,
    and keys that hold more than a part of an even share of ``df`` are found first: their
    rows are dealt over as many salts as such parts they hold, and their row of ``side`` is
    copied to each. Such keys are fewer than ``PIECES`` a partition, so their table is
    broadcast."""
    if side.count() <= (BROADCAST_ROWS if most is None else most):
        return df.join(F.broadcast(side), keys, "left")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    share = max(1, -(-df.count() // (partitions * PIECES)))
    hot = counts.where(F.col("_n") > share).select(
        *keys, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    one = F.coalesce("_salts", F.lit(1))
    dealt = (df.join(F.broadcast(hot), keys, "left")
             .withColumn("_salt", F.pmod(F.xxhash64(*df.columns), one.cast("bigint")).cast("int"))
             .drop("_salts"))
    copied = (side.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_salts"))
    # as many tasks as shares, whatever the sizes in bytes
    dealt = dealt.repartition(partitions, *keys, "_salt")
    return dealt.join(copied.hint("merge"), [*keys, "_salt"], "left").drop("_salt")


#: Rows that are worth a task of their own while cores are idle, and rows of a task at most.
LEAST_ROWS, MOST_ROWS = 50_000, 500_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, and dealt over the cores where a few tasks hold most of it (a
    file with few row groups is read by few tasks, and what follows it without a shuffle
    stays with them)."""
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    n, largest = (v or 0 for v in df.groupBy(F.spark_partition_id().alias("_p")).count()
                  .agg(F.sum("count"), F.max("count")).first())
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS), 1)
    return df.repartition(tasks).checkpoint(eager=True) if largest > 2 * -(-n // tasks) else df
