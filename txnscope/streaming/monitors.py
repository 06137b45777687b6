"""Structured Streaming versions of the two "real-time" dashboards, and model scoring.

The originals re-poll a ``NOW() - 1 hour`` predicate. Here the same logic runs
incrementally:

* ``fraud_score_stream`` -- stateless: every arriving payment is scored with the
  rule score of the batch report and appended to the sink.
* ``health_stream`` -- 1-hour windows sliding every 5 minutes on event time,
  with a 10-minute watermark; append mode emits each window once, when the
  watermark passes its end, and drops rows later than the watermark. Distinct
  banks / categories use ``size(collect_set)`` (exact; the sets are bounded by
  the number of banks and categories), because exact ``countDistinct`` is not
  supported on streams.

* ``period_health_stream`` -- the last hour and the last 24 hours in one stream, over
  5-minute panes kept as state.
* ``run_model_scores`` -- the fitted ensemble applied batch by batch, each batch written
  to its own folder (a repeated batch replaces it).

Sources are file streams of the ``events`` table joined to the static
dimension tables (stream-static joins). Event time must be TIMESTAMP (not
NTZ) for a watermark, so it is cast with the session zone pinned to UTC.
Sinks are parquet folders with a checkpoint location in the shared folder
named by ``spark.checkpoint.dir``, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import count_if, pct, first_match
from ..operators.dashboards import score_transactions
from ..session import checkpoint_dir
from ..sources import adapters
from ..sources.tables import read_table, table_path


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming transaction table from the ``events`` parquet files."""
    schema = read_table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A table may be one parquet file or a folder of files. A file stream on a
    # plain path treats it as the base folder, so a single file is named
    # through a one-character glob class ("events.parque[t]"), which the
    # source lists like any glob.
    path = table_path(sf_dir, "events")
    if is_file(spark, path):
        path = path[:-1] + "[" + path[-1] + "]"
    stream = reader.parquet(path)
    return adapters.events_transactions(spark, sf_dir, events=stream)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a table path is one file, in whatever file system it names."""
    files = spark.read.parquet(path).inputFiles()
    return len(files) == 1 and files[0].rstrip("/").endswith(path.rsplit(":", 1)[-1].lstrip("/"))


def fraud_score_stream(t: DataFrame) -> DataFrame:
    return score_transactions(t)


def health_stream(t: DataFrame, window: str = "1 hour", slide: str = "5 minutes",
                  watermark: str = "10 minutes") -> DataFrame:
    ev = t.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    agg = (ev.withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", window, slide).alias("w"))
           .agg(F.count(F.lit(1)).alias("transaction_count"),
                F.sum("amount_inr").alias("total_value"),
                F.avg("amount_inr").alias("_avg"),
                count_if(F.col("transaction_status") == "SUCCESS").alias("_ok"),
                count_if(F.col("fraud_flag") == 1).alias("_fraud"),
                F.size(F.collect_set("sender_bank")).alias("active_banks"),
                F.size(F.collect_set("merchant_category")).alias("active_merchant_categories")))
    s, f = pct("_ok", "transaction_count"), pct("_fraud", "transaction_count")
    return agg.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "transaction_count", "total_value", F.round("_avg", 2).alias("avg_transaction_value"),
        F.round(s, 2).alias("success_rate"), F.round(f, 4).alias("fraud_rate"),
        "active_banks", "active_merchant_categories",
        first_match([(s < 95, "SUCCESS_RATE_LOW"), (f > 1, "FRAUD_RATE_HIGH"),
                     (F.col("transaction_count") < 1000, "VOLUME_LOW")], "HEALTHY")
        .alias("system_status"))


#: Payments below which a period's volume is low.
VOLUME_FLOORS = {"LAST_HOUR": 1000, "LAST_24_HOURS": 50000}


def panes(t: DataFrame, pane: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """One row per closed pane of event time: counts, sums and the banks and categories
    seen. Every payment is one row into this state."""
    ev = t.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return (ev.withWatermark("event_time", watermark).groupBy(F.window("event_time", pane).alias("pane"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_inr").alias("value"),
                 count_if(F.col("transaction_status") == "SUCCESS").alias("ok"),
                 count_if(F.col("fraud_flag") == 1).alias("fraud"),
                 F.collect_set("sender_bank").alias("banks"),
                 F.collect_set("merchant_category").alias("categories"))
            .withColumn("pane_time", F.window_time("pane")).drop("pane"))


def period_health_stream(t: DataFrame, pane: str = "5 minutes", slide: str = "15 minutes",
                         watermark: str = "10 minutes") -> DataFrame:
    """The health report of the last hour and of the last 24 hours, every ``slide``, as one
    stream. Payments are reduced to panes first; a day's window merges its panes (at most
    288 small rows), and the last hour is its last panes, so no payment is copied. A period
    is reported once the watermark has passed its end, if it holds a payment."""
    merged = (panes(t, pane, watermark).withColumn("w", F.window("pane_time", "24 hours", slide))
              .groupBy("w"))
    late = F.col("pane_time") >= F.col("w.end") - F.expr("INTERVAL 1 HOUR")
    aggs = []
    for tag, inside in (("h1", late), ("h24", F.lit(True))):
        aggs += [F.sum(F.when(inside, F.col(c))).alias(f"{tag}_{c}") for c in ("n", "value", "ok", "fraud")]
        aggs += [F.size(F.array_distinct(F.flatten(F.collect_list(F.when(inside, F.col(c))))))
                 .alias(f"{tag}_{c}") for c in ("banks", "categories")]
    rows = merged.agg(*aggs).select("w", F.inline(F.array(*[F.struct(
        F.lit(period).alias("time_period"), F.lit(floor).alias("floor_n"),
        *[F.col(f"{tag}_{c}").alias(c) for c in ("n", "value", "ok", "fraud", "banks", "categories")])
        for tag, (period, floor) in zip(("h1", "h24"), VOLUME_FLOORS.items())])))
    s, f = pct("ok", "n"), pct("fraud", "n")

    def rounded(top, digits):
        """top / n, rounded half up in whole numbers."""
        scale = 10 ** digits
        halves = top * (2 * scale) + F.col("n")
        return (halves - halves % (2 * F.col("n"))) / (2 * F.col("n")) / float(scale)
    return rows.where("n > 0").select(
        F.col("w.end").cast("timestamp_ntz").alias("period_end"), "time_period",
        F.col("n").alias("transaction_count"), F.col("value").alias("total_value"),
        rounded(F.col("value"), 2).alias("avg_transaction_value"),
        rounded(F.col("ok") * 100, 2).alias("success_rate"),
        rounded(F.col("fraud") * 100, 4).alias("fraud_rate"),
        F.col("banks").alias("active_banks"), F.col("categories").alias("active_merchant_categories"),
        first_match([(s < 95, "SUCCESS_RATE_LOW"), (f > 1, "FRAUD_RATE_HIGH"),
                     (F.col("n") < F.col("floor_n"), "VOLUME_LOW")], "HEALTHY").alias("system_status"))


def run_to_parquet(stream: DataFrame, name: str, trigger_available_now: bool = True) -> DataFrame:
    """Run a streaming query into a parquet folder of the shared checkpoint
    area (available-now trigger: process everything present, then stop) and
    return the batch view of what it wrote."""
    spark = stream.sparkSession
    root = os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", os.path.join(root, "out"))
              .option("checkpointLocation", os.path.join(root, "checkpoint")))
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    q = writer.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(os.path.join(root, "out"))


def run_model_scores(stream: DataFrame, model, name: str, root: str | None = None) -> DataFrame:
    """Score a stream of payments with a fitted ensemble (its training statistics, so that a
    row's score does not depend on its batch) and return the batch view of the scores.

    A batch is written to a folder of its own that a repeated run of the batch replaces, so
    a restart after a failure leaves each payment scored once."""
    spark = stream.sparkSession
    root = root or os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    out = os.path.join(root, "out")

    def score(batch: DataFrame, batch_id: int) -> None:
        model.score(batch, stats="train").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    q = (stream.writeStream.foreachBatch(score).trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(root, "checkpoint")).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    schema = model.score(spark.createDataFrame([], stream.schema), stats="train").schema
    return spark.read.schema(schema).parquet(f"{out}/batch=*")
