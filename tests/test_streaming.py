"""Streaming monitors equal their batch counterparts."""

from conftest import SF_SMALL
from txnscope.operators.dashboards import score_transactions
from txnscope.sources.adapters import events_transactions
from txnscope.streaming import monitors


def test_stream_score_equals_batch(spark):
    out = monitors.run_to_parquet(monitors.fraud_score_stream(monitors.events_stream(spark, SF_SMALL)),
                                  "test_score")
    batch = score_transactions(events_transactions(spark, SF_SMALL))
    assert out.count() == batch.count()
    assert out.exceptAll(batch.select(*out.columns)).count() == 0


def test_stream_health_windows_are_closed_and_complete(spark):
    out = monitors.run_to_parquet(monitors.health_stream(monitors.events_stream(spark, SF_SMALL)),
                                  "test_health")
    rows = out.collect()
    assert rows and all((r["window_end"] - r["window_start"]).total_seconds() == 3600 for r in rows)
    assert all(r["transaction_count"] > 0 for r in rows)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    """Two micro-batches: the second carries a row older than the watermark
    (max event time - 10 min), which must not reach any window."""
    import datetime as dt

    from conftest import txn_frame
    src = tmp_path / "in"
    schema = txn_frame(spark, [{}]).schema
    t0 = dt.datetime(2024, 1, 10, 12, 0)
    first = txn_frame(spark, [dict(timestamp=t0 + dt.timedelta(minutes=m)) for m in range(0, 180, 10)])
    first.coalesce(1).write.mode("append").parquet(str(src))  # one file = one micro-batch
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = (monitors.health_stream(stream).writeStream.format("parquet").outputMode("append")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .start())
    try:
        q.processAllAvailable()
        late = txn_frame(spark, [dict(timestamp=t0 + dt.timedelta(minutes=5), amount_inr=999999),
                                 dict(timestamp=t0 + dt.timedelta(hours=4))])
        late.coalesce(1).write.mode("append").parquet(str(src))
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(str(tmp_path / "out"))
    rows = out.collect()
    assert rows, "closed windows are emitted"
    assert all(r["total_value"] < 999999 for r in rows)  # the late row was dropped
    first_window = [r for r in rows if r["window_start"] == t0]
    assert first_window and first_window[0]["transaction_count"] == 6
