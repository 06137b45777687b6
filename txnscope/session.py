"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every txnscope job relies on. Time-of-day logic runs on TIMESTAMP_NTZ
# columns, so results do not depend on the session zone; UTC is pinned anyway so
# that streaming casts (NTZ -> TIMESTAMP) are stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "txnscope", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with txnscope's settings.

    On a cluster, leave ``master`` unset and let spark-submit provide it; the
    shuffle partition count should then be sized to the input (roughly
    input_bytes / 128 MB), while AQE coalesces small partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may leave it
    unset (tests): a private scratch folder is created then. Executors of a cluster
    could not share such a folder, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="txnscope-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_root(spark: SparkSession) -> str:
    """The folder that outlives a session: what the cluster names in
    ``spark.checkpoint.dir``, else (local tests) the session's own folder."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for a written intermediate table."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
