import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="txnscope-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from txnscope.sources.tables import TABLES, table_path

    def make(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
        return con
    return make


def txn_frame(spark, rows):
    """Hand-made transactions in the canonical schema (for label cases that the
    fixtures do not reach)."""
    import datetime as dt

    from txnscope.sources.adapters import TRANSACTION_COLUMNS
    schema = ("transaction_id STRING, timestamp TIMESTAMP_NTZ, transaction_type STRING, "
              "merchant_category STRING, amount_inr BIGINT, transaction_status STRING, "
              "sender_age_group STRING, sender_state STRING, receiver_state STRING, "
              "sender_bank STRING, receiver_bank STRING, device_type STRING, network_type STRING, "
              "fraud_flag INT")
    base = dict(transaction_type="P2P", merchant_category="Food", amount_inr=100,
                transaction_status="SUCCESS", sender_age_group="26-35", sender_state="S1",
                receiver_state="S1", sender_bank="A", receiver_bank="B", device_type="Android",
                network_type="4G", fraud_flag=0, timestamp=dt.datetime(2024, 1, 30, 12))
    out = []
    for i, r in enumerate(rows):
        d = dict(base, transaction_id=f"T{i:06d}")
        d.update(r)
        out.append(tuple(d[c] for c in TRANSACTION_COLUMNS))
    return spark.createDataFrame(out, schema)
