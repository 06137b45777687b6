"""Parallel global row number / running sum equal a sequential computation."""

import random

import pytest
from pyspark.sql import functions as F

from txnscope.operators.ranking import global_row_number, global_running_sum


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_row_number_and_running_sum(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.randint(0, 20), f"k{i:04d}", rng.randint(-5, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "v INT, k STRING, w INT")
    order = [F.desc("v"), F.asc("k")]  # ties on v are broken by the unique k
    rn = {r["k"]: r["rn"] for r in global_row_number(df, order, "rn", partitions).collect()}
    rs = {r["k"]: r["rs"] for r in global_running_sum(df, order, "w", "rs", partitions).collect()}
    seq = sorted(rows, key=lambda r: (-r[0], r[1]))
    total = 0
    for i, (v, k, w) in enumerate(seq, start=1):
        total += w
        assert rn[k] == i
        assert rs[k] == total
