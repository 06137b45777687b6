"""The training-data pipeline: documents -> quality -> near-duplicates -> benchmark
passages -> source mix -> token shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir). ``run``
applies them to ``documents``, writing each stage's rows as Parquet to the shared
folder and rereading them as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscope.llm import decontaminate, mixing, order_minhash, quality, rans
from txnscope.llm.common import read_table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the positive-unlabelled classifier rejects."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return order_minhash.one_per_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources meet their target weights."""
    return mixing.mixed_rows(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the mixed documents (repeats included) and report what the shards hold."""
    return rans.encoded_and_read_back(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_id_output", token_shards),
]

#: The stages learn models and draw random numbers, which SQL cannot express;
#: tests/llm/test_pipeline.py holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
