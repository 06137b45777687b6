"""Token counts by separator scan over flat, unindexed token files.

A token file is nothing but little-endian 16-bit ids; documents follow each other and
each ends with the end-of-document id. The files of a folder, in name order, form one
stream. The scan cuts every file into blocks wherever they fall, searches each block
for the end id with one vectorised comparison, and reduces it to a summary (tokens,
separators, last separator). A two-level prefix scan over the summaries then gives each
block the number of documents that ended before it and the place where the document
that is open at its start began, so documents that span blocks or files are stitched
without reading a token twice.

Defined cases: a null or empty text is a document of no tokens; tokens after the last
separator form a last document with ``terminated`` false; an empty file or folder
gives no row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import create_file, open_file, open_fs, read_table, shared_folder, task_file, written

BLOCK_TOKENS = 1 << 20
#: Blocks whose prefix sums are taken in one task; the next level has one row for each.
BLOCKS_PER_GROUP = 1024
END_OF_TEXT = 50256


def byte_encoder(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def write_token_files(docs: DataFrame, folder: str, ranks_path: str, end_id: int) -> DataFrame:
    """Tokenise whole texts into flat files, one per task. Returns the written
    (file, ordinal, doc_id): what the unindexed files themselves do not hold."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = byte_encoder(ranks_path)
        end = np.array([end_id], "<u2").tobytes()
        out, uri, ordinal = None, "", 0
        for b in batches:
            if out is None and len(b):
                uri = task_file(folder, ".bin")
                out = create_file(uri)
            for t in b["text"]:
                out.write(np.array(encoding.encode_ordinary(t or ""), "<u2").tobytes() + end)
            yield pd.DataFrame({"file": uri.rsplit("/", 1)[-1],
                                "ordinal": np.arange(ordinal, ordinal + len(b)),
                                "doc_id": b["doc_id"].astype("Int64")})
            ordinal += len(b)
        if out:
            out.close()
    filesystem, path = open_fs(folder)
    filesystem.create_dir(path, recursive=True)       # an empty table writes no file
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInPandas(run, "file string, ordinal long, doc_id long"))
    return written(rows, "token-file-documents")


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file, bytes) of a folder; the contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file"),
                    F.col("length").alias("bytes")))


def scan_blocks(files: DataFrame, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, n_tokens, seps): the end ids' positions in each block."""
    step = 2 * block_tokens
    blocks = (files.where("bytes > 1")
              .select("path", "file", "bytes",
                      F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1,
                                              F.lit(step).cast("bigint"))).alias("block", "at"))
              .repartition(F.col("file"), F.col("block")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, file, size, block, at in b.itertuples(index=False):
                with open_file(path) as f:
                    raw = f.read_at(int(min(step, size - at)), int(at))
                ids = np.frombuffer(raw, "<u2", len(raw) // 2)
                rows.append((file, block, len(ids), np.flatnonzero(ids == end_id).tolist()))
            yield pd.DataFrame(rows, columns=["file", "block", "n_tokens", "seps"])
    return blocks.mapInPandas(run, "file string, block int, n_tokens long, seps array<long>")


def stitched(blocks: DataFrame) -> DataFrame:
    """Prefix scan over written block summaries: (file, block, seps, n_tokens) plus
    ``start`` (stream position of the block), ``ended`` (documents that ended before
    it) and ``opened`` (stream position where the open document began)."""
    order = Window.partitionBy("file", "group").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    b = (blocks.withColumn("group", F.floor(F.col("block") / BLOCKS_PER_GROUP))
         .withColumn("n_seps", F.size("seps").cast("bigint"))
         .withColumn("start_in", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
         .withColumn("ended_in", F.coalesce(F.sum("n_seps").over(before), F.lit(0)))
         .withColumn("open_at", F.col("start_in") + F.try_element_at("seps", F.lit(-1)) + 1)
         .withColumn("opened_in", F.max(F.when(F.col("n_seps") > 0, F.col("open_at"))).over(before)))
    # one row per group of blocks: its totals, scanned in stream order
    over = Window.orderBy("file", "group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (b.groupBy("file", "group")
              .agg(F.sum("n_tokens").alias("t"), F.sum("n_seps").alias("s"),
                   F.max(F.when(F.col("n_seps") > 0, F.col("open_at"))).alias("o"))
              .withColumn("start_of", F.coalesce(F.sum("t").over(over), F.lit(0)))
              .withColumn("ended_of", F.coalesce(F.sum("s").over(over), F.lit(0)))
              .withColumn("opened_of",
                          F.coalesce(F.max(F.col("start_of") + F.col("o")).over(over), F.lit(0)))
              .select("file", "group", "start_of", "ended_of", "opened_of"))
    return (b.join(groups, ["file", "group"])
            .select("file", "block", "n_tokens", "seps",
                    (F.col("start_of") + F.col("start_in")).alias("start"),
                    (F.col("ended_of") + F.col("ended_in")).alias("ended"),
                    "ended_of",
                    F.coalesce(F.col("start_of") + F.col("opened_in"),
                               F.col("opened_of")).alias("opened")))


def scan_documents(spark: SparkSession, folder: str, end_id: int,
                   block_tokens: int = BLOCK_TOKENS, only: DataFrame | None = None) -> DataFrame:
    """One row per document of a folder of token files: file (where it ends), number
    (in the stream), start (stream position), n_tokens (without the end id),
    terminated. ``only`` (file) restricts the scan to committed files."""
    files = listed_files(spark, folder)
    if only is not None:
        files = files.join(only.select("file").distinct(), "file", "left_semi")
    blocks = stitched(written(scan_blocks(files, end_id, block_tokens), "token-blocks"))
    ends = blocks.select("file", "start", "ended", "opened", "seps", "n_tokens",
                         F.posexplode("seps").alias("i", "sep"))
    done = ends.select(
        "file", (F.col("ended") + F.col("i")).alias("number"),
        F.when(F.col("i") == 0, F.col("opened"))
        .otherwise(F.col("start") + F.element_at("seps", F.greatest(F.col("i"), F.lit(1))) + 1)
        .alias("start"), (F.col("start") + F.col("sep")).alias("end"))
    total = blocks.agg(
        F.max(F.struct(F.col("start") + F.col("n_tokens"), "file")).alias("m"),
        F.max(F.col("ended") + F.size("seps")).alias("number"),
        F.max(F.greatest("opened", F.col("start") + F.try_element_at("seps", F.lit(-1)) + 1)).alias("start"))
    tail = total.select(F.col("m.file").alias("file"), "number", "start",
                        F.col("m.col1").alias("end")).where("end > start")
    return (done.withColumn("terminated", F.lit(True))
            .unionByName(tail.withColumn("terminated", F.lit(False)))
            .select("file", "number", "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                    "terminated"))


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, read off flat files of byte-level ids."""
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "token-files")
    named = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              END_OF_TEXT)
    found = scan_documents(spark, folder, END_OF_TEXT, only=named)
    # this writer ends every document in its file: documents of the files before
    # turn the stream number into a place in the file
    files = named.groupBy("file").agg(F.count("*").alias("n"))
    first = files.withColumn("first", F.coalesce(
        F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("n")
    numbered = named.join(first, "file").withColumn("number", F.col("first") + F.col("ordinal"))
    return (numbered.join(found, ["file", "number"])
            .select("doc_id", "file", "number", "start", "n_tokens"))
