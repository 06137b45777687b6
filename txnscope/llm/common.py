"""Shared helpers of the text operators: table access, shared-folder tables,
row-wise Arrow batches and task-side files."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Words of the corpus contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
FOLDS = 5


#: Rows and bytes that one Arrow batch hands to Python: texts are long, some very long, and
#: a worker holds a few batches at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    spark.conf.set(_BYTES_SETTING, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back."""
    bounded_batches(df.sparkSession)
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_columns(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names (the first of each), whatever other columns,
    also with names that differ in case only, are there."""
    apart = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return apart.select(*[F.col(f"c{df.columns.index(name)}").alias(name) for name in names])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(doc_id: Column | str) -> Column:
    """crc32 of the id's decimal text, modulo 5 (null ids: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % FOLDS


def bounded_sample_ids(ids: DataFrame, bound: int, seed: int = 0) -> list[int]:
    """At most ``bound`` distinct ids, those of the smallest hash: a documented,
    repeatable sample whose size does not depend on the table."""
    rows = (ids.select(F.col(ids.columns[0]).alias("i")).where("i IS NOT NULL").distinct()
            .orderBy(F.xxhash64("i", F.lit(seed)), "i").limit(bound).collect())
    return [r.i for r in rows]


def map_batches(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                schema: str) -> DataFrame:
    return df.mapInPandas(fn, schema)


# --- state of Python workers ----------------------------------------------------------------

def _kept() -> dict:
    import sys
    import types
    return sys.modules.setdefault("_task_state", types.ModuleType("_task_state")).__dict__


def task_state(name: str, make):
    """State that the tasks of one step share in a Python worker (a worker serves many
    tasks, also of other steps: what those left is released first)."""
    kept = _kept()
    if name not in kept:
        release_task_state()
        kept[name] = make()
    return kept[name]


def release_task_state() -> None:
    """Forget what earlier steps left in this worker, and hand free memory back."""
    import gc

    import pyarrow as pa
    kept = _kept()
    for name in [k for k in kept if not k.startswith("__")]:
        del kept[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        import ctypes
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:                      # another C library: it keeps its free pages
        pass


# --- files written and read inside tasks -------------------------------------------------

def open_fs(uri: str):
    """(filesystem, path) of a URI of the shared folder."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def task_file(folder: str, suffix: str) -> str:
    """A file name no other attempt of this or another task uses. Readers only
    follow the manifest rows of committed attempts, so files that a lost
    executor left behind are never read."""
    from pyspark import TaskContext
    return f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"


def create_file(uri: str):
    filesystem, path = open_fs(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(path, compression=None)


def open_file(uri: str):
    filesystem, path = open_fs(uri)
    return filesystem.open_input_file(path)


def pack_u16(ids) -> bytes:
    """Token ids below 65536 as compressed byte planes (low bytes, then high)."""
    import numpy as np
    import zstandard
    raw = np.asarray(ids, "<u2").view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(raw[0::2].tobytes() + raw[1::2].tobytes())


def unpack_u16(blob: bytes):
    import numpy as np
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(planes) // 2
    out = np.empty(2 * n, np.uint8)
    out[0::2], out[1::2] = planes[:n], planes[n:]
    return out.view("<u2")


def crc32_u32(ids, start: int = 0) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import numpy as np
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes(), start)
