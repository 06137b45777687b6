"""Merkle manifest of the documents, with a proof per leaf by pointer jumping.

A leaf is the digest of a row's fields. Per source the leaves, in the order of doc_id,
are digested in runs of ``ARITY`` until one node is left, the subroot; the subroots, in
the order of their sources, likewise give the root. Every level is one aggregation
keyed by (source, run), so a source that holds a third of all rows is spread like any
other.

Proofs need no walk up the tree. A node at first holds the siblings of its own run, a
segment of distance one, and points to its parent. In round k the nodes whose level is
a multiple of 2^(k+1) join the nodes they point to, 2^k levels up, append their segment
and take over their pointer: the distance doubles until every leaf has reached the root.
Only the levels that a later round reads take part, so round k joins n leaves with
n / ARITY^(2^k) nodes. A node is pointed to by ARITY^(2^k) leaves; where the upper side
has few rows (``BROADCAST_NODES``, counted) it goes to every task, otherwise no key
holds more than one part in ``BROADCAST_NODES`` of the leaves. Subroots enter with
their own proof through the tree of sources already attached and are the ends of the
jumps inside their source.

Defined cases: null fields are written as ``-``; null doc_ids come first and rows that
share an id follow each other in the order of their leaf digests (equal rows have equal
leaves); a null source is a source, before all others; an empty table has no leaf, no
root and gives no row; other columns, also with clashing names, are ignored; texts are
digested whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_running_sum
from ..session import checkpoint_dir
from .common import exact_columns, read_table, shuffle_partitions, written

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_NODES = 2_000
_STEP = "array<struct<left: array<binary>, right: array<binary>>>"


# --- digests ------------------------------------------------------------------------------

def digest(parts: Column) -> Column:
    """SHA-256 (32 bytes) of a text or of bytes."""
    return F.unhex(F.sha2(parts, 256))


def hexed(d: Column) -> Column:
    return F.lower(F.hex(d))


def joined_hex(digests: Column) -> Column:
    """The digests of an array as hexadecimal text, concatenated."""
    return F.array_join(F.transform(digests, hexed), "")


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return digest(F.concat(*[field(columns[name]) for name in FIELDS]))


# --- leaves in order ----------------------------------------------------------------------

def placed_leaves(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (doc_id, source, leaf and others) with ``src`` (number of the source in
    order), ``pos`` (place in the source) and ``n`` (leaves of the source), and the table
    (src, n) of sources. Rows are cut into ranges; a range adds the counts of the ranges
    before it, source by source, so no source passes through one task."""
    spark = leaves.sparkSession
    checkpoint_dir(spark)
    # null first, then bytewise: a null is the empty key, a name keeps its order behind a mark
    keyed = leaves.withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    ranged = (keyed.repartitionByRange(shuffle_partitions(spark), "skey", "doc_id", "leaf")
              .withColumn("part", F.spark_partition_id()).checkpoint(eager=True))
    earlier = Window.partitionBy("skey").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = (ranged.groupBy("part", "skey").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))))
    sources = written(global_running_sum(
        ranged.groupBy("skey").agg(F.count(F.lit(1)).alias("n")), [F.col("skey")],
        F.lit(1).cast("bigint"), "number").select(
            "skey", "n", (F.col("number") - 1).alias("src")), "merkle-sources")
    parts = written(counts.join(sources, "skey"), "merkle-parts").drop("rows")
    inside = Window.partitionBy("part", "skey").orderBy("doc_id", "leaf")
    placed = (ranged.join(parts, ["part", "skey"])
              .withColumn("pos", F.col("before") + F.row_number().over(inside) - 1)
              .drop("part", "skey", "before"))
    return placed, sources.select("src", "n")


# --- the tree -----------------------------------------------------------------------------

def _runs(level: DataFrame, payload: list[str]) -> DataFrame:
    """One row per run of a level: (src, pos of the parent, n of the parent's level,
    members in order)."""
    return (level.withColumn("slot", (F.col("pos") % ARITY).cast("int"))
            .withColumn("up", F.floor(F.col("pos") / ARITY).cast("bigint"))
            .groupBy("src", "up").agg(
                F.array_sort(F.collect_list(F.struct("slot", "digest", *payload))).alias("run"),
                F.ceil(F.max("n") / ARITY).cast("bigint").alias("n"))
            .withColumnRenamed("up", "pos"))


def _members(runs: DataFrame, payload: list[str]) -> DataFrame:
    """The members of runs as nodes: segment of distance one, pointer to the parent."""
    digests = F.col("run.digest")
    return (runs.select("src", F.col("pos").alias("ptr"), digests.alias("d"),
                        F.posexplode("run").alias("i", "m"))
            .select("src", (F.col("ptr") * ARITY + F.col("i")).alias("pos"), "ptr",
                    *[F.col(f"m.{c}").alias(c) for c in ("digest", *payload)],
                    F.array(F.struct(F.slice("d", F.lit(1), F.col("i")).alias("left"),
                                     F.slice("d", F.col("i") + 2, F.lit(ARITY)).alias("right")))
                    .cast(_STEP).alias("seg")))


def tree(leaves: DataFrame, payload: list[str], most: int) -> tuple[DataFrame, list, DataFrame]:
    """Levels of the trees over ``leaves`` (src, pos, n, digest, payload), the largest of
    which has ``most`` leaves: (leaf nodes, inner nodes level by level, tops). Nodes
    without a parent are tops (src, level, digest); leaves that stand alone have a null
    ptr."""
    payload_of = payload
    level, at, inner, tops = leaves, 0, [], []
    width = most
    while width > 1:
        runs = written(_runs(level.where("n > 1"), payload_of), f"merkle-runs-{at}")
        nodes = _members(runs, payload_of)
        if at == 0:
            leaf_nodes = nodes
        else:
            inner.append(nodes)
        level = runs.select("src", "pos", "n", digest(joined_hex(F.col("run.digest"))).alias("digest"))
        at, width, payload_of = at + 1, -(-width // ARITY), []
        tops.append(level.where("n = 1").select("src", F.lit(at).alias("level"), "digest"))
    alone = leaves.where("n = 1")
    tops.insert(0, alone.select("src", F.lit(0).alias("level"), "digest"))
    lone = alone.select("src", "pos", F.lit(None).cast("bigint").alias("ptr"), "digest", *payload,
                        F.array().cast(_STEP).alias("seg"))
    leaf_nodes = leaf_nodes.unionByName(lone) if at else lone
    return leaf_nodes, inner, reduce(DataFrame.unionByName, tops)


# --- proofs -------------------------------------------------------------------------------

def few_rows(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_NODES else df


def _jump(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Append to each segment that of the node pointed to, and take over its pointer;
    nodes that have arrived (null ptr) stay as they are."""
    to = upper.select(F.col("src"), F.col("pos").alias("ptr"), F.col("ptr").alias("on"),
                      F.col("seg").alias("more"), F.col("subroot").alias("top"))
    rest = [c for c in lower.columns if c not in ("src", "ptr", "seg", "subroot")]
    moved = lower.where("ptr IS NOT NULL").join(to, ["src", "ptr"]).select(
        "src", *rest, F.col("on").alias("ptr"), F.concat("seg", "more").alias("seg"),
        F.col("top").alias("subroot"))
    return lower.where("ptr IS NULL").select(*moved.columns).unionByName(moved)


def proofs(leaf_nodes: DataFrame, inner: list[DataFrame], ends: DataFrame) -> DataFrame:
    """``leaf_nodes`` with ``seg`` (siblings of every level up to the root) and
    ``subroot``. ``ends`` (src, level, subroot, seg): the tops, whose segment leads on
    from there."""
    none = F.lit(None).cast("binary")
    arrived = ends.select("src", "level", F.lit(0).cast("bigint").alias("pos"),
                          F.lit(None).cast("bigint").alias("ptr"), "seg", "subroot")
    lone = (leaf_nodes.where("ptr IS NULL").drop("seg")
            .join(arrived.where("level = 0").select("src", "seg", "subroot"), "src"))
    leaves = leaf_nodes.where("ptr IS NOT NULL").withColumn("subroot", none)
    if not inner and not leaves.limit(1).count():
        return lone
    nodes = arrived.where("level > 0")
    for i, level in enumerate(inner):
        nodes = nodes.unionByName(level.select(
            "src", F.lit(i + 1).alias("level"), "pos", "ptr", "seg", none.alias("subroot")))
    nodes = written(nodes, "merkle-nodes")
    top, k = len(inner) + 1, 0
    while 2 ** k <= top:
        step = 2 ** k
        leaves = _jump(leaves, few_rows(nodes.where(F.col("level") == step)))
        kept = nodes.where(F.col("level") % (2 * step) == 0)
        if 2 * step <= top:
            # each level's nodes point at the level `step` above, also for the next round
            reach = nodes.where(F.col("level") % (2 * step) == step)
            nodes = written(_jump_levels(kept, reach, step), "merkle-nodes")
            leaves = written(leaves, "merkle-leaves")
        k += 1
    return leaves.unionByName(lone.select(*leaves.columns))


def _jump_levels(lower: DataFrame, upper: DataFrame, step: int) -> DataFrame:
    """``_jump`` of the nodes of many levels, each to the level ``step`` above it."""
    to = upper.select("src", (F.col("level") - step).alias("level"), F.col("pos").alias("ptr"),
                      F.col("ptr").alias("on"), F.col("seg").alias("more"),
                      F.col("subroot").alias("top"))
    moved = lower.where("ptr IS NOT NULL").join(to, ["src", "level", "ptr"]).select(
        "src", "level", "pos", F.col("on").alias("ptr"), F.concat("seg", "more").alias("seg"),
        F.col("top").alias("subroot"))
    return lower.where("ptr IS NULL").unionByName(moved)


def folded(leaf: Column, seg: Column) -> Column:
    """The root that a leaf and the siblings of its levels give."""
    return F.aggregate(seg, leaf, lambda acc, s: digest(F.concat(
        joined_hex(s["left"]), hexed(acc), joined_hex(s["right"]))))


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, other columns) with ``subroot``, ``root`` and
    ``seg``, the siblings per level from the leaf to the root (32-byte digests)."""
    payload = [c for c in leaves.columns if c not in ("leaf", "source")]
    placed, sources = placed_leaves(leaves)
    largest = sources.agg(F.max("n"), F.count("*")).first()
    if largest[0] is None:
        return (leaves.drop("source").withColumn("subroot", F.col("leaf"))
                .withColumn("root", F.col("leaf")).withColumn("seg", F.array().cast(_STEP)).limit(0))
    placed = written(placed.select("src", "pos", "n", F.col("leaf").alias("digest"), *payload),
                     "merkle-placed")
    leaf_nodes, inner, tops = tree(placed, payload, largest[0])
    tops = written(tops, "merkle-subroots")
    # the tree of sources: its leaves are the subroots, in the order of the sources
    above = tops.select(F.lit(0).cast("bigint").alias("src"), F.col("src").alias("pos"),
                        F.lit(largest[1]).cast("bigint").alias("n"), "digest", "level")
    top_leaves, top_inner, top = tree(above, ["level"], largest[1])
    root = top.first()["digest"]
    ends = written(
        proofs(top_leaves, top_inner, top.select(
            "src", F.lit(0 if largest[1] == 1 else len(top_inner) + 1).alias("level"),
            F.col("digest").alias("subroot"), F.array().cast(_STEP).alias("seg")))
        .select(F.col("pos").alias("src"), "level", F.col("digest").alias("subroot"), "seg"),
        "merkle-ends")
    found = proofs(leaf_nodes, inner, ends)
    return found.select(*payload, F.col("digest").alias("leaf"), "subroot",
                        F.lit(bytes(root)).alias("root"), "seg")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and proofs of ``documents``; each proof is checked on a tampered row."""
    docs = exact_columns(read_table(spark, sf_dir, "documents"), *FIELDS)
    return checked_manifest(docs)


def checked_manifest(docs: DataFrame) -> DataFrame:
    """Per row: leaf, subroot, root, digest of its proof, and what the proof gives for the
    row after tampering: rows whose id's crc32 is even lose the line ends of their text."""
    columns = {c: F.col(c) for c in FIELDS}
    tampered = columns | {"text": F.translate("text", "\n", "")}
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = written(docs.select(
        "doc_id", "source", leaf_digest(columns).alias("leaf"),
        F.when(even & F.contains("text", F.lit("\n")), leaf_digest(tampered)).alias("changed")),
        "merkle-leaf-digests")
    m = manifest(leaves)
    again = folded(F.coalesce("changed", "leaf"), F.col("seg"))
    siblings = F.flatten(F.transform("seg", lambda s: F.concat(s["left"], s["right"])))
    return (m.withColumn("folded", again)
            .select("doc_id", *[hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                    F.sha2(joined_hex(siblings), 256).alias("proof_sha256"),
                    hexed(F.col("folded")).alias("folded_root"),
                    (F.col("folded") == F.col("root")).alias("verified")))
