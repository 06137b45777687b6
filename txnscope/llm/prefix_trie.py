"""Prefix trie of conversations as balanced parentheses, shard by shard.

A conversation is a path: 20 bytes per turn (16 of a digest of role and text, 4 of the
text's code points), so the order of the bytes is the order of a depth-first walk.
Equal paths are one path with a count of members. Paths are range-partitioned in that
order and each task cuts its run of paths into shards. A shard's trie is one bit string
of parentheses, an opening one per node before its subtree:

* ``find_close`` delimits a subtree; it looks for the next smaller excess through the
  minima of blocks of 64 positions and a tree of minima above them;
* the leaves of a subtree are the pairs ``()`` in its range, by rank;
* members and savings of a subtree are differences of cumulative arrays.

Only nodes on the first and last path of a shard can be shared with its neighbours. This
spine leaves the shard as two paths that carry, per node, what the closed part of its
subtree holds, and the spines of all shards are again sorted paths: they are merged by
the same step, level after level, until one shard is left. So no task holds more than a
shard (``SHARD_TURNS`` turns, or ``FAN_IN`` paths where paths are longer).

The members of a node are hashed in order in one pass over packed blocks of ids: a
SHA-256 has no parallel form, but only the ids take part, in blocks, and none is kept.

Defined cases: rows without conv_id belong to no conversation; null roles and texts are
empty; a null turn comes first and rows that share conv_id and turn follow in the order
of their digests (repeated rows are turns of their own); an empty table has no node and
gives no row; other columns are ignored; texts are digested whole. A conversation's path
(20 bytes per turn) is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import bounded_batches, exact_columns, read_table, shuffle_partitions, written

STEP = 20                 # bytes of a turn in a path
BLOCK = 64                # positions of a block of excesses
SHARD_TURNS = 50_000
FAN_IN = 64               # above 4: a shard of so many paths leaves two
IDS_PER_BLOCK = 8_192
#: Turns of the conversation a family starts with that others may take over.
MOST_SHARED = 6
ROOT = bytes(16)
_NONE = bytes(32)
_BIG = np.iinfo(np.int64).max


# --- balanced parentheses -----------------------------------------------------------------

class Parentheses:
    """A balanced string of parentheses (1 opens) with the directories of its queries."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        n = len(bits)
        blocks = max(1, -(-n // BLOCK))
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        padded = np.full(blocks * BLOCK, _BIG, np.int64)
        padded[:n] = self.excess
        self.rows = padded.reshape(blocks, BLOCK)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        tree = np.full(2 * self.leaves, _BIG, np.int64)     # tree[1] is the whole string
        tree[self.leaves:self.leaves + blocks] = self.rows.min(axis=1)
        for size in (self.leaves >> s for s in range(1, self.leaves.bit_length())):
            at = np.arange(size, 2 * size)
            tree[at] = np.minimum(tree[2 * at], tree[2 * at + 1])
        self.tree = tree

    def opens(self) -> np.ndarray:
        return np.flatnonzero(self.bits)

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Positions of the parentheses that close those at ``opens``."""
        goal = self.excess[opens] - 1               # the first excess as small, further on
        block = opens // BLOCK
        after = np.arange(BLOCK)[None, :] > (opens % BLOCK)[:, None]
        hit = after & (self.rows[block] <= goal[:, None])
        out = block * BLOCK + hit.argmax(axis=1)
        open_ = np.flatnonzero(~hit.any(axis=1))
        if not len(open_):
            return out
        goal, node = goal[open_], block[open_] + self.leaves
        climbing = np.ones(len(open_), bool)
        while climbing.any():                       # up to a right sibling that holds it
            is_left = node % 2 == 0
            here = climbing & is_left & (self.tree[np.minimum(node + 1, len(self.tree) - 1)] <= goal)
            node = np.where(here, node + 1, np.where(climbing, node // 2, node))
            climbing &= ~here
        while (below := node < self.leaves).any():  # down to the first block that holds it
            left = np.where(below, 2 * node, 0)
            node = np.where(below, np.where(self.tree[left] <= goal, left, left + 1), node)
        block = node - self.leaves
        out[open_] = block * BLOCK + (self.rows[block] <= goal[:, None]).argmax(axis=1)
        return out


def range_minima(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Smallest of ``values[first:first + size]`` for each range, by doubled windows."""
    out = np.empty(len(first), np.int64)
    level = np.frexp(size.astype(np.float64))[1] - 1          # floor(log2(size))
    window = values
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(window[first[at]], window[first[at] + size[at] - (1 << k)])
        if len(window) > 1 << k:
            window = np.minimum(window[:len(window) - (1 << k)], window[1 << k:])
    return out


# --- one shard ----------------------------------------------------------------------------

def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b)) // STEP * STEP
    if a[:n] == b[:n]:
        return n // STEP
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax()) // STEP


class Shard:
    """The trie of paths in order. An item is (path, closed, ends): ``closed`` has per
    node of the path (the root first) members, smallest member, children, leaves and
    savings of the closed part of its subtree; ``ends`` the digest of the members that
    end there (32 zero bytes: none)."""

    def __init__(self, items: list[tuple]):
        self.items = items
        depth, parent, length, hashes, at = [0], [-1], [0], [ROOT], []
        bits, stack, before = bytearray(b"\x01"), [0], b""
        for path, _, _ in items:
            keep = _shared(before, path)
            bits += b"\x00" * (len(stack) - 1 - keep)
            del stack[keep + 1:]
            for d in range(keep, len(path) // STEP):
                turn = path[d * STEP:(d + 1) * STEP]
                parent.append(stack[-1])
                hashes.append(hashlib.blake2b(hashes[stack[-1]] + turn, digest_size=16).digest())
                length.append(int.from_bytes(turn[16:], "big"))
                depth.append(d + 1)
                stack.append(len(depth) - 1)
            bits += b"\x01" * (len(path) // STEP - keep)
            at.append(np.array(stack))
            before = path
        bits += b"\x00" * len(stack)
        self.depth, self.parent, self.hashes = np.array(depth), np.array(parent), hashes
        self.at, self.tree = at, Parentheses(np.frombuffer(bytes(bits), np.uint8))
        n = len(depth)
        members, low, kids, leaves, saved = (np.zeros(n, np.int64) for _ in range(5))
        low[:] = _BIG
        self.ends = {}
        for nodes, (_, closed, ends) in zip(at, items):
            members[nodes] += closed[0]
            low[nodes] = np.minimum(low[nodes], closed[1])
            kids[nodes] += closed[2]
            leaves[nodes] += closed[3]
            saved[nodes] += closed[4]
            for i in range(0, len(ends), 32):
                if ends[i:i + 32] != _NONE:
                    self.ends[int(nodes[i // 32])] = ends[i:i + 32]
        self.closed = (members, low, kids, leaves, saved)
        opens = self.tree.opens()
        closes = self.tree.find_close(opens)
        first, size = np.arange(n), (closes - opens + 1) // 2

        def of_subtrees(weights: np.ndarray) -> np.ndarray:
            cumulative = np.concatenate([[0], np.cumsum(weights)])
            return cumulative[first + size] - cumulative[first]
        self.n_convs = of_subtrees(members)
        self.conv_id = range_minima(low, first, size)
        self.n_children = kids + np.bincount(self.parent[1:], minlength=n)
        pairs = (closes == opens + 1) & (kids == 0)       # a childless node: "()"
        self.n_leaves = of_subtrees(leaves + pairs)
        self.saved = of_subtrees(saved + np.maximum(self.n_convs - 1, 0) * np.array(length))

    def spine(self) -> np.ndarray:
        """Nodes on the first and the last path."""
        return np.unique(np.concatenate([self.at[0], self.at[-1]]))

    def skeleton(self) -> list[tuple]:
        """The spine as one or two items."""
        n = len(self.depth)
        on = np.zeros(n, bool)
        on[self.spine()] = True
        members, low, kids, leaves, saved = (x.copy() for x in self.closed)
        inside = np.flatnonzero(~on)
        shut = inside[on[self.parent[inside]]]           # closed children of the spine
        up = self.parent[shut]
        np.add.at(members, up, self.n_convs[shut])
        np.minimum.at(low, up, self.conv_id[shut])
        np.add.at(kids, up, 1)
        np.add.at(leaves, up, self.n_leaves[shut])
        np.add.at(saved, up, self.saved[shut])
        out, told = [], np.zeros(n, bool)
        for nodes, path in {self.items[i][0]: (self.at[i], self.items[i][0])
                            for i in (0, len(self.items) - 1)}.values():
            new = ~told[nodes]
            closed = np.stack([x[nodes] * new for x in (members, low, kids, leaves, saved)])
            closed[1][~new] = _BIG
            ends = b"".join(self.ends.get(int(v), _NONE) if fresh else _NONE
                            for v, fresh in zip(nodes, new))
            out.append((path, closed, ends))
            told[nodes] = True
        return out


# --- shards of a sorted table of paths ------------------------------------------------------

_OUT = ("kind int, shard long, hash binary, parent binary, depth long, conv_id long, "
        "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends binary, path binary, closed binary")
NODE, SPINE, ITEM, BITS = 0, 1, 2, 3


def _rows(shard: Shard, key: int, last: bool) -> pd.DataFrame:
    n = len(shard.depth)
    spine = np.zeros(0, np.int64) if last else shard.spine()
    on = np.zeros(n, bool)
    on[spine] = True
    shut = np.flatnonzero(~on)
    up = shard.parent[shut]
    known = (up >= 0) & ~on[up]
    parent_conv = pd.array(shard.conv_id[np.maximum(up, 0)], "Int64")
    parent_conv[~known] = pd.NA
    asking = (up >= 0) & on[up]
    nodes = pd.DataFrame({
        "kind": NODE, "shard": key, "hash": [shard.hashes[i] for i in shut],
        "parent": [shard.hashes[p] if a else None for p, a in zip(up, asking)],
        "depth": shard.depth[shut], "conv_id": shard.conv_id[shut], "parent_conv_id": parent_conv,
        "n_convs": shard.n_convs[shut], "n_children": shard.n_children[shut],
        "n_leaves": shard.n_leaves[shut], "saved_tokens": shard.saved[shut],
        "ends": [shard.ends.get(int(i)) for i in shut]})
    asked = np.unique(up[asking])
    other = [{"kind": SPINE, "shard": key, "hash": shard.hashes[i]} for i in asked]
    other += [{"kind": BITS, "shard": key, "path": shard.items[0][0],
               "closed": np.packbits(shard.tree.bits).tobytes()}]
    if not last:
        other += [{"kind": ITEM, "shard": key, "path": path, "closed": closed.tobytes(),
                   "ends": ends} for path, closed, ends in shard.skeleton()]
    names = [c.split()[0] for c in _OUT.split(", ")]
    frames = [f.reindex(columns=names) for f in (nodes, pd.DataFrame(other)) if len(f)]
    longs = [c.split()[0] for c in _OUT.split(", ") if c.endswith("long")]
    return pd.concat([f.astype({c: "Int64" for c in longs}) for f in frames], ignore_index=True)


def shards(items: DataFrame, level: int, last: bool) -> DataFrame:
    """Closed nodes, spines and parentheses of the shards of ``items`` (path, closed,
    ends), whose partitions are sorted by path."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        held, turns, number = [], 0, 0
        base = (level << 56) + (TaskContext.get().partitionId() << 28)
        for b in batches:
            for path, closed, ends in zip(b["path"], b["closed"], b["ends"]):
                held.append((path, np.frombuffer(closed, np.int64).reshape(5, -1), ends))
                turns += len(path) // STEP + 1
                if not last and turns >= SHARD_TURNS and len(held) >= FAN_IN:
                    yield _rows(Shard(held), base + number, last)
                    held, turns, number = [], 0, number + 1
        if held:
            yield _rows(Shard(held), base + number, last)
    return items.select("path", "closed", "ends").mapInPandas(run, _OUT)


def _first_items(paths: DataFrame) -> DataFrame:
    """Distinct paths (path, n, low, ends) as items: members end at the tip."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, n, low, ends in zip(b["path"], b["n"], b["low"], b["ends"]):
                closed = np.zeros((5, len(path) // STEP + 1), np.int64)
                closed[1], closed[0, -1], closed[1, -1] = _BIG, n, low
                rows.append((path, closed.tobytes(), _NONE * (closed.shape[1] - 1) + ends))
            yield pd.DataFrame(rows, columns=["path", "closed", "ends"])
    return paths.mapInPandas(run, "path binary, closed binary, ends binary")


def _ordered(items: DataFrame, partitions: int) -> DataFrame:
    if partitions == 1:
        return items.coalesce(1).sortWithinPartitions("path")
    return items.repartitionByRange(partitions, "path").sortWithinPartitions("path")


def trie_nodes(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, parentheses) of the trie over distinct ``paths`` (path, n, low, ends: its
    members' number, smallest, digest). nodes: hash, depth, conv_id, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends (null: no member ends there)."""
    bounded_batches(paths.sparkSession)
    spark = paths.sparkSession
    level, tables, items = 0, [], written(paths, "trie-paths")
    partitions = max(2, shuffle_partitions(spark))
    while True:
        last = partitions == 1
        ordered = _ordered(items, partitions)
        if level == 0:
            ordered = _first_items(ordered)
        found = written(shards(ordered, level, last), "trie-shards")
        tables.append(found)
        if last:
            break
        items = found.where(F.col("kind") == ITEM)
        size = items.agg(F.coalesce(F.sum(F.length("path") / STEP + 1), F.lit(0)),
                         F.count("*")).first()
        level += 1
        few = size[0] <= SHARD_TURNS or size[1] <= FAN_IN
        partitions = 1 if few else max(2, min(partitions // 2, int(size[0] // SHARD_TURNS) + 1))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    nodes = out.where(F.col("kind") == NODE)
    parentheses = out.where(F.col("kind") == BITS).select(
        "shard", F.col("path").alias("first_path"), F.col("closed").alias("bits"))
    # children of spine nodes learn their parent's name: the key holds the shard, so the
    # children of the root are spread over the shards
    later = tables[1].where(F.col("kind") == NODE)
    for t in tables[2:]:
        later = later.unionByName(t.where(F.col("kind") == NODE))
    names = (out.where(F.col("kind") == SPINE).select("shard", F.col("hash").alias("parent"))
             .join(later.select(F.col("hash").alias("parent"), F.col("conv_id").alias("named")),
                   "parent"))
    names = written(names, "trie-spines")
    return (nodes.where("parent IS NULL").withColumn("named", F.lit(None).cast("bigint"))
            .unionByName(nodes.where("parent IS NOT NULL").join(names, ["shard", "parent"])
                         .select(*nodes.columns, "named"))
            .withColumn("parent_conv_id", F.coalesce("named", "parent_conv_id"))
            .drop("kind", "shard", "parent", "path", "closed", "named")), parentheses


# --- conversations --------------------------------------------------------------------------

def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the turns of each conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role,
                                         text), 256), 1, 32)
    step = F.concat(F.lower(digest), F.lower(F.lpad(F.hex(F.length(text).cast("bigint")), 8, "0")))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"),
                 F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
                 step.alias("step")).alias("t"))
    return (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.unhex(F.array_join("t.step", "")).alias("path")))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Each conversation with the first h turns of its family's first conversation in
    place of its own first h (a family: up to 100 ids)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    heads = paths.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("family"), F.expr(f"substring(path, 1, {STEP * (MOST_SHARED - 1)})")
        .alias("head"))
    return (paths.withColumn("h", h.cast("int"))
            .withColumn("family", F.col("conv_id") - F.col("conv_id") % 100)
            .join(heads, "family", "left")
            .select("conv_id", F.concat(
                F.expr(f"substring(coalesce(head, X''), 1, h * {STEP})"),
                F.expr(f"substring(path, h * {STEP} + 1)")).alias("path")))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """(path, n, low, ends): equal paths once, with the number, the smallest and the digest
    of the conversations that have it. Ids are packed into blocks inside ranges of
    (path, id), so a path that a third of all conversations share arrives as blocks."""
    spark = paths.sparkSession
    checkpoint_dir(spark)
    keyed = paths.withColumn("key", F.unhex(F.substring(F.sha2("path", 256), 1, 32)))
    ids = (keyed.select("key", "conv_id")
           .repartitionByRange(shuffle_partitions(spark), "key", "conv_id")
           .sortWithinPartitions("key", "conv_id"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cut = b["key"].ne(b["key"].shift()).cumsum() if len(b) else []
            out = [(g["key"].iloc[0], len(g), g["conv_id"].iloc[0],
                    ",".join(map(str, g["conv_id"])))
                   for i in range(0, len(b), IDS_PER_BLOCK)
                   for _, g in b.iloc[i:i + IDS_PER_BLOCK].groupby(
                       cut.iloc[i:i + IDS_PER_BLOCK], sort=False)]
            yield pd.DataFrame(out, columns=["key", "n", "low", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, digest, n, low = None, None, 0, 0
        for b in batches:
            out = []
            for key, count, first, ids_ in zip(b["key"], b["n"], b["low"], b["ids"]):
                if key != at:
                    if at is not None:
                        out.append((at, n, low, digest.digest()))
                    at, digest, n, low = key, hashlib.sha256(ids_.encode()), count, first
                else:
                    digest.update(b"," + ids_.encode())
                    n += count
            yield pd.DataFrame(out, columns=["key", "n", "low", "ends"])
        if at is not None:
            yield pd.DataFrame([(at, n, low, digest.digest())], columns=["key", "n", "low", "ends"])
    blocks = ids.mapInPandas(pack, "key binary, n long, low long, ids string")
    members = (blocks.repartition("key").sortWithinPartitions("key", "low")
               .mapInPandas(hashed, "key binary, n long, low long, ends binary"))
    return (members.join(keyed.select("key", F.col("conv_id").alias("low"), "path"), ["key", "low"])
            .select("path", "n", "low", "ends"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations."""
    paths = written(conversation_paths(conversations), "trie-conversations")
    nodes, _ = trie_nodes(distinct_paths(written(rebuilt(paths), "trie-rebuilt")))
    return nodes


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = exact_columns(read_table(spark, sf_dir, "conversations"),
                                  "conv_id", "turn", "role", "text")
    return prefix_trie(conversations).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
