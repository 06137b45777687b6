"""Exact Jaccard join of the documents' word shingles by a size-aware heavy-light method.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two sets link when
their Jaccard similarity is 0.8 or more, which for sizes n <= m means an intersection of
at least o(n, m) = ceil(4 (n + m) / 9) shingles and m <= 1.25 n.

* **Small sets** (at most ``x`` shingles) enumerate all their subsets of the fixed sizes
  o(n, m), under a key of (n, m, subset). Sets that meet under a key are links by
  construction, so every key only links its members to its smallest one on either side:
  work and output are linear in the keys.
* **Large sets** scan inverted lists. A list holds the sets that have the shingle among
  the first of their order (rare ones first, so only n - o + 1 of a set's shingles are
  listed, none that could be the first one shared). Every set first counts its overlap
  with the set of its lists that most of them share; that joins most of a group of near
  copies. The lists that still hold several components are then settled: their sets are
  cut into blocks, and a set of a smaller component visits each block that holds a set of
  a larger one under a shared shingle, where it scans the inverted lists of the block and
  counts its overlap with all of them at once.
* ``x`` is the size at which enumerating costs more than listing, both counted on the
  sizes of the sets at hand.

Equal sets are one set throughout. Before anything is listed, sets that cannot have a
partner go: a set with a partner has all but n/5 of its shingles in another set, also
among the shingles in the lower half of the hash range. One pass over the texts counts
these, dealt by ranges of hashes in packed blocks, and all texts take part. Which
shingles are frequent only orders the lists and never decides a link.

Defined cases: null texts are empty; documents without words have an empty set, n_shingles
0, and stand alone (even equal ones); under five words the whole sequence is one shingle;
rows that share an id are one document in the components and a row each in the result; a
document with a null id takes part and gets the smallest id it reaches (null where no id
does); an empty table gives no row; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import bounded_side
from .common import exact_columns, read_table, release_task_state, shuffle_partitions, written
from .order_minhash import components

K = 5
#: 100 * intersection >= 80 * union.
PART, WHOLE = 80, 100
#: Share of the hash range whose shingles are counted to find sets without a partner.
COUNTED = 0.5
#: Counted shingles, and rows, that are sorted and sent at once; bytes of text hashed at once.
CHUNK_SHINGLES, CHUNK_ROWS = 1_000_000, 100_000
PIECE = 1 << 21
#: Shingles in that many documents may move to the end of the order, the most frequent
#: ones up to so many: a table of fixed size for every task.
FREQUENT, MOST_FREQUENT = 64, 200_000
#: Largest size for which enumerating is considered.
MOST_SMALL = 24
#: Shingles of a block of sets that are indexed at once.
BLOCK_SHINGLES = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LIMIT = np.uint64(int(COUNTED * 2 ** 64))


# --- sizes --------------------------------------------------------------------------------

def overlap(n, m):
    """Least intersection of sets of sizes n and m that link: J i = n + m - i as integers."""
    return -(-PART * (n + m) // (PART + WHOLE))


def largest_partner(n: int) -> int:
    return n * WHOLE // PART


def smallest_partner(n: int) -> int:
    return -(-n * PART // WHOLE)


def listed(n):
    """How many of a set's first shingles are listed: enough for any partner."""
    return n - (-(-n * PART // WHOLE)) + 1


def subset_sizes(n: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) of all pairings of a set of size n."""
    up = [(n, m, overlap(n, m)) for m in range(n, largest_partner(n) + 1)]
    down = [(m, n, overlap(m, n)) for m in range(smallest_partner(n), n)]
    return [p for p in up + down if p[2] <= p[0]]


def boundary(counts: dict[int, int], list_length: float) -> int:
    """The size up to which enumerating is cheaper: the sum over sizes of the subsets of
    the small and the listed shingles, met by ``list_length`` others, of the large."""
    def enumerated(n):
        return sum(comb(n, o) for _, _, o in subset_sizes(n))

    def scanned(n):
        return listed(n) * (1.0 + list_length) + n
    sizes = range(0, MOST_SMALL + 1)
    cost = [sum(counts.get(n, 0) * enumerated(n) for n in range(1, x + 1))
            + sum(counts.get(n, 0) * scanned(n) for n in range(x + 1, MOST_SMALL + 1))
            for x in sizes]
    return int(np.argmin(cost))


# --- shingles -----------------------------------------------------------------------------

def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


@lru_cache(1)
def _tables():
    """Byte values, powers of an odd number and of its inverse modulo 2^64."""
    base = 0x5851F42D4C957F2D
    values = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64)
    up, down = (np.full(PIECE, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return values, np.cumprod(up), np.cumprod(down)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _long_word_end(whole: np.ndarray, at: int) -> int:
    while at < len(whole):
        spaces = np.flatnonzero(_SPACE[whole[at:at + PIECE]])
        if len(spaces):
            return at + int(spaces[0])
        at += PIECE
    return len(whole)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the words of a byte string, A-Z lower-cased."""
    hashes, places, at = [], [], 0
    values, up, down = _tables()
    whole = np.frombuffer(raw, np.uint8)
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end - at == PIECE:                         # end behind a word, unless one fills it
            spaces = np.flatnonzero(_SPACE[whole[at:end]])
            if not len(spaces):
                stop = _long_word_end(whole, end)
                digest = hashlib.blake2b(raw[at:stop].lower(), digest_size=8).digest()
                hashes.append(np.frombuffer(digest, np.uint64))
                places.append(np.array([at]))
                at = stop
                continue
            end = at + int(spaces[-1]) + 1
        a = np.frombuffer(raw[at:end].lower(), np.uint8)
        word = ~_SPACE[a]
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(values[a] * up[:len(a)])])
        h = (total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)
        hashes.append(_scramble(h))
        places.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _sequence(h: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(h[0]), len(h), np.uint64)
    for i, x in enumerate(h):
        out = _scramble(out * _MIX + x + np.uint64(i))
    return out


def shingle_sets(texts: list) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    held, size = [], 0
    for t in texts:
        held.append((t or "").encode())
        size += len(held[-1]) + 1
        if size >= PIECE:
            yield from _sets(held)
            held, size = [], 0
    if held:
        yield from _sets(held)


def _sets(raws: list[bytes]) -> Iterator[np.ndarray]:
    starts = np.cumsum([0] + [len(r) + 1 for r in raws])
    h, place = word_hashes(b"\n".join(raws))
    cut = np.searchsorted(place, starts)
    n = len(h) - K + 1
    grams = _sequence([h[i:i + n] for i in range(K)]) if n > 0 else np.zeros(0, np.uint64)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if hi - lo >= K:
            s = np.sort(grams[lo:hi - K + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif hi > lo:
            yield _sequence([h[i:i + 1] for i in range(lo, hi)])
        else:
            yield h[:0]


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


# --- sets without a partner ------------------------------------------------------------------

def _pack(x: np.ndarray, width: int) -> bytes:
    """Integers as compressed byte planes."""
    import zstandard
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(blob: bytes, width: int) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()


_COUNTS = ("kind int, chunk long, bucket long, row binary, set int, key binary, n int, "
           "counted int, hashes binary, sets binary")
DOC, LIST, FOUND, OFTEN = 0, 1, 2, 3
_NAMES = [c.split()[0] for c in _COUNTS.split(", ")]


def _frame(**columns) -> pd.DataFrame:
    rows = max(len(v) for v in columns.values() if not isinstance(v, int))
    out = pd.DataFrame({c: columns.get(c) for c in _NAMES}, index=range(rows))
    return out.astype({c: "Int64" for c in ("chunk", "bucket")}
                      | {c: "Int32" for c in ("kind", "set", "n", "counted")})


def counted_chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of documents, and per chunk of a task and bucket of hashes the counted
    shingles with the number of their set in the chunk."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        release_task_state()
        base, number = TaskContext.get().partitionId() << 24, 0
        rows, grams, known, size = [], [], {}, 0

        def sent(chunk):
            named, sets, keys, n, counted = zip(*rows)
            yield _frame(kind=DOC, chunk=chunk, bucket=-1, row=named, set=sets, key=keys, n=n,
                         counted=counted)
            if not size:
                return
            hashes = np.concatenate(grams)
            owner = np.repeat(np.arange(len(grams), dtype=np.uint32), [len(g) for g in grams])
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            width = int(_LIMIT) // buckets + 1
            cuts = np.searchsorted(hashes, np.arange(1, buckets, dtype=np.uint64) * np.uint64(width))
            out = []
            for b, (x, y) in enumerate(zip(np.split(hashes, cuts), np.split(owner, cuts))):
                if len(x):
                    steps = np.diff(np.concatenate([[np.uint64(0)], x]))
                    out.append((b, _pack(steps, 8), _pack(y, 4)))
            b, x, y = zip(*out)
            yield _frame(kind=LIST, chunk=chunk, bucket=b, hashes=x, sets=y)
        for batch in batches:
            named = batch[["bare", "doc_id", "text_hash"]].to_numpy(np.int64)
            for row, s in zip(named, shingle_sets(batch["text"].tolist())):
                key = set_key(s)
                at = known.get(key)
                if at is None:
                    at = known[key] = len(grams)
                    grams.append(s[:np.searchsorted(s, _LIMIT)])
                    size += len(grams[-1])
                rows.append((row.tobytes(), at, key, len(s), len(grams[at])))
                if size >= CHUNK_SHINGLES or len(rows) >= CHUNK_ROWS:
                    yield from sent(base + number)
                    rows, grams, known, size, number = [], [], {}, 0, number + 1
        if rows:
            yield from sent(base + number)
    # no nulls: they would pass through pandas as floats
    return docs.select(F.col("doc_id").isNull().cast("long").alias("bare"),
                       F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text_hash",
                       "text").mapInPandas(run, _COUNTS)


def repeated_in(chunks: DataFrame) -> DataFrame:
    """Per bucket: how many shingles of each set of each chunk are in another set too, and
    the frequent shingles."""
    def settled(lists):
        if not lists:
            return
        hashes = [np.cumsum(_unpack(h, 8), dtype=np.uint64) for _, h, _ in lists]
        owners = [_unpack(s, 4) for _, _, s in lists]
        all_ = np.concatenate(hashes)
        order = np.argsort(all_, kind="stable")
        ranked = all_[order]
        same = np.concatenate([[False], ranked[1:] == ranked[:-1], [False]])
        twice = np.empty(len(all_), bool)
        twice[order] = same[1:] | same[:-1]
        first = np.flatnonzero(~same[:-1])
        length = np.diff(np.append(first, len(ranked)))
        often = first[length >= FREQUENT]
        out, at = [], 0
        for (chunk, _, _), own in zip(lists, owners):
            held = own[twice[at:at + len(own)]]
            at += len(own)
            if len(held):
                count = np.bincount(held)
                sets = np.flatnonzero(count)
                out.append((chunk, _pack(sets, 4), _pack(count[sets], 4)))
        if out:
            chunk, sets, counts = zip(*out)
            yield _frame(kind=FOUND, chunk=chunk, sets=sets, hashes=counts)
        if len(often):
            yield _frame(kind=OFTEN, bucket=ranked[often].view(np.int64),
                         n=length[length >= FREQUENT])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists, at = [], None
        for b in batches:
            docs = b[b["kind"] == DOC]
            if len(docs):
                yield docs
            for bucket, chunk, h, s in b.loc[b["kind"] == LIST,
                                             ["bucket", "chunk", "hashes", "sets"]].itertuples(index=False):
                if bucket != at:
                    yield from settled(lists)
                    lists, at = [], bucket
                lists.append((chunk, h, s))
        yield from settled(lists)
    spread = F.when(F.col("kind") == DOC, F.col("chunk")).otherwise(F.col("bucket"))
    dealt = (chunks.withColumn("_to", spread).repartition(shuffle_partitions(chunks.sparkSession), "_to")
             .sortWithinPartitions("kind", "bucket").drop("_to"))
    return dealt.mapInPandas(run, _COUNTS)


def judged(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, n, open): ``open`` where the set may have a partner."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ended(docs, counts):
            d = pd.concat(docs)
            total = np.zeros(int(d["set"].max()) + 1, np.int64)
            for sets, count in counts:
                np.add.at(total, sets, count)
            n, counted, held = d["n"].to_numpy(int), d["counted"].to_numpy(int), total[d["set"].to_numpy(int)]
            row = np.frombuffer(b"".join(d["row"]), np.int64).reshape(-1, 3)
            doc_id = pd.arrays.IntegerArray(row[:, 1].copy(), row[:, 0] == 1)
            return pd.DataFrame({"doc_id": doc_id, "text_hash": row[:, 2], "key": d["key"].array, "n": n,
                                 "open": (n > 0) & (held >= counted - (n - -(-n * PART // WHOLE)))})
        docs, counts, at = [], [], None
        for b in batches:
            for chunk, g in b.groupby("chunk", sort=False):
                if chunk != at and at is not None:
                    yield ended(docs, counts)
                    docs, counts = [], []
                at = chunk
                own = g[g["kind"] == DOC]
                if len(own):
                    docs.append(own)
                f = g[g["kind"] == FOUND]
                counts += [(_unpack(s, 4), _unpack(c, 4)) for s, c in zip(f["sets"], f["hashes"])]
        if at is not None:
            yield ended(docs, counts)
    return (found.where(F.col("kind").isin(DOC, FOUND))
            .repartition(shuffle_partitions(found.sparkSession), "chunk")
            .sortWithinPartitions("chunk", "kind")
            .mapInPandas(run, "doc_id long, text_hash long, key binary, n int, open boolean"))


def frequent(found: DataFrame) -> np.ndarray:
    """The most frequent shingles, at most ``MOST_FREQUENT`` of them."""
    rows = (found.where(F.col("kind") == OFTEN).select("bucket", "n")
            .orderBy(F.desc("n"), "bucket").limit(MOST_FREQUENT).toPandas())
    return np.sort(rows["bucket"].to_numpy(np.int64).view(np.uint64))


# --- contents of the sets that remain ----------------------------------------------------------

def contents(docs: DataFrame, classes: DataFrame, late: np.ndarray) -> DataFrame:
    """(sid, n, grams) of the classes: their shingles in list order, the frequent ones last.
    Each is read from the row that names it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for b in batches:
            out = []
            for sid, key, s in zip(b["sid"], b["key"], shingle_sets(b["text"].tolist())):
                if sid in seen or set_key(s) != key:
                    continue
                seen.add(sid)
                if len(late):
                    is_late = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                    s = np.concatenate([s[~is_late], s[is_late]])
                out.append((sid, len(s), s.tobytes()))
            yield pd.DataFrame(out, columns=["sid", "n", "grams"])
    wanted = bounded_side(classes.select("sid", "key", "rep", F.col("text_hash").alias("of")))
    return (docs.join(wanted, (F.col("text_hash") == F.col("of"))
                      & F.col("doc_id").eqNullSafe(F.col("rep")))
            .select("sid", "key", "text").mapInPandas(run, "sid long, n int, grams binary"))


# --- small sets: enumerated subsets --------------------------------------------------------

def subset_links(sets: DataFrame) -> DataFrame:
    """Links of the small sets, each key's members to its smallest on the other side."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for sid, n, grams in zip(b["sid"], b["n"], b["grams"]):
                items = sorted(grams[i:i + 8] for i in range(0, len(grams), 8))
                for small, large, size in subset_sizes(n):
                    tag = b"%d,%d," % (small, large)
                    for chosen in combinations(items, size):
                        out.append((hashlib.blake2b(tag + b"".join(chosen), digest_size=16).digest(),
                                    n == small, n == large, sid))
                if len(out) > 200_000:
                    yield pd.DataFrame(out, columns=["key", "low", "high", "sid"])
                    out = []
            yield pd.DataFrame(out, columns=["key", "low", "high", "sid"])
    rows = written(sets.mapInPandas(run, "key binary, low boolean, high boolean, sid long"),
                   "join-subsets")
    ends = (rows.groupBy("key").agg(F.min(F.when(F.col("low"), F.col("sid"))).alias("a"),
                                    F.min(F.when(F.col("high"), F.col("sid"))).alias("b"),
                                    F.count(F.lit(1)).alias("rows"))
            .where("rows > 1 AND a IS NOT NULL AND b IS NOT NULL").drop("rows"))
    met = rows.join(ends, "key")
    return (met.where("low").select(F.col("sid").alias("x"), F.col("b").alias("y"))
            .unionByName(met.where("high").select(F.col("sid").alias("x"), F.col("a").alias("y")))
            .where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .distinct())


# --- large sets: inverted lists --------------------------------------------------------------

def inverted_lists(sets: DataFrame) -> DataFrame:
    """(gram, sid, n) of the listed shingles, in lists of at least two sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            heads = [np.frombuffer(g, np.int64)[:listed(n)] for g, n in zip(b["grams"], b["n"])]
            if heads:
                size = [len(h) for h in heads]
                yield pd.DataFrame({"gram": np.concatenate(heads), "sid": np.repeat(b["sid"], size),
                                    "n": np.repeat(b["n"], size)})
    rows = written(sets.mapInPandas(run, "gram long, sid long, n int"), "join-listed")
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    return written(rows.join(shared.select("gram"), "gram"), "join-lists")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets intersect enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for x, y in zip(p["x"], p["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= overlap(len(x), len(y)))
            yield p.loc[np.array(keep, bool), ["a", "b"]]
    # the smaller id, which many pairs may share, is joined while the rows are narrow
    return (pairs.join(sets.select(F.col("sid").alias("b"), F.col("grams").alias("y")), "b")
            .join(sets.select(F.col("sid").alias("a"), F.col("grams").alias("x")), "a")
            .select("a", "b", "x", "y").mapInPandas(run, "a long, b long"))


def voted_pairs(lists: DataFrame) -> DataFrame:
    """Each set with the smallest set of its lists that most of them share and whose size
    allows a link: one pair per set, so a group of near copies costs its size."""
    centers = lists.groupBy("gram").agg(F.min(F.struct("sid", "n")).alias("c"))
    low, high = F.least("n", "c.n"), F.greatest("n", "c.n")
    votes = (lists.join(centers, "gram").where((F.col("c.sid") != F.col("sid"))
                                               & (high * PART <= low * WHOLE))
             .groupBy("sid", F.col("c.sid").alias("center")).agg(F.count(F.lit(1)).alias("votes")))
    return (votes.groupBy("sid").agg(F.max_by("center", F.struct("votes", -F.col("center")))
                                     .alias("center"))
            .select(F.greatest("sid", "center").alias("a"), F.least("sid", "center").alias("b"))
            .distinct())


def _scanned(block: list, visitors: list) -> set[tuple[int, int]]:
    """Pairs of components that a link of a visitor with a set of the block joins. An item
    is (component, grams)."""
    sizes = np.array([len(g) for _, g in block])
    grams = np.concatenate([g for _, g in block])
    owner = np.repeat(np.arange(len(block)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    comps = np.array([c for c, _ in block])
    joined = set()
    for c, g in visitors:
        lo, hi = np.searchsorted(grams, g), np.searchsorted(grams, g, side="right")
        length = hi - lo
        total = int(length.sum())
        if not total:
            continue
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(total)
        shared = np.bincount(owner[at], minlength=len(block))
        need = -(-PART * (sizes + len(g)) // (PART + WHOLE))
        hit = (shared >= need) & (comps != c)
        joined.update((max(c, other), min(c, other)) for other in set(comps[hit].tolist()))
    return joined


def settled_links(lists: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of components that are linked, among those that share a list."""
    rows = (lists.join(known, lists["sid"] == known["id"], "left")
            .select("gram", "sid", "n", F.coalesce("component", "sid").alias("c")))
    mixed = rows.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    rows = written(rows.join(mixed.select("gram"), "gram"), "join-mixed")
    of_sets = rows.select("sid", "n", "c").distinct()
    weight = bounded_side(written(of_sets.groupBy("c").agg(F.count(F.lit(1)).alias("weight")),
                                  "join-weights"))
    # blocks: sets whose lists have the same largest component lie side by side
    home = rows.join(weight, "c").groupBy("gram").agg(F.max(F.struct("weight", "c")).alias("top"))
    near = rows.join(home, "gram").groupBy("sid").agg(F.max("top").alias("top"))
    placed = written(of_sets.join(weight, "c").join(
        near.select("sid", F.col("top.c").alias("group")), "sid"), "join-near")
    shingles = bounded_side(written(placed.groupBy("group").agg(
        F.sum(F.col("n").cast("bigint")).alias("total")), "join-groups"))
    placed = written(placed.join(shingles, "group").select(
        "sid", "n", "c", "weight", "group",
        F.pmod(F.xxhash64("sid"), F.ceil(F.col("total") / BLOCK_SHINGLES)).alias("slice")),
        "join-placed")
    rank = F.struct("weight", "c")
    in_lists = rows.select("gram", "sid").join(
        placed.select("sid", "n", "group", "slice", rank.alias("rank")), "sid")
    blocks = in_lists.groupBy("gram", "group", "slice").agg(
        F.max("rank").alias("top"), F.min("n").alias("least"), F.max("n").alias("most"))
    visits = (in_lists.select("gram", "sid", "rank", "n")
              .join(blocks, "gram")
              .where((F.col("rank") < F.col("top")) & (F.col("n") * PART <= F.col("most") * WHOLE)
                     & (F.col("least") * PART <= F.col("n") * WHOLE))
              .select("sid", "n", "group", "slice").distinct())
    visits = written(visits, "join-visits")
    parts = visits.groupBy("group", "slice").agg(F.ceil(
        F.sum(F.col("n").cast("bigint")) / BLOCK_SHINGLES).alias("parts"))
    held = (placed.join(parts, ["group", "slice"])
            .select("sid", "c", "group", "slice", F.lit(0).alias("visits"),
                    F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")))
    come = (visits.join(parts, ["group", "slice"]).join(placed.select("sid", "c"), "sid")
            .select("sid", "c", "group", "slice", F.lit(1).alias("visits"),
                    F.pmod(F.xxhash64("sid", F.lit(1)), F.col("parts")).alias("part")))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        sides = [[(c, np.frombuffer(x, np.uint64)) for c, x in
                  g.loc[g["visits"] == v, ["c", "grams"]].itertuples(index=False)]
                 for v in (0, 1)]
        found = list(_scanned(*sides)) if all(sides) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return (held.unionByName(come).join(sets.select("sid", "grams"), "sid")
            .groupBy("group", "slice", "part").applyInPandas(run, "a long, b long"))


# --- the join ---------------------------------------------------------------------------------

def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"))
    found = written(repeated_in(counted_chunks(docs, shuffle_partitions(spark))), "join-counts")
    rows = written(judged(found), "join-documents")
    # a class of equal sets is named by its smallest id; classes whose id names another
    # one already, or that have none, get a negative name
    classes = rows.where("n > 0").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_hash")).alias("row"),
        F.first("n").alias("n"), F.max("open").alias("open")).select("key", "n", "open", "row.*")
    owners = (classes.where("NOT bare").groupBy("doc_id").agg(F.min("key").alias("key"))
              .withColumn("sid", F.col("doc_id")).select("key", "sid"))
    classes = written(classes.join(owners, "key", "left").select(
        "key", "n", "open", "text_hash", F.col("doc_id").alias("rep"),
        F.coalesce("sid", -F.shiftrightunsigned(F.xxhash64("key"), 2) - 2).alias("sid")),
        "join-classes")
    sets = written(contents(docs, classes.where("open"), frequent(found)), "join-sets")
    named = jaccard_components(sets, same_document(rows, classes))
    # a component answers to its smallest real id, if it has one
    real = (classes.join(named, "sid", "left")
            .select("key", "rep", F.coalesce("component", "sid").alias("root")))
    names = real.groupBy("root").agg(F.min("rep").alias("component_id"))
    whole = real.join(names, "root").select("key", "component_id")
    return (rows.join(whole, "key", "left")
            .select("doc_id", F.col("n").cast("bigint").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def same_document(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of classes that rows with the same id belong to."""
    many = (rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most"))
    of = (rows.select("doc_id", "key").join(many.select("doc_id"), "doc_id").distinct()
          .join(classes.select("key", "sid"), "key"))
    least = of.groupBy("doc_id").agg(F.min("sid").alias("b"))
    return of.join(least, "doc_id").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct()


def jaccard_components(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(sid, component) of the sets that any of all linked pairs of ``sets`` (sid, n,
    grams: distinct shingles in one order that all sets follow) or the given links join."""
    sizes = {r.n: r.sets for r in sets.where(F.col("n") <= MOST_SMALL).groupBy("n")
             .agg(F.count(F.lit(1)).alias("sets")).collect()}
    lists = inverted_lists(sets)
    shape = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("l")).agg(
        (F.sum(F.col("l") * F.col("l")) / F.sum("l")).alias("mean")).first()
    small = boundary(sizes, shape["mean"] or 0.0)
    links = links.unionByName(written(subset_links(sets.where(F.col("n") <= small)), "join-links"))
    # small sets that no large one can link with are done
    lists = lists.where(F.col("n") >= smallest_partner(small + 1))
    links = links.unionByName(written(linked(voted_pairs(lists), sets), "join-links"))
    known = components(links)
    joined = components(written(settled_links(lists, sets, known), "join-links")).select(
        F.col("id").alias("component"), F.col("component").alias("joined"))
    first = (known.select(F.col("id").alias("sid"), "component")
             .unionByName(known.select(F.col("component").alias("sid"), "component").distinct())
             .distinct())
    last = first.join(joined, "component", "left").select(
        "sid", F.coalesce("joined", "component").alias("component"))
    # components of one set that only a settled link joins
    alone = joined.join(first.select(F.col("sid").alias("component")), "component", "left_anti")
    return last.unionByName(alone.select(F.col("component").alias("sid"),
                                         F.col("joined").alias("component")))


def op12_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set and the smallest doc_id it is connected to."""
    return jaccard_classes(exact_columns(read_table(spark, sf_dir, "documents"), "doc_id", "text"))
