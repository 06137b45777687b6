"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its words' occurrence-labelled k-mers (k = 5 words). Each of
``SKETCHES`` sketches takes the ``PICKED`` k-mers with the smallest hash and keeps them
in text order, so two texts collide with a probability that grows with their edit
similarity, not only with their shared content. Texts that collide are candidates; a
candidate pair is a link when the word edit distance, computed in a band that the bound
allows, is at most (1 - 0.8) of the longer text. Classes are connected components.

Exact copies are one text throughout, so a group of copies costs one text. A bucket of
colliding texts never emits all its pairs:

1. every text meets the smallest text of each of its buckets (and, if asked for, in a
   few turns a drawn text of the buckets that are not one component yet); links join
   components;
2. the pairs of a bucket that are still in different components all meet, in blocks,
   under two lossless conditions: lengths, and a histogram of word hashes whose distance
   is at most the edit distance.

So no link between different classes is lost that the sketches propose, whatever the
size of a bucket; pairs within a component need no test.

Defined cases: null texts are empty; equal texts (empty ones too) form one class; texts
without words other than equal ones stand alone; texts under k words are one k-mer;
rows that share an id are one document; a null id gets the class of its text, named by
a negative number where no id does; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, release_task_state, written

K = 5
SKETCHES = 16
PICKED = 3
SIMILARITY = 0.8
BINS = 256
#: Edits up to which the diagonals are followed one by one.
NARROW = 16
#: Texts of a contested bucket that one task compares with as many others.
BLOCK_ROWS = 256
#: Turns in which contested buckets meet a drawn text before all open pairs are tested.
#: They change the work, not the classes: a turn costs a round of components, and pays
#: only where buckets hold many components that one text joins.
CENTER_TURNS = 0
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.random.default_rng(10).integers(1, 1 << 62, SKETCHES, np.uint64)
                * np.uint64(2) + np.uint64(1))


# --- sketches -----------------------------------------------------------------------------

class _WordHashes(dict):
    """word -> 64-bit hash, forgotten when it grows large."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str | None, known: dict) -> np.ndarray:
    words = (text or "").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def kmers(h: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers, in text order."""
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        out = _scramble(out + h[i:i + n] + np.uint64(i))
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    repeat = ranked[1:] == ranked[:-1]
    if repeat.any():                              # label the 2nd, 3rd, ... occurrence
        first = np.flatnonzero(np.concatenate([[True], ~repeat]))
        label = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        label_of = np.empty(n, np.uint64)
        label_of[order] = label
        out = np.where(label_of > 0, _scramble(out + label_of), out)
    return out


def order_sketches(grams: np.ndarray) -> np.ndarray:
    """One 64-bit value per sketch: its smallest k-mers, in text order."""
    if not len(grams):
        return np.zeros(0, np.int64)
    take = min(PICKED, len(grams))
    value = np.zeros(SKETCHES, np.uint64)
    places = np.empty((SKETCHES, take), np.int64)
    for j, m in enumerate(_MULTIPLIERS):
        ranks = grams * m
        places[j] = (np.argpartition(ranks, take - 1)[:take] if take < len(grams)
                     else np.arange(take))
    places.sort(axis=1)
    for i in range(take):
        value = _scramble(value * _MIX + grams[places[:, i]])
    return (value ^ np.arange(SKETCHES, dtype=np.uint64) * _MIX).view(np.int64)


def histogram(h: np.ndarray, bins: int = BINS) -> np.ndarray:
    return np.bincount((h >> np.uint64(40)).astype(np.int64) % bins,
                       minlength=bins).astype(np.int32)


def text_key(text) -> F.Column:
    return F.sha1(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, sketches) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_task_state()
        known = _WordHashes()
        for b in batches:
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"), "text_key": b["text_key"],
                "sketches": [order_sketches(kmers(word_hashes(t, known))) for t in b["text"]]})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       text_key(F.col("text")).alias("text_key")).mapInPandas(
        run, "doc_id long, text_key string, sketches array<long>")


# --- alignment ----------------------------------------------------------------------------

def edit_limit(n: int, m: int, similarity: float = SIMILARITY) -> int:
    return int((1.0 - similarity) * max(n, m) + 1e-9)


def within_distance(a: list[int], b: list[int], limit: int) -> bool:
    """Whether the edit distance of two sequences is at most ``limit``, by banded
    alignment. The first edits follow the furthest reaching points of the diagonals of a
    band that widens by one per edit; texts that need more go on in columns."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    ca, cb = Counter(a), Counter(b)
    if max(sum((ca - cb).values()), sum((cb - ca).values())) > limit:   # a lower bound
        return False
    goal, reach = m - n, {}
    for e in range(min(limit, NARROW) + 1):
        new = {}
        # diagonals from which the goal can still be reached with the edits left
        lo, hi = max(-e, goal - (limit - e)), min(e, goal + (limit - e))
        for d in range(lo, hi + 1):
            if e == 0:
                i = 0
            else:
                i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))
            i = min(i, n, m - d)
            if i < 0 or i + d < 0:
                continue
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            if d == goal and i >= n:
                return True
            new[d] = i
        reach = new
    return limit > NARROW and _within_columns(a, b, limit)


def _within_columns(a: list[int], b: list[int], limit: int) -> bool:
    """The same test column by column, the rises and falls of a column held as the bits
    of two integers; it ends where the band's edge can no longer be met."""
    n, m = len(a), len(b)
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | (1 << i)
    whole, last = (1 << n) - 1, 1 << (n - 1) if n else 0
    rise, fall, score = whole, 0, n
    for j, w in enumerate(b, 1):
        same = places.get(w, 0)
        diagonal = (((same & rise) + rise) ^ rise) | same | fall
        up, down = fall | (whole & ~(diagonal | rise)), diagonal & rise
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1 | 1) & whole
        rise = (down << 1 & whole) | (whole & ~(diagonal | up))
        fall = up & diagonal
        if score - (m - j) > limit:
            return False
    return score <= limit


def linked(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) of text ids whose texts align within the bound."""
    left = words.select(F.col("id").alias("a"), F.col("words").alias("words_a"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("words_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for x, y in zip(p["words_a"], p["words_b"]):
                x, y = np.frombuffer(x, "<u4").tolist(), np.frombuffer(y, "<u4").tolist()
                keep.append(within_distance(x, y, edit_limit(len(x), len(y))))
            yield p.loc[np.array(keep, bool), ["a", "b"]]
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
            .mapInPandas(run, "a long, b long"))


# --- components ---------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id each linked id is connected to, by alternating
    large and small stars. Each round rewrites the links (a pre-aggregated minimum and
    a join per id); it ends when a round changes nothing."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), "near-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour to the smallest id of the neighbourhood
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u <> v").distinct())
        edges = written(small, "near-edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).collect()[0]
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = now


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text_id, class_id) of every row of ``docs``: text_id names
    equal texts, class_id near-duplicates, both by the smallest document id."""
    rows_of_texts = written(sketched(docs), "near-sketches")
    bare = -F.shiftrightunsigned(F.xxhash64("text_key"), 2) - 2
    texts = written(rows_of_texts.groupBy("text_key").agg(
        F.min("doc_id").alias("rep"), F.first("sketches").alias("sketches"))
        .withColumn("id", F.coalesce("rep", bare)), "near-texts")
    buckets = texts.select("id", F.explode(F.array_distinct("sketches")).alias("sketch"))
    centers = (buckets.groupBy("sketch").agg(F.min("id").alias("center"), F.count("*").alias("size"))
               .where("size > 1").drop("size"))
    stars = written(buckets.join(centers, "sketch"), "near-stars")
    words = written(candidate_words(docs, texts.join(stars.select("id").distinct(), "id")),
                    "near-words")
    met = stars.where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b"))
    links = written(linked(met.distinct(), words), "near-links")
    known = components(links)
    for turn in range(CENTER_TURNS):      # other centres join most of what is left
        rows = contested(stars, words, known)
        found = written(linked(center_pairs(rows, turn), words), "near-links")
        if not found.limit(1).count():
            break
        links = links.unionByName(found)
        known = components(links)
    links = links.unionByName(written(open_links(contested(stars, words, known), words),
                                      "near-links"))
    named = texts.select("text_key", "id").join(components(links), "id", "left").select(
        "text_key", F.col("id").alias("text_id"), F.coalesce("component", "id").alias("class_id"))
    return rows_of_texts.select("doc_id", "text_key").join(named, "text_key")


def candidate_words(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, n, bins, words, sketches): length, histogram, word hashes and sketches of the
    given texts, each read from the row that names it, so copies of one text do not
    meet."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for b in batches:
            hashes = [word_hashes(t, known) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "n": [len(h) for h in hashes],
                                "bins": [histogram(h) for h in hashes],
                                "words": [h.astype("<u4").tobytes() for h in hashes],
                                "sketches": b["sketches"]})
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        text_key(F.col("text")).alias("key"))
    return (keyed.join(texts.select("id", "rep", "text_key", "sketches"),
                       (F.col("key") == F.col("text_key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
            .select("id", "text", "sketches").mapInPandas(
                run, "id long, n int, bins array<int>, words binary, sketches array<long>"))


def contested(stars: DataFrame, words: DataFrame, known: DataFrame) -> DataFrame:
    """(sketch, id, c, size, n, bins): the texts of buckets that hold more than one
    component. c is the text's component, size the bucket's number of texts."""
    rows = (stars.select("sketch", "id").join(known, "id", "left")
            .select("sketch", "id", F.coalesce("component", "id").alias("c")))
    mixed = (rows.groupBy("sketch").agg(F.min("c").alias("least"), F.max("c").alias("most"),
                                        F.count("*").alias("size"))
             .where("least < most").select("sketch", "size"))
    return written(rows.join(mixed, "sketch").join(words.select("id", "n", "bins"), "id"),
                   "near-contested")


def _side(rows: DataFrame, s: str) -> DataFrame:
    return rows.select("sketch", *[F.col(x).alias(f"{x}_{s}") for x in ("id", "c", "n", "bins")])


def _possible() -> F.Column:
    """Lossless: the lengths, and the larger surplus of either word histogram, which is
    at most the edit distance, stay within the bound."""
    limit = F.floor(F.greatest("n_a", "n_b") * F.lit(1.0 - SIMILARITY) + F.lit(1e-9))
    surplus = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.greatest(x - y, F.lit(0))),
                          F.lit(0), lambda acc, x: acc + x)
    return ((F.col("c_a") != F.col("c_b")) & (F.abs(F.col("n_a") - F.col("n_b")) <= limit)
            & (surplus <= limit) & (surplus - F.col("n_a") + F.col("n_b") <= limit))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.greatest("id_a", "id_b").alias("a"),
                         F.least("id_a", "id_b").alias("b")).distinct()


def center_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """The texts of each contested bucket against one text, drawn anew each turn."""
    centers = rows.groupBy("sketch").agg(
        F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("id"))
    centers = rows.join(centers, ["sketch", "id"], "left_semi")
    return _pairs(_side(rows, "a").join(_side(centers, "b"), "sketch").where(_possible()))


def open_links(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Links among the pairs of contested buckets that are in different components.

    Buckets are cut into blocks of ``BLOCK_ROWS`` texts, and a task holds two blocks. It
    tests each pair of the two that may be within the bound, once: in the first bucket
    the texts share, and only while no link it found has joined their components. Only
    links leave the task, so what a bucket emits does not grow with its square."""
    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        left, right = g[g["block"] == key[1]], g[g["block"] == key[2]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        ids, c, n = (right[x].to_numpy() for x in ("id", "c", "n"))
        bins, sketches = np.stack(right["bins"].to_numpy()), np.stack(right["sketches"].to_numpy())
        texts = [np.frombuffer(w, "<u4").tolist() for w in right["words"]]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                x = up
            return x
        found = []
        for a, ca, na, ba, sa, wa in zip(left["id"], left["c"], left["n"], left["bins"],
                                         left["sketches"], left["words"]):
            limit = np.floor((1.0 - SIMILARITY) * np.maximum(n, na) + 1e-9)
            at = np.flatnonzero((c != ca) & (np.abs(n - na) <= limit)
                                & ((ids > a) | (key[1] != key[2])))
            shared = sketches[at] == sa
            at = at[sa[shared.argmax(axis=1)] == key[0]]
            more = np.maximum(ba - bins[at], 0).sum(axis=1)
            at = at[np.maximum(more, more - na + n[at]) <= limit[at]]
            words_a = np.frombuffer(wa, "<u4").tolist() if len(at) else []
            for i in at:
                x, y = root(ca), root(c[i])
                if x != y and within_distance(words_a, texts[i], int(limit[i])):
                    parent[max(x, y)] = min(x, y)
                    found.append((a, ids[i]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (rows.join(words.select("id", "words", "sketches"), "id")
             .withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .select("sketch", "id", "c", "n", "bins", "words", "sketches", "block", other)
             .withColumn("low", F.least("block", "other"))
             .withColumn("high", F.greatest("block", "other")))
    return dealt.groupBy("sketch", "low", "high").applyInPandas(run, "a long, b long")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of each class: the one that names it, columns unchanged. Of rows that
    repeat it in id and text, one stays."""
    named = (near_classes(docs).where("text_id = class_id")
             .select("text_key", F.col("text_id").alias("_id")).distinct())
    columns = [f"c{i}" for i in range(len(docs.columns))]     # apart even where names clash
    doc_id = F.col(columns[docs.columns.index("doc_id")]).cast("bigint")
    text = F.col(columns[docs.columns.index("text")])
    rows = docs.toDF(*columns).withColumn("_key", text_key(text))
    kept = rows.join(named, (F.col("_key") == F.col("text_key"))
                     & ((doc_id == F.col("_id")) | (doc_id.isNull() & (F.col("_id") < 0))))
    return kept.dropDuplicates(["_key"]).select(*columns).toDF(*docs.columns)
