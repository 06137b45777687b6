"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A document is a weighted set: its words and how often each occurs. Sample k gives every
word three hashed numbers, r and c from a Gamma(2, 1) and b uniform; a word of weight S
takes t = floor(ln S / r + b) and the rank ln c - r (t - b + 1), and the smallest rank
wins. Two documents share a sample exactly when the same (word, t) wins in both, whose
probability is their generalised Jaccard similarity; since the rank is a function of
(word, t, k), equal smallest ranks stand for equal samples and a fingerprint keeps a
32-bit code of each.

Each document also gets its edited text (its second half replaced by the beginning of
the next document, descending doc_id) and the likeness to the edited text and to the
next document. Documents are dealt into id ranges, so that one exchange of the texts
serves the neighbours, the word counts and the samples; the first document of a range
is copied to the range before it, so no range waits for another.

Defined cases: a null text is empty; an empty text has one empty word; null ids come
last in the descending order; rows that share an id are ordered by their texts' hashes;
a lone document follows itself; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, shuffle_partitions

SAMPLES = 32
PER_ROW = 8          # samples taken in one row of the sampling pass
RANGES_PER_PARTITION = 8


def ranges(docs: DataFrame, n: int) -> tuple[Column, list, list]:
    """(range of a row, first id of each range in descending order, range before each).
    The driver sees n boundaries and n ids, however many documents there are."""
    cuts = docs.agg(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)] or [0.5], 10_000).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    # how many cuts are at most the id: first among every m-th cut, then among the next m
    m = max(1, math.isqrt(len(cuts)))
    upto = lambda a: F.size(F.filter(a, lambda x: x <= F.col("doc_id")))
    coarse = upto(F.lit(cuts[::m])) if cuts else F.lit(0)
    fine = (F.lit(0) if not cuts else
            upto(F.slice(F.lit(cuts), F.greatest(coarse - 1, F.lit(0)) * m + 1, F.lit(m))))
    of = (F.when(F.col("doc_id").isNull() | (coarse == 0), 0)
          .otherwise((coarse - 1) * m + fine))
    first = {r.range: r.first for r in docs.groupBy(of.alias("range"))
             .agg(F.max("doc_id").alias("first")).collect()}
    heads = [first.get(i) for i in range(len(cuts) + 1)]
    there = sorted(first, reverse=True)
    before = {r: there[i - 1] for i, r in enumerate(there)}      # of the highest: the lowest
    return of, heads, [before.get(i, 0) for i in range(len(cuts) + 1)]


def with_edits(docs: DataFrame) -> DataFrame:
    """(range, row, guest, doc_id, n_chars, text, edited): rows numbered by descending
    id within their range. Guests are copies of the next range's first document."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    of, heads, before = ranges(base.select("doc_id"), RANGES_PER_PARTITION * partitions)
    ranged = base.withColumn("range", of)
    is_head = F.col("doc_id").eqNullSafe(F.element_at(F.lit(heads).cast("array<bigint>"),
                                                      F.col("range") + 1))
    own = F.struct(F.col("range"), F.lit(0).alias("guest"))
    guest = F.struct(F.element_at(F.lit(before).cast("array<int>"), F.col("range") + 1)
                     .alias("range"), F.lit(1).alias("guest"))
    dealt = (ranged.withColumn("at", F.explode(F.when(is_head, F.array(own, guest))
                                               .otherwise(F.array(own))))
             .select("at.range", "at.guest", "doc_id", "text", F.xxhash64("text").alias("tie"))
             .repartition(partitions, "range"))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), "tie")
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    return (dealt.withColumn("row", F.row_number().over(order))
            .withColumn("next", F.coalesce(F.lead("text").over(order), F.lit("")))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half),
                                           F.substring("next", F.lit(1), half)))
            .withColumn("n_chars", n.cast("bigint")).drop("next", "tie"))


def weights(rows: DataFrame, first: str, second: str) -> DataFrame:
    """(range, row, word, w0, w1): word hashes and their counts in two texts."""
    both = F.array(F.struct(F.lit(0).alias("which"), F.col(first).alias("t")),
                   F.struct(F.lit(1).alias("which"), F.col(second).alias("t")))
    texts = rows.select("range", "row", F.explode(both).alias("x")).select("range", "row", "x.*")
    words = texts.where("t IS NOT NULL").select(
        "range", "row", "which",
        F.explode_outer(F.split(F.btrim(F.lower("t"), F.lit(" \t\n\x0b\f\r")), r"\s+")).alias("w"))
    return (words.select("range", "row", F.xxhash64("w").alias("word"),
                         (F.lit(1) - F.col("which")).alias("c0"), F.col("which").alias("c1"))
            .groupBy("range", "row", "word")
            .agg(F.sum("c0").alias("w0"), F.sum("c1").alias("w1")))


def _uniform(h: Column, high: bool) -> Column:
    bits = F.shiftrightunsigned(h, 33) if high else h.bitwiseAND(F.lit((1 << 31) - 1))
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -31)


def sampled(counted: DataFrame) -> DataFrame:
    """(range, row, s0, s1): the smallest ranks of all samples, for either weight."""
    per = range(PER_ROW)
    parts = counted.select("range", "row", "word", F.log("w0").alias("l0"),
                           F.log("w1").alias("l1"),
                           F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // PER_ROW - 1)))
                           .alias("part"))
    hashed = parts.select("range", "row", "part", "l0", "l1", *[
        F.xxhash64("word", F.col("part") * PER_ROW + j).alias(f"h{j}") for j in per])
    drawn = hashed
    for j in per:
        second = F.xxhash64(F.col(f"h{j}"))
        drawn = drawn.withColumn(f"g{j}", second)
    drawn = drawn.select(
        "range", "row", "part", "l0", "l1",
        *[(-F.log(_uniform(F.col(f"h{j}"), True) * _uniform(F.col(f"h{j}"), False)))
          .alias(f"r{j}") for j in per],
        *[F.log(-F.log(_uniform(F.col(f"g{j}"), True) * _uniform(F.col(f"g{j}"), False)))
          .alias(f"c{j}") for j in per],
        *[_uniform(F.xxhash64(F.col(f"g{j}")), True).alias(f"b{j}") for j in per])

    def rank(l: str, j: int) -> Column:
        r, b = F.col(f"r{j}"), F.col(f"b{j}")
        return F.col(f"c{j}") - r * (F.floor(F.col(l) / r + b).cast("double") - b + F.lit(1.0))
    least = drawn.groupBy("range", "row", "part").agg(
        *[F.min(rank("l0", j)).alias(f"x{j}") for j in per],
        *[F.min(rank("l1", j)).alias(f"y{j}") for j in per])
    lists = least.groupBy("range", "row").agg(F.sort_array(F.collect_list(F.struct(
        "part", F.array(*[f"x{j}" for j in per]).alias("x"),
        F.array(*[f"y{j}" for j in per]).alias("y")))).alias("p"))
    return lists.select("range", "row", F.flatten("p.x").alias("s0"), F.flatten("p.y").alias("s1"))


def codes(ranks: str) -> Column:
    """32-bit codes of the winning samples."""
    return F.transform(ranks, lambda v: F.xxhash64(v).bitwiseAND(F.lit((1 << 32) - 1)))


def as_text(code: str) -> Column:
    return F.array_join(F.transform(code, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Share of equal samples: estimates the generalised Jaccard similarity."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0),
                       lambda n, x: n + x)
    return same.cast("double") / F.lit(float(SAMPLES))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    rows = with_edits(docs)
    # guests only lend their own fingerprint
    texts = rows.withColumn("edited", F.when(F.col("guest") == 0, F.col("edited")))
    signs = sampled(weights(texts, "text", "edited")).select(
        "range", "row", codes("s0").alias("a"), codes("s1").alias("b"))
    after = Window.partitionBy("range").orderBy("row")
    signs = signs.withColumn("next", F.lead("a").over(after))
    about = rows.select("range", "row", "guest", "doc_id", "n_chars",
                        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    return (about.where("guest = 0").join(signs, ["range", "row"]).select(
        "doc_id", "n_chars", "edited_sha256", as_text("a").alias("fingerprint"),
        as_text("b").alias("edited_fingerprint"), likeness("a", "b").alias("near_edited"),
        likeness("a", "next").alias("near_next")))


def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
