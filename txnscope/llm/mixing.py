"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words. A document's expected number of copies is
target / source size; its integral part is taken for sure and the fraction is rounded
by the pivotal method: two open documents meet, words move from one to the other (at
random which way, so that expectations hold) until one of them is integral, and the
other meets the next. Every meeting keeps the source's number of words, so the mix
misses a target by less than one document.

Rounding runs in buckets of a source (a bucket holds about ``BUCKET_ROWS`` rows
whatever the source's share of the table); each bucket leaves at most one open
document, and a tree over the buckets combines these residuals until one per source is
left, which is rounded alone. All draws are hashes of the rows, so reruns agree.

Defined cases: a null text has size 0; documents of size 0 cost nothing and are
rounded alone; null sources form a source of their own (last); repeated rows are
rounded as rows of their own; a source without words has target 0; an empty table
gives an empty mix. Working columns start with ``_mix_`` and cannot clash with others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .common import WORD_PATTERN, read_table, written

CYCLE = (1, 2, 3)
MOST_COPIES = 3.0
BUCKET_ROWS = 4096
FAN_IN = 512
#: Sources up to this many go to all tasks; beyond, the source table is joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, cycle=CYCLE, most=MOST_COPIES) -> DataFrame:
    """(_mix_source, rows, source_size, target) from (_mix_source, _mix_size) rows.

    Sources weigh ``cycle`` in code-point order, null last, and share all words; a
    target stops at ``most`` times the source's size and the excess is shared again by
    weight. Each round is one aggregate over the source table; it ends when no target
    is above its limit."""
    per = (sizes.groupBy("_mix_source").agg(F.count("*").alias("rows"),
                                            F.sum("_mix_size").alias("source_size")))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = global_row_number(written(per, "mix-sources"),
                               [F.asc_nulls_last("_mix_source")], "rank")
    s = written(ranked.withColumn("weight", F.element_at(
        weights, F.pmod(F.col("rank") - 1, F.lit(len(cycle))) + 1)), "mix-ranked")
    total = s.agg(F.sum("source_size")).collect()[0][0] or 0
    limit = F.col("source_size") * F.lit(float(most))
    # water filling: a source is full when its limit does not exceed its share; the
    # share of one unit of weight only rises, so full sources stay full
    unit = None
    while True:
        full = F.lit(False) if unit is None else limit <= F.col("weight") * F.lit(unit)
        r = s.agg(F.sum(F.when(full, limit)).alias("used"),
                  F.sum(F.when(~full, F.col("weight"))).alias("open")).collect()[0]
        if not r.open:
            break
        now = (total - (r.used or 0.0)) / r.open
        if unit is not None and now <= unit:
            break
        unit = now
    share = F.least(limit, F.col("weight") * F.lit(unit)) if unit is not None else limit
    return s.select("_mix_source", "rows", "source_size", share.cast("double").alias("target"))


def _unit(seed: int, *columns) -> F.Column:
    """A uniform number in [0, 1) from the columns' hash."""
    h = F.xxhash64(*columns, F.lit(seed))
    return F.pmod(h, F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def pivot(weight: np.ndarray, p: np.ndarray, draw: np.ndarray) -> int:
    """Round fractions ``p`` (in place) by pairs; returns the place of the residual
    that stays open, or -1. ``weight`` > 0; ``draw[i]`` decides the meeting that row i
    joins."""
    a = -1
    for b in range(len(p)):
        if not 0.0 < p[b] < 1.0:
            continue
        if a < 0:
            a = b
            continue
        u, v, x, y = weight[a], weight[b], p[a], p[b]
        up_x, down_y = u * (1.0 - x), v * y          # words a can take, b can give
        down_x, up_y = u * x, v * (1.0 - y)          # words a can give, b can take
        up, down = min(up_x, down_y), min(down_x, up_y)
        if draw[b] * (up + down) < down:
            p[a], p[b] = ((1.0, y - up / v) if up_x <= down_y else (x + up / u, 0.0))
        else:
            p[a], p[b] = ((0.0, y + down / v) if down_x <= up_y else (x - down / u, 1.0))
        open_a, open_b = 0.0 < p[a] < 1.0, 0.0 < p[b] < 1.0
        a = a if open_a else b if open_b else -1
    return a


def _round_group(group: pa.Table) -> pa.Table:
    column = lambda name: group.column(name).to_numpy()
    # large documents first: what stays open in the end is then a small one
    order = np.lexsort((column("_mix_key"), column("_mix_order"), -column("_mix_size")))
    p = column("_mix_p")[order].astype(float)
    left = pivot(column("_mix_size")[order].astype(float), p, column("_mix_draw")[order])
    rounded, still = np.empty(len(p)), np.zeros(len(p), bool)
    rounded[order] = p
    if left >= 0:
        still[order[left]] = True
    for name, values in (("_mix_p", rounded), ("_mix_open", still)):
        group = group.set_column(group.schema.get_field_index(name), name, pa.array(values))
    return group


def mix(df: DataFrame, text: str = "text", source: str = "source", size: str | None = None,
        seed: int = 0) -> DataFrame:
    """``df`` plus _mix_size, _mix_total (its source's size), _mix_target and
    _mix_copies (whole number of times the row is taken). ``size`` names a column of word counts; else ``text`` is counted."""
    if not df.columns:
        raise ValueError("mix needs columns")
    original = df.columns
    rows = df.select(
        *[F.col(f"`{c}`") for c in original],
        F.col(f"`{source}`").cast("string").alias("_mix_source"),
        (F.col(f"`{size}`").cast("bigint") if size else word_count(F.col(f"`{text}`")))
        .alias("_mix_size"),
        F.xxhash64(*[F.col(f"`{c}`") for c in original]).alias("_mix_key"))
    targets = written(source_targets(rows.select("_mix_source", "_mix_size")), "mix-targets")
    stats = targets.agg(F.count("*").alias("n"), F.max("rows").alias("rows")).collect()[0]
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS))
    side = targets.select(F.col("_mix_source").alias("_mix_s"),
                          F.col("source_size").alias("_mix_total"),
                          F.col("target").alias("_mix_target"), buckets.alias("_mix_buckets"))
    side = F.broadcast(side) if stats.n <= BROADCAST_SOURCES else side
    names = [f"_mix_c{i}" for i in range(len(original))]   # apart even where names clash
    ready = (rows.join(side, F.col("_mix_source").eqNullSafe(F.col("_mix_s")))
             .select(*[F.col(f"`{c}`").alias(n) for c, n in zip(original, names)],
                     "_mix_source", "_mix_size", "_mix_key", "_mix_total", "_mix_target",
                     F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total"))
                     .otherwise(0.0).alias("_mix_expected"),
                     F.pmod(F.xxhash64("_mix_key", F.lit(seed)), F.col("_mix_buckets"))
                     .alias("_mix_bucket"))
             .withColumn("_mix_whole", F.floor("_mix_expected"))
             .withColumn("_mix_p", F.col("_mix_expected") - F.col("_mix_whole"))
             .withColumn("_mix_order", F.xxhash64("_mix_key", F.lit(seed + 1)))
             .withColumn("_mix_draw", _unit(seed + 2, "_mix_key"))
             .withColumn("_mix_open", F.lit(False)))
    weightless = ready.where("_mix_size <= 0").withColumn(
        "_mix_p", (F.col("_mix_draw") < F.col("_mix_p")).cast("double"))
    schema = ready.schema
    now = (ready.where("_mix_size > 0").groupBy("_mix_source", "_mix_bucket")
           .applyInArrow(_round_group, schema))
    level = written(now, "mix-level")
    done = level.where("NOT _mix_open")
    open_rows, most = level.where("_mix_open"), -(-(stats.rows or 0) // BUCKET_ROWS)
    while most > 1:                                  # one level of the tree of residuals
        parents = (open_rows.withColumn("_mix_bucket", F.floor(F.col("_mix_bucket") / FAN_IN))
                   .withColumn("_mix_draw", _unit(seed + 3, "_mix_key", "_mix_bucket")))
        level = written(parents.groupBy("_mix_source", "_mix_bucket")
                        .applyInArrow(_round_group, schema), "mix-level")
        done = done.unionByName(level.where("NOT _mix_open"))
        open_rows, most = level.where("_mix_open"), -(-most // FAN_IN)
    last = open_rows.withColumn(
        "_mix_p", (_unit(seed + 4, "_mix_key") < F.col("_mix_p")).cast("double"))
    final = done.unionByName(last).unionByName(weightless)
    return final.select(
        *[F.col(n).alias(c) for c, n in zip(original, names)],
        "_mix_size", "_mix_total", "_mix_target",
        (F.col("_mix_whole") + F.col("_mix_p").cast("bigint")).alias("_mix_copies"))


def mixed_rows(df: DataFrame, **kwargs) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken."""
    taken = mix(df, **kwargs).where("_mix_copies > 0")
    return (taken.withColumn("_mix_i", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                            F.col("_mix_copies"))))
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def op4_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("words"))
    return mix(docs, size="words").select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"))
