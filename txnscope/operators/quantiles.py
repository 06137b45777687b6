"""Exact quantiles with linear interpolation, by bracketed selection.

1. One aggregation gives count, extremes and, by a mergeable sketch, a bracket of values
   around each wanted rank (all columns and groups at once).
2. A counting pass finds how many values lie below each bracket, at its ends and between
   them. A rank at an end is found. A bracket that missed its rank is widened; one with
   more than ``FEW`` values between its ends is narrowed by a sketch of those, which
   divides them by about ``ACCURACY``.
3. The few values between the ends of the other brackets, with their counts, give the
   exact order statistics.

No value outside a bracket is shuffled or sorted, and the sketch only steers the work.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TARGETS = 20_000
ACCURACY = 10_000
#: Rank error allowed for, as a share of the values: three times that of the sketch.
SLACK = 3.0 / ACCURACY
#: Values of a bracket that are fetched.
FEW = 5_000


@dataclass(frozen=True)
class Distribution:
    """Count, extremes and the wanted quantiles of one column (in one group)."""
    n: int
    low: float
    high: float
    at: tuple


@dataclass
class _Target:
    """One wanted rank and the bracket of values [low, high] that should hold it."""
    group: object
    slot: tuple              # (column, probability, lower or upper rank)
    rank: int
    low: float
    high: float
    whole: tuple
    value: float | None = None
    before: int = 0          # values up to the lower end
    inside: int = 0          # values between the ends

    def counted(self, below: int, at_low: int, inside: int, at_high: int) -> None:
        self.before, self.inside = below + at_low, inside
        if below <= self.rank < self.before:
            self.value = self.low
        elif self.before + inside <= self.rank < self.before + inside + at_high:
            self.value = self.high
        elif not self.before <= self.rank < self.before + inside:
            self.low, self.high = self.whole         # the sketch erred by more than it may
            self.inside = 0

    def shares(self) -> list[float]:
        """Where, as shares of the values between the ends, the rank must lie."""
        at = (self.rank - self.before) / self.inside
        return [at - SLACK - 1 / self.inside, at + SLACK + 1 / self.inside]


def _sketch(x: Column, shares) -> Column:
    return F.percentile_approx(x, [min(1.0, max(0.0, s)) for s in shares], ACCURACY)


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probabilities,
                    by: str | None = None) -> dict[tuple, Distribution]:
    """{(group value, name): Distribution} of the non-null values; the group value is
    None without ``by``. Rows of a null group are left out, and so are columns without
    any value. Groups times columns times probabilities are bounded by ``MOST_TARGETS``.
    ``df`` is read a few times."""
    probabilities, names = list(probabilities), list(columns)
    group = F.lit(None).cast("string") if by is None else F.col(by)
    rows = (df if by is None else df.where(F.col(by).isNotNull())).select(
        group.alias("g"), *[columns[c].cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    wide = [s for p in probabilities for s in (p - SLACK, p + SLACK)]
    per_group = rows.groupBy("g").agg(*[e for i in range(len(names)) for e in (
        F.count(f"x{i}").alias(f"n{i}"), F.min(f"x{i}").alias(f"a{i}"), F.max(f"x{i}").alias(f"b{i}"),
        *([_sketch(F.col(f"x{i}"), wide).alias(f"s{i}")] if wide else []))])
    found = per_group.orderBy("g").limit(MOST_TARGETS + 1).collect()
    if len(found) * len(names) * len(probabilities) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} quantiles were asked for")
    shape, targets = {}, []
    for r in found:
        for i, c in enumerate(names):
            n, whole = r[f"n{i}"], (r[f"a{i}"], r[f"b{i}"])
            if not n:
                continue
            shape[r.g, i] = (n, *whole)
            for k, p in enumerate(probabilities):
                low, high = r[f"s{i}"][2 * k:2 * k + 2] if n > FEW else whole
                ranks = {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}
                targets += [_Target(r.g, (i, p, e), rank, low, high, whole)
                            for e, rank in enumerate(sorted(ranks))]
    _select(rows, targets, by is not None)
    at = {(t.group, t.slot): t.value for t in targets}
    out = {}
    for (g, i), (n, low, high) in shape.items():
        values = []
        for p in probabilities:
            share = p * (n - 1) - math.floor(p * (n - 1))
            x, y = at[g, (i, p, 0)], at.get((g, (i, p, 1)))
            values.append(x if y is None else x * (1.0 - share) + y * share)
        out[g, names[i]] = Distribution(n, low, high, tuple(values))
    return out


def _bracketed(rows: DataFrame, targets: list[_Target], grouped: bool) -> tuple[DataFrame, dict]:
    """``rows`` with the ends of their group's brackets as columns, and {slot: {group:
    target}}. The ends are a bounded table of numbers."""
    slots: dict = {}
    for t in targets:
        slots.setdefault(t.slot, {})[t.group] = t
    if not grouped:
        return rows.withColumns({f"{e}{s}": F.lit(float(v)) for s, of in enumerate(slots.values())
                                 for t in of.values() for e, v in (("l", t.low), ("h", t.high))}), slots
    groups = list({t.group: None for t in targets})
    fields = ", ".join(f"l{s} DOUBLE, h{s} DOUBLE" for s in range(len(slots)))
    ends = rows.sparkSession.createDataFrame(
        [(g, *[v for of in slots.values() for v in
               ((float(of[g].low), float(of[g].high)) if g in of else (None, None))])
         for g in groups], f"g {rows.schema['g'].dataType.simpleString()}, {fields}")
    return rows.join(F.broadcast(ends), "g"), slots


def _between(s: int, x: Column) -> Column:
    return (x > F.col(f"l{s}")) & (x < F.col(f"h{s}"))


def _select(rows: DataFrame, targets: list[_Target], grouped: bool) -> None:
    """Find the value of every target."""
    todo = targets
    while todo:
        framed, slots = _bracketed(rows, todo, grouped)
        numbered = [(s, F.col(f"x{slot[0]}"), of) for s, (slot, of) in enumerate(slots.items())]
        for r in framed.groupBy("g").agg(*[F.array(
                F.count_if(x < F.col(f"l{s}")), F.count_if(x == F.col(f"l{s}")),
                F.count_if(_between(s, x)), F.count_if(x == F.col(f"h{s}"))).alias(f"c{s}")
                for s, x, _ in numbered]).collect():
            for s, _, of in numbered:
                if r.g in of:
                    of[r.g].counted(*r[f"c{s}"])
        todo = [t for t in todo if t.value is None]
        large = [(s, x, {g: t for g, t in of.items() if t.value is None and t.inside > FEW})
                 for s, x, of in numbered]
        small = [(s, x, {g: t for g, t in of.items() if t.value is None and 0 < t.inside <= FEW})
                 for s, x, of in numbered]
        if any(of for _, _, of in large):
            for r in framed.groupBy("g").agg(*[_sketch(
                    F.when(_between(s, x), x), [v for t in of.values() for v in t.shares()]).alias(f"s{s}")
                    for s, x, of in large if of]).collect():
                for s, _, of in large:
                    for k, (g, t) in enumerate(of.items()):
                        if g == r.g:
                            t.low, t.high = r[f"s{s}"][2 * k:2 * k + 2]
        if any(of for _, _, of in small):
            held = F.filter(F.array(*[F.struct(F.lit(s).alias("s"), F.when(
                F.col("g").isin(list(of)) if grouped else F.lit(True), F.when(_between(s, x), x))
                .alias("x")) for s, x, of in small if of]), lambda v: v["x"].isNotNull())
            values: dict = {}
            for r in (framed.select("g", F.explode(held).alias("v")).groupBy("g", "v.s", "v.x")
                      .agg(F.count(F.lit(1)).alias("n")).collect()):
                values.setdefault((r.g, r.s), []).append((r.x, r.n))
            for s, _, of in small:
                for g, t in of.items():
                    upto = t.before
                    for x, n in sorted(values[g, s]):
                        if upto <= t.rank < upto + n:
                            t.value = x
                        upto += n
        todo = [t for t in todo if t.value is None]
