"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TS = "timestamp"


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal (the fixture timestamps are NTZ; no zone shift)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(str(value)))


def minus(as_of, days: int = 0, hours: int = 0) -> Column:
    """``as_of - INTERVAL``, folded to a constant by Catalyst."""
    return ts_literal(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))


def in_lookback(as_of, days: int = 0, hours: int = 0, ts: str = TS) -> Column:
    """Half-open window ``[as_of - n, as_of)`` on the event time (decision D1)."""
    return (F.col(ts) >= minus(as_of, days, hours)) & (F.col(ts) < ts_literal(as_of))


def ratio(num, den) -> Column:
    """Double ratio; NULL instead of an ANSI error when the divisor is 0 (D6)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den) -> Column:
    """``num * 100.0 / den`` in double, NULL on a zero divisor."""
    return F.try_divide(_c(num).cast("double") * 100.0, _c(den).cast("double"))


def count_if(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``."""
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def first_match(rules: Sequence[tuple[Column, object]], default) -> Column:
    """Searched CASE: the first rule whose condition holds wins."""
    expr = None
    for cond, value in rules:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def clip(c, lo: float, hi: float) -> Column:
    """pandas ``clip``: NULL/NaN stay NULL (Spark orders NaN above all numbers)."""
    c = _c(c)
    return F.when(c.isNull() | F.isnan(c), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(c.cast("double"), F.lit(float(lo))), F.lit(float(hi))))


def cut_right_closed(c, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, bins, labels)``: intervals (b0,b1], (b1,b2], ...; outside -> NULL.

    Not ``Bucketizer``: that one is left-closed.
    """
    c = _c(c)
    expr = None
    for lo, hi, label in zip(bins[:-1], bins[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
