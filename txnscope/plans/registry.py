"""Query registry: name -> Spark builder and (when SQL can express it) DuckDB SQL.

Fixtures (see FIXTURES.md): ``events`` (30 days, as_of 2024-01-31) and
``lineitem`` (1995-2001, as_of 1998-12-20). Each query is registered on the
fixture whose data reaches its labels: the link report on events, the monthly
reports (market position, churn, segments) on lineitem.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources import adapters
from ..sources.tables import table_path

FIXTURE_AS_OF = {"events": adapters.EVENTS_AS_OF, "lineitem": adapters.LINEITEM_AS_OF}
FIXTURE_SQL = {"events": adapters.EVENTS_TRANSACTIONS_SQL,
               "lineitem": adapters.LINEITEM_TRANSACTIONS_SQL}


SOURCE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


# (application id, data folder, version, fixture) -> path of a materialised table
_WAREHOUSE: dict = {}


def table_version(spark: SparkSession, sf_dir: str) -> tuple:
    """Bytes, number of files and time of each source table, asked of the file system
    that Spark reads it from: artefacts built from other files are not used again."""
    conf, paths = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    out = []
    for t in SOURCE_TABLES:
        path = paths.Path(table_path(sf_dir, t))
        fs = path.getFileSystem(conf)
        summary = fs.getContentSummary(path)
        out += [summary.getLength(), summary.getFileCount(),
                fs.getFileStatus(path).getModificationTime()]
    return tuple(out)


def artefact_key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, *table_version(spark, sf_dir))


def use_warehouse(spark: SparkSession, sf_dir: str, fixtures=("events", "lineitem")) -> dict:
    """Build each fixture's transaction table once (star join -> partitioned
    parquet in the shared folder); later loads read it with partition pruning.
    Returns the build seconds per fixture."""
    import time

    from ..sources import warehouse
    took = {}
    for fx in fixtures:
        t0 = time.perf_counter()
        t = load_transactions(spark, sf_dir, fx)
        _WAREHOUSE[(*artefact_key(spark, sf_dir), fx)] = warehouse.materialize(
            t, f"transactions_{fx}")
        took[fx] = time.perf_counter() - t0
    return took


def load_transactions(spark: SparkSession, sf_dir: str, fixture: str,
                      lookback_days: int | None = None, bounded: bool = False) -> DataFrame:
    """The canonical transaction table of a fixture.

    ``bounded`` reports only read rows before the fixture's ``as_of`` and,
    with ``lookback_days``, after ``as_of - lookback``; those bounds prune
    months of the materialised table when one was built, or the raw ship date
    of lineitem otherwise (the exact time filter stays in the report).
    Unbounded loads (whole-table operators) read every row.
    """
    as_of = FIXTURE_AS_OF[fixture] if bounded else None
    since = (as_of - _dt.timedelta(days=lookback_days)) if (bounded and lookback_days) else None
    built = _WAREHOUSE.get((*artefact_key(spark, sf_dir), fixture)) if _WAREHOUSE else None
    if built:
        from ..sources import warehouse
        return warehouse.read_window(spark, built, since, as_of)
    if fixture == "events":
        return adapters.events_transactions(spark, sf_dir)
    return adapters.lineitem_transactions(spark, sf_dir, since=since, until=as_of)


def sql_literal(ts: _dt.datetime) -> str:
    return f"TIMESTAMP '{ts:%Y-%m-%d %H:%M:%S}'"


def with_transactions(fixture: str, body: str) -> str:
    """Prefix ``body`` (a SELECT, or CTE definitions followed by a SELECT) with
    the fixture's transaction CTE and substitute the report time."""
    body = body.strip().replace("{as_of}", sql_literal(FIXTURE_AS_OF[fixture]))
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return "WITH " + FIXTURE_SQL[fixture].strip() + sep + body


def txn_query(name: str, fixture: str, fn, sql: str | None, lookback_days: int | None = None,
              **kwargs) -> Registered:
    """Register ``fn(t, as_of, **kwargs)`` on a fixture's transaction table."""
    as_of = FIXTURE_AS_OF[fixture]

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = load_transactions(spark, sf_dir, fixture, lookback_days, bounded=True)
        return fn(t, as_of, **kwargs)
    return Registered(name, build, with_transactions(fixture, sql) if sql else None)


def frame_query(name: str, fixture: str, fn, sql: str | None, **kwargs) -> Registered:
    """Register ``fn(t, **kwargs)`` (operators without a report time)."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = load_transactions(spark, sf_dir, fixture)
        return fn(t, **kwargs)
    return Registered(name, build, with_transactions(fixture, sql) if sql else None)


def all_queries() -> list[Registered]:
    from . import catalog
    return catalog.build_catalog()
