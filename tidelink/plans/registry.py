"""Registry of named queries (Spark callables) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelink.session import ensure_conf
from tidelink.sources.tables import as_naive

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}
# Stages materialised while building the current query (cleared per query,
# so timings are never helped by an earlier query's work).
_STAGES: dict[tuple, DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Materialise a shared intermediate once per query build."""
    from tidelink.session import materialize
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGES:
        _STAGES[key] = materialize(build())
    return _STAGES[key]


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB oracle over the same parquet tables (views named
    like the tables); omit it for operators SQL cannot express.
    Output timestamps are returned naive (UTC wall clock) to compare with
    readers that have no zone.
    """
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            _STAGES.clear()
            try:
                return as_naive(fn(spark, sf_dir))
            finally:
                _STAGES.clear()
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return run
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # importing the query modules fills the registry
    from tidelink.plans import (q_events, q_linkage, q_labels, q_reshape, q_sources,  # noqa: F401
                                q_report)
