"""Registry of named queries: a DataFrame builder and, where SQL can express
it, an independent oracle SQL text over the provided tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``ids``: the operator ids of the inventory this query covers.
    ``sql``: oracle SQL (DuckDB dialect, ANSI subset) with identical column names.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from . import (alarm_queries, alert_queries, metric_queries, model_queries,  # noqa: F401
                   prepare_queries, quality_queries, report_queries, stream_queries,
                   telemetry_queries)
