"""All registered queries of the document engine with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` says the same where SQL can."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return register


def _load() -> None:
    from leafmill.plans import layout_queries, model_queries, text_queries  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged texts cleaned, cut into lines and measured: the extraction's core on one table."""
    _load()
    return _QUERIES["cleaned_document_metrics"](spark, sf_dir)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
