"""The catalogue of queries: one for each operator, with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone import catalogue_files, catalogue_graph, catalogue_records

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    """Queries by name."""
    return {name: q for part in (catalogue_records, catalogue_graph, catalogue_files) for name, (q, _) in part.CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {name: sql for part in (catalogue_records, catalogue_graph, catalogue_files) for name, (_, sql) in part.CATALOGUE.items() if sql is not None}
