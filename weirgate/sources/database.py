"""JDBC tables and warehouse queries, full and incremental."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.incremental import Bounds, column_maximum, with_ties
from weirgate.operators.records import (
    attach_source_name,
    as_tagged,
    normalise_database_rows,
    resolve_variables,
)


def jdbc_options(props: Mapping[str, Any]) -> dict[str, str]:
    """Connector options from the properties of a database connection.

    Options of the connector itself go under ``options``, by their own names.
    """
    names = {
        "jdbc_url": "url", "url": "url", "driver_class_name": "driver", "driver": "driver",
        "username": "user", "user": "user", "password": "password", "fetchsize": "fetchsize",
        "batchsize": "batchsize", "sessionInitStatement": "sessionInitStatement",
    }
    known = {names[k]: str(v) for k, v in props.items() if k in names}
    return known | {k: str(v) for k, v in (props.get("options") or {}).items()}


def jdbc_frame(spark: SparkSession, props: Mapping[str, Any], query: str,
               partition: tuple[str, Any, Any, int] | None = None) -> DataFrame:
    """A query of a database as a frame; filters, columns and max() reach the database.

    ``partition`` = (column, lower, upper, parts) reads it over that many
    connections; without it a JDBC query is one task.
    """
    options = jdbc_options(props) | {"dbtable": f"({query}) t", "pushDownAggregate": "true"}
    if partition is not None:
        name, lower, upper, parts = partition
        options |= {"partitionColumn": name, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options).load()


def whole_bounds(kind: T.DataType, low: Any, high: Any) -> tuple[Any, Any]:
    """Bounds for a partitioned read: numbers as the whole numbers around them, other values as they are."""
    if not isinstance(kind, T.NumericType):
        return low, high
    down, up = Decimal(str(low)).to_integral_value(ROUND_FLOOR), Decimal(str(high)).to_integral_value(ROUND_CEILING)
    return int(down), int(up)


def _ends(df: DataFrame, name: str) -> tuple[Any, Any]:
    row = df.agg(F.min(name).cast("string").alias("lo"), F.max(name).cast("string").alias("hi")).first()
    return row.lo, row.hi


def jdbc_scan(spark: SparkSession, props: Mapping[str, Any], query: str, source_name: str, *,
              partition_column: str | None = None, parts: int = 32) -> DataFrame:
    """All rows of a query, with the text ``None`` as NULL and timestamps as text."""
    rows = jdbc_frame(spark, props, query)
    if partition_column is not None:
        low, high = _ends(rows, partition_column)
        if low is not None:
            ends = whole_bounds(rows.schema[partition_column].dataType, low, high)
            rows = jdbc_frame(spark, props, query, (partition_column, *ends, parts))
    return _database_rows(rows, source_name)


def jdbc_incremental_scan(spark: SparkSession, props: Mapping[str, Any], query: str, source_name: str,
                          column_name: str, previous: Any, *, parts: int = 32,
                          seen: DataFrame | None = None) -> tuple[DataFrame, Bounds]:
    """Rows above the previous bound, up to the present maximum, and late ones at its edge, of which ``seen`` was loaded.

    The increment column also spreads the read over several connections.
    """
    rows = jdbc_frame(spark, props, query)
    bounds = Bounds(previous, column_maximum(rows, column_name, previous))
    if bounds.high is not None:
        low = previous if previous is not None else _ends(rows, column_name)[0]
        ends = whole_bounds(rows.schema[column_name].dataType, low, bounds.high)
        rows = jdbc_frame(spark, props, query, (column_name, *ends, parts))
    new, bounds = with_ties(rows, column_name, bounds, seen)
    return _database_rows(new, source_name), bounds


def _database_rows(rows: DataFrame, source_name: str) -> DataFrame:
    return as_tagged(attach_source_name(normalise_database_rows(rows), source_name))


def query_scan(spark: SparkSession, query: str, source_name: str, args: Mapping[str, Any] | None = None,
               variables: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a query over catalog tables.

    ``args`` are values for parameter markers (``:name``, and ``IDENTIFIER(:name)``
    for tables); ``variables`` replaces ``##name##`` in the text first.
    """
    text = resolve_variables(query, dict(variables or {}))
    return as_tagged(attach_source_name(spark.sql(text, args=dict(args or {})), source_name))


def connector_scan(spark: SparkSession, connector: str, options: Mapping[str, Any], source_name: str) -> DataFrame:
    """Rows of a warehouse connector (``bigquery``, ``snowflake``) on the class path."""
    rows = spark.read.format(connector).options(**{k: str(v) for k, v in options.items()}).load()
    return as_tagged(attach_source_name(rows, source_name))
