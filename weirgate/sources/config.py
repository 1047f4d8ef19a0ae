"""Task and job properties kept in tables."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.operators.records import column


def matching_config(table: DataFrame, key: str, pattern: str) -> DataFrame:
    """Rows whose key is like a SQL pattern."""
    return table.where(column(key).like(pattern))


def merged_properties(table: DataFrame, name: str = "properties") -> DataFrame:
    """Add all properties of a row as one map of text.

    The JSON object in ``additional_input`` is laid over the other columns.
    """
    plain = [c for c in table.columns if c != "additional_input"]
    own = F.create_map(*[x for c in plain for x in (F.lit(c), column(c).cast("string"))])
    if "additional_input" not in table.columns:
        return table.withColumn(name, own)
    more = F.coalesce(F.from_json("additional_input", "map<string,string>"), F.map_from_arrays(F.array(), F.array()))
    more = more.cast("map<string,string>")
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(more, k))
    return table.withColumn(name, F.map_concat(kept, more))


def task_properties(table: DataFrame, pattern: str) -> list[dict[str, Any]]:
    """The tasks whose ``task_id`` is like the pattern, as dicts for ``plans.run_tasks``."""
    return [_as_dict(r.asDict()) for r in matching_config(table, "task_id", pattern).collect()]


def first_job(table: DataFrame, pattern: str, order_by: str | None = None) -> DataFrame:
    """The first job whose ``job_name`` is like the pattern, as a frame of at most one row."""
    rows = matching_config(table, "job_name", pattern)
    return (rows if order_by is None else rows.orderBy(order_by)).limit(1)


def job_properties(table: DataFrame, pattern: str, order_by: str | None = None) -> dict[str, Any]:
    """The first job whose ``job_name`` is like the pattern."""
    row = first_job(table, pattern, order_by).first()
    if row is None:
        raise LookupError(f"no job like {pattern!r}")
    return _as_dict(row.asDict())


def _as_dict(row: dict[str, Any]) -> dict[str, Any]:
    more = row.pop("additional_input", None)
    return row | (json.loads(more) if more else {})
