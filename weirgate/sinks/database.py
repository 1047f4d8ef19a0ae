"""JDBC target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from weirgate.operators.records import SOURCE, drop_source_name, stringify
from weirgate.sources.database import jdbc_options


def database_rows(df: DataFrame, columns: Sequence[str], keep_source_name: Any = None) -> DataFrame:
    """Text rows for a database table with the given columns and ``source_name``."""
    if keep_source_name is not None and str(keep_source_name).lower() == "false":
        df = drop_source_name(df)
    return stringify(df, [*columns, *([] if SOURCE in columns else [SOURCE])])


def write_database(df: DataFrame, target: Mapping[str, Any], columns: Sequence[str] | None = None) -> None:
    """Append to a database table, each task over its own connection.

    Without declared columns those of the table itself are used. A task that
    runs again inserts its rows again.
    """
    options = jdbc_options(target) | {"dbtable": str(target["tablename"])}
    if columns is None:
        columns = df.sparkSession.read.format("jdbc").options(**options).load().columns
        rows = stringify(df, columns).select(*columns)
    else:
        rows = database_rows(df, columns, target.get("is_filename_req_in_target"))
    writer = rows.write.format("jdbc").options(**options).mode("append")
    writer.option("numPartitions", str(target.get("connections", 32))).save()
