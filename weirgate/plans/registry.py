"""Sources and targets a task can name. Users may add their own."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weirgate.operators.incremental import EDGE, Bounds, increment, previous_bound, previous_edge
from weirgate.operators.records import as_tagged, resolve_variables
from weirgate.operators.windows import fixed_windows
from weirgate.schema import declared_schema, read_schema_file
from weirgate.sinks.database import write_database
from weirgate.sinks.messages import write_messages
from weirgate.sinks.tables import exists, read_table, table_name, write_table
from weirgate.sinks.text import text_path, write_text
from weirgate.sources import api, database, delimited, files, messages

Source = Callable[[SparkSession, dict], "DataFrame | tuple[DataFrame, Bounds]"]
Sink = Callable[[DataFrame, Mapping[str, Any], Mapping[str, Any]], None]

SOURCES: dict[str, Source] = {}
SINKS: dict[str, Sink] = {}


def source(*names: str) -> Callable[[Source], Source]:
    """Register a reader (spark, task) -> tagged frame, or (frame, bounds) for increments."""

    def add(read: Source) -> Source:
        for name in names:
            SOURCES[name] = read
        return read

    return add


def sink(*names: str) -> Callable[[Sink], Sink]:
    """Register a writer (frame, target properties, task)."""

    def add(write: Sink) -> Sink:
        for name in names:
            SINKS[name] = write
        return write

    return add


def flag(value: Any) -> bool:
    return str(value).strip().lower() in ("true", "1", "yes")


def task_schema(spark: SparkSession, task: Mapping[str, Any]) -> T.StructType | None:
    """The declared schema of a task: inline, or in a file."""
    if task.get("schema") is not None:
        return declared_schema(task["schema"])
    return read_schema_file(spark, task["schema_file"]) if task.get("schema_file") else None


def column_map(spark: SparkSession, task: Mapping[str, Any]) -> Mapping:
    value = task["column_name_map"]
    if isinstance(value, Mapping):
        return value
    text = value if value.lstrip().startswith("{") else spark.read.text(value, wholetext=True).first().value
    return json.loads(text)


@source("csv", "CSVProcessor")
def _delimited(spark: SparkSession, task: dict) -> DataFrame:
    props = task.get("delimited_file_props", {})
    header = flag(props.get("header_exists", True))
    markers = props.get("null_markers")
    return delimited.delimited_scan(
        spark, task["data_file"],
        delimiter=props.get("delimiter", ","),
        escape=props.get("escapechar", "\\"),
        markers=delimited.NULL_MARKERS if markers is None else str(markers).split(","),
        header=header,
        schema=None if header else task_schema(spark, task),
        skip_rows=int(props.get("skip_rows", 0)),
        extra_columns=props.get("extra_columns"),
        multi_line=flag(props.get("multi_line", False)),
    )


@source("json", "JsonProcessor")
def _json(spark: SparkSession, task: dict) -> DataFrame:
    return files.json_scan(spark, task["data_file"], task.get("root"), task.get("layout"))


@source("ndjson", "NdJsonProcessor")
def _ndjson(spark: SparkSession, task: dict) -> DataFrame:
    return files.ndjson_scan(spark, task["data_file"], task.get("root"), task.get("layout"))


@source("json_flatten", "JsonFlattenBatchProcessor")
def _flatten(spark: SparkSession, task: dict) -> DataFrame:
    staging = (task["data_file"], task["original_path"]) if task.get("original_path") else None
    return files.flatten_json_scan(spark, task["data_file"], column_map(spark, task), task.get("layout"), staging,
                                   task.get("topic_name"))


@source("avro", "AvroProcessor")
def _avro(spark: SparkSession, task: dict) -> DataFrame:
    return files.avro_scan(spark, task["data_file"])


@source("parquet", "ParquetProcessor")
def _parquet(spark: SparkSession, task: dict) -> DataFrame:
    return files.parquet_scan(spark, task["data_file"])


@source("xml")
def _xml(spark: SparkSession, task: dict) -> DataFrame:
    return files.xml_scan(spark, task["data_file"], task["row_tag"], task_schema(spark, task))


@source("lines")
def _lines(spark: SparkSession, task: dict) -> DataFrame:
    return as_tagged(files.line_scan(spark, task["data_file"]))


def _query(task: Mapping[str, Any]) -> str:
    return resolve_variables(task["source_db"]["query"], task.get("variables", {}))


def edge_table(task: Mapping[str, Any]) -> str:
    """Where a task keeps what it saw at the edge of its loads: beside the audit table, unless it says otherwise."""
    named = task["source_db"]["incremental_mode"].get("edge_table")
    return named or str(task["audit"]["job_audit_table"]).rstrip("/") + "_edge"


def _edges(spark: SparkSession, task: Mapping[str, Any]) -> DataFrame:
    name = edge_table(task)
    return read_table(spark, name) if exists(spark, table_name(name)) else spark.createDataFrame([], EDGE)


def _increment(spark: SparkSession, task: Mapping[str, Any], rows: DataFrame) -> tuple[DataFrame, Bounds]:
    audit = read_table(spark, task["audit"]["job_audit_table"])
    column_name = task["source_db"]["incremental_mode"]["column_name"]
    return increment(rows, column_name, audit, task["job_name"], task["task_name"], _edges(spark, task))


@source("jdbc", "RdbmsProcessor")
def _jdbc(spark: SparkSession, task: dict) -> DataFrame | tuple[DataFrame, Bounds]:
    db, props = task["source_db"], task["rdbms_props"]
    name = resolve_variables(f"{db.get('schema', '')}.{db['rdbms_table']}", task.get("variables", {}))
    if "incremental_mode" in db:
        audit = read_table(spark, task["audit"]["job_audit_table"])
        of_task = task["job_name"], task["task_name"]
        return database.jdbc_incremental_scan(
            spark, props, _query(task), name, db["incremental_mode"]["column_name"], previous_bound(audit, *of_task),
            parts=int(props.get("connections", 32)), seen=previous_edge(_edges(spark, task), audit, *of_task),
        )
    return database.jdbc_scan(spark, props, _query(task), name, partition_column=db.get("partition_column"),
                              parts=int(props.get("connections", 32)))


@source("query", "BigQueryProcessor")
def _catalog_query(spark: SparkSession, task: dict) -> DataFrame | tuple[DataFrame, Bounds]:
    db = task["source_db"]
    rows = database.query_scan(spark, db["query"], db.get("source_name", "query"), db.get("args"),
                               task.get("variables"))
    if "incremental_mode" not in db:
        return rows
    return _increment(spark, task, rows)


@source("snowflake", "SnowFlakeIOProcessor", "SnowflakeProcessor")
def _snowflake(spark: SparkSession, task: dict) -> DataFrame | tuple[DataFrame, Bounds]:
    db = task["source_db"]
    name = f"{db['schema']}.{db['database']}.{db['snowflake_table']}"
    if task.get("data_file"):
        return delimited.unload_scan(spark, task["data_file"], task_schema(spark, task), name)
    options = {f"sf{k}": v for k, v in task["snowflake_props"].items()}
    rows = database.connector_scan(spark, "snowflake", options | {"query": _query(task)}, name)
    if "incremental_mode" not in db:
        return rows
    return _increment(spark, task, rows)


@source("api", "ApiProcessor")
def _api(spark: SparkSession, task: dict) -> DataFrame:
    """Responses fetched beforehand, kept as (url, body) in a table."""
    return api.response_rows(read_table(spark, task["responses"]), task.get("root"), task.get("layout"))


@source("kafka", "KafkaProcessor")
def _kafka(spark: SparkSession, task: dict) -> DataFrame:
    stream = flag(task.get("streaming", True))
    found = messages.kafka_messages(spark, task["topic_name"], task["consumer_config"], stream=stream)
    if _is_avro(task):
        return messages.avro_messages(found, task["topic_name"], _avro_schema(spark, task))
    return messages.json_messages(found, task["topic_name"], task.get("layout"))


def _is_avro(task: Mapping[str, Any]) -> bool:
    return str((task.get("source_data") or {}).get("format", "json")).lower() == "avro"


def _avro_schema(spark: SparkSession, task: Mapping[str, Any]) -> str:
    """The schema of Avro messages, inline or kept in a file."""
    props = task["avro"]
    return props["schema"] if props.get("schema") else spark.read.text(props["schema_file"], wholetext=True).first().value


@source("kafka_flatten", "KafkaFlattenProcessor")
def _kafka_flatten(spark: SparkSession, task: dict) -> DataFrame:
    stream = flag(task.get("streaming", True))
    found = messages.kafka_messages(spark, task["topic_name"], task["consumer_config"], stream=stream,
                                    starting="latest" if stream else None)
    return messages.flatten_messages(found, task["topic_name"], column_map(spark, task), task.get("layout"))


@source("pubsub", "PubsubProcessor")
def _pubsub(spark: SparkSession, task: dict) -> DataFrame:
    """Messages of any connector that gives a ``value`` column, as JSON or Avro."""
    props = task["messages"]
    reader = spark.readStream if flag(task.get("streaming", True)) else spark.read
    if props.get("schema"):
        reader = reader.schema(props["schema"])
    found = reader.format(props["format"]).options(**props.get("options", {})).load()
    name = task["input_subscription"]
    if _is_avro(task):
        return messages.avro_messages(found, name, _avro_schema(spark, task))
    if task.get("windowing_time") and "timestamp" in found.columns:
        found = fixed_windows(found, "timestamp", float(task["windowing_time"]))
    return messages.json_messages(found, name, task.get("layout"))


@sink("bigquery", "bigquery_stream", "table")
def _table(df: DataFrame, target: Mapping[str, Any], task: Mapping[str, Any]) -> None:
    write_table(df, target, task.get("is_filename_req_in_target", False))


@sink("gcs", "text")
def _text(df: DataFrame, target: Mapping[str, Any], task: Mapping[str, Any]) -> None:
    write_text(df, text_path(target))


@sink("kafka", "pubsub")
def _messages(df: DataFrame, target: Mapping[str, Any], task: Mapping[str, Any]) -> None:
    write_messages(df, target)


@sink("rdbms", "rdbms_window")
def _rdbms(df: DataFrame, target: Mapping[str, Any], task: Mapping[str, Any]) -> None:
    write_database(df, target, target.get("columns"))


__all__ = ["SINKS", "SOURCES", "column_map", "edge_table", "flag", "sink", "source", "task_schema"]
