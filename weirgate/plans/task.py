"""Run tasks: one source, shaping, any number of targets, audits."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weirgate.operators.audit import (
    COMPLETED,
    FAILED,
    IN_PROGRESS,
    counted,
    file_audit_rows,
    file_counts,
    job_audit_row,
    target_text,
)
from weirgate.operators.incremental import Bounds, edge_rows
from weirgate.operators.lookup import lookup_join
from weirgate.operators.records import ERROR, SOURCE, column, error_records, message_ids, select_required, spread
from weirgate.plans.registry import SINKS, SOURCES, column_map, edge_table, flag, task_schema
from weirgate.schema import conform
from weirgate.session import remove_path, scratch_path
from weirgate.sinks.tables import APPEND, BATCH_COLUMN, has_rows, read_table, table_name, write_table
from weirgate.sources.files import flatten_lines
from weirgate.streaming.runner import DATABASE_INTERVAL, POLL, fan_out, start, stream_lines
from weirgate.streaming.snapshots import PeriodicLookup

log = logging.getLogger(__name__)

TABLE_KINDS = ("bigquery", "bigquery_stream", "table")
REQUIRED = ("job_name", "task_name", "input_processor", "targets")


@dataclass(frozen=True)
class TaskResult:
    job_id: str
    job_name: str
    task_name: str
    status: str
    source_rows: int | None = None
    target_rows: int | None = None
    error_rows: int | None = None
    bounds: Bounds | None = None
    error: str | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc)


def check_task(task: Mapping[str, Any]) -> None:
    missing = [k for k in REQUIRED if not task.get(k)]
    if missing:
        raise ValueError(f"task lacks {', '.join(missing)}")
    if task["input_processor"] not in SOURCES and task["input_processor"] not in STREAMS:
        raise ValueError(f"unknown source {task['input_processor']!r}; known: {', '.join(sorted(SOURCES))}")
    for target in task["targets"]:
        kind = next(iter(target))
        if kind not in SINKS:
            raise ValueError(f"unknown target {kind!r}; known: {', '.join(sorted(SINKS))}")


def _source_name(task: Mapping[str, Any]) -> str:
    db = task.get("source_db") or {}
    if db.get("snowflake_table"):
        return f"{db['schema']}.{db['database']}.{db['snowflake_table']}"
    if db.get("rdbms_table"):
        return f"{db.get('schema', '')}.{db['rdbms_table']}"
    return str(task.get("api_path") or task.get("source") or task["input_processor"])


def _audit_values(task: Mapping[str, Any], job_id: str, started: datetime) -> dict[str, Any]:
    target = target_text(task["targets"])
    return {
        "job_id": job_id, "job_name": task["job_name"], "task_name": task["task_name"],
        "source": str(task.get("source") or task["input_processor"]), "source_name": _source_name(task),
        "target": target, "target_name": target, "start_ts": started,
    }


def _stage(tagged: DataFrame, path: str) -> DataFrame:
    """Write the frame once to the shared folder and continue from there.

    Good and bad records lie in folders of their own, so reading one kind does
    not touch the other, and ids and times are settled.
    """
    bad = column(ERROR).isNotNull()
    tagged.withColumn("_bad", bad).write.partitionBy("_bad").parquet(path)
    schema = tagged.withColumn("_bad", bad).schema
    return tagged.sparkSession.read.schema(schema).parquet(path)


def _tagged(spark: SparkSession, task: dict, finish: bool = True) -> tuple[DataFrame, Bounds | None]:
    found = SOURCES[task["input_processor"]](spark, task)
    tagged, bounds = found if isinstance(found, tuple) else (found, None)
    schema = task_schema(spark, task) or _target_schema(spark, task)
    if schema is not None:
        tagged = conform(tagged, schema)
    return (_finished(spark, task, tagged) if finish else tagged), bounds


def _finished(spark: SparkSession, task: Mapping[str, Any], tagged: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    tagged = _enriched(spark, task, tagged, lookup)
    return select_required(tagged, task["required_columns"]) if task.get("required_columns") else tagged


def _lookup(spark: SparkSession, task: Mapping[str, Any]) -> DataFrame:
    props = task["read_properties"]
    return spark.sql(props["query"], args=props.get("args") or {})


def _enriched(spark: SparkSession, task: Mapping[str, Any], tagged: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Lay the rows of the task's lookup query, or of a version of it, over its records, if it has one."""
    pairs = (task.get("filter_properties") or {}).get("join_column")
    if not pairs:
        return tagged
    lookup = _lookup(spark, task) if lookup is None else lookup
    return lookup_join(tagged, lookup, pairs, task["read_properties"].get("order_by"))


def _target_schema(spark: SparkSession, task: Mapping[str, Any]) -> T.StructType | None:
    """Columns of the table rows are appended to, if it is there already."""
    for target in task["targets"]:
        kind, props = next(iter(target.items()))
        appended = str(props.get("write_disposition", APPEND)).upper() == APPEND
        if kind in TABLE_KINDS and appended and has_rows(spark, table_name(props["target_table"]), props.get("format", "parquet")):
            found = read_table(spark, props["target_table"], props.get("format", "parquet")).schema
            return T.StructType([f for f in found.fields if f.name not in (SOURCE, BATCH_COLUMN)])
    return None


def run_task(spark: SparkSession, task: dict[str, Any]) -> TaskResult:
    """Read, shape and split the records, write them to all targets, audit.

    With one target and no other reader the records stream from source to target
    in a single pass and are counted on the way; a second pass runs only if bad
    records turned up and are to be kept. With several readers they are staged
    once in the shared folder.
    """
    check_task(task)
    job_id = str(task.get("job_id") or uuid.uuid4())
    started = _now()
    audit = task.get("audit") or {}
    audited = flag(audit.get("required", False))
    values = _audit_values(task, job_id, started)

    def write_audit(**more: Any) -> None:
        if audited:
            write_table(job_audit_row(spark, values | more), {"target_table": audit["job_audit_table"]}, True)

    write_audit(status=IN_PROGRESS)
    staged = None
    try:
        tagged, bounds = _tagged(spark, task)
        per_file = audited and flag(audit.get("enable_file_level_auditing", False))
        tagged, seen = counted(tagged, f"counts_{uuid.uuid4().hex}")
        if len(task["targets"]) > 1 or per_file:
            staged = scratch_path(spark, "staged")
            rows = _stage(tagged, staged)
            good, bad = rows.where(~F.col("_bad")), rows.where(F.col("_bad"))
        else:
            rows = tagged
            good, bad = rows.where(column(ERROR).isNull()), rows.where(column(ERROR).isNotNull())
        valid = good.drop(ERROR, "_bad")
        for target in task["targets"]:
            kind, props = next(iter(target.items()))
            SINKS[kind](valid, props, task)
        counts = seen.get
        if counts["err_rec_count"]:
            _write_errors(bad, task, job_id)
        if per_file:
            files = file_audit_rows(file_counts(rows), job_id, task["job_name"], task["task_name"], task["targets"], _now())
            write_table(files, {"target_table": audit["file_audit_table"]}, True)
        if audited and bounds is not None and bounds.edge is not None:
            # A load that does not complete has no say in the next one, whatever it left here.
            kept = edge_rows(bounds.edge, job_id, task["job_name"], task["task_name"])
            write_table(kept, {"target_table": edge_table(task)}, True)
    except Exception as problem:
        write_audit(status=FAILED, end_ts=_now())
        log.error("task %s failed: %s", task["task_name"], problem)
        raise
    finally:
        if staged is not None:
            remove_path(spark, staged)
    write_audit(
        status=COMPLETED, end_ts=_now(), **counts,
        delta_start_val=None if bounds is None else bounds.low_text,
        delta_end_val=None if bounds is None else bounds.high_text,
    )
    return TaskResult(job_id, task["job_name"], task["task_name"], COMPLETED, counts["src_rec_count"],
                      counts["tgt_rec_count"], counts["err_rec_count"], bounds)


def _write_errors(bad: DataFrame, task: Mapping[str, Any], job_id: str) -> None:
    error = task.get("error") or {}
    if error.get("error_table") and flag(error.get("insert_error_rec", True)):
        records = error_records(bad, task["job_name"], job_id, str(task["targets"]))
        disposition = error.get("error_table_write_disposition", "WRITE_APPEND")
        write_table(records, {"target_table": error["error_table"], "write_disposition": disposition}, True)


def run_tasks(spark: SparkSession, tasks: Iterable[dict[str, Any]]) -> list[TaskResult]:
    """Run tasks one after the other; one that fails does not stop the others."""
    results = []
    for task in tasks:
        try:
            results.append(run_task(spark, task))
        except Exception as problem:
            results.append(
                TaskResult(str(task.get("job_id") or ""), str(task.get("job_name")), str(task.get("task_name")), FAILED,
                           error=str(problem))
            )
    return results


def _file_stream(spark: SparkSession, task: dict) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    mapping, schema = column_map(spark, task), task_schema(spark, task)
    lines = message_ids(stream_lines(spark, task["data_file"], task.get("files_per_batch")))

    def shape(batch: DataFrame) -> DataFrame:
        rows = flatten_lines(spread(batch), mapping, task.get("layout"), task.get("topic_name"))
        if schema is not None:
            rows = conform(rows, schema)
        elif task.get("layout") is None:
            # What one batch looks like says nothing about the next: without declared types all is text.
            rows = rows.withColumns({name: column(name).cast("string") for name in mapping["flat_table_mapping"]})
        return rows

    return lines, shape


STREAMS: dict[str, Callable[[SparkSession, dict], tuple[DataFrame, Callable | None]]] = {
    "json_flatten_stream": _file_stream,
    "JsonFlattenStreamingProcessor": _file_stream,
}


def run_stream_task(spark: SparkSession, task: dict[str, Any], checkpoint: str,
                    available_now: bool = False) -> StreamingQuery:
    """Start a task on an unbounded source.

    The lookup, if there is one, is read again for each micro-batch, or with ``refresh_seconds`` once in so many
    seconds; what it was for a micro-batch is then kept beside the checkpoint. Audited tasks count every micro-batch.
    """
    check_task(task)
    job_id = str(task.get("job_id") or uuid.uuid4())
    if task["input_processor"] in STREAMS:
        stream, read = STREAMS[task["input_processor"]](spark, task)
    else:
        stream, _ = _tagged(spark, task, finish=False)
        read = None
    seconds = (task.get("read_properties") or {}).get("refresh_seconds")
    lookup = None
    if seconds is not None:
        lookup = PeriodicLookup(lambda session: _lookup(session, task), f"{checkpoint.rstrip('/')}_lookup", float(seconds))

    def shape(batch: DataFrame, batch_id: int) -> DataFrame:
        session = batch.sparkSession
        version = lookup.at(session, batch_id) if lookup is not None else None
        if read is not None:
            return _enriched(session, task, read(batch), version)
        return _finished(session, task, batch, version)

    windowed = any("rdbms_window" in target for target in task["targets"])
    return start(stream, fan_out(task, job_id, shape, task.get("event_time"), SINKS), checkpoint,
                 interval=DATABASE_INTERVAL if windowed else POLL, available_now=available_now)
