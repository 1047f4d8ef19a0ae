"""Streams of files and messages, written micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weirgate.operators.audit import job_counts, stream_audit_row
from weirgate.operators.lookup import lookup_join
from weirgate.operators.records import MESSAGE_ID, SOURCE, split
from weirgate.operators.windows import window_counts
from weirgate.sinks.database import write_database
from weirgate.sinks.messages import write_messages
from weirgate.sinks.tables import batch_label, write_stream_batch
from weirgate.sinks.text import RECORDS_PER_FILE, text_path, write_archive, write_windowed_text
from weirgate.streaming.snapshots import PeriodicLookup

# How often a continuous source looks for files, and a windowed database target writes.
POLL, DATABASE_INTERVAL = "500 milliseconds", "60 seconds"


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(source_name, value) of files as they appear; each file is read once."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("_metadata.file_path").alias(SOURCE), "value")


def stream_table(spark: SparkSession, path: str, schema: T.StructType, data_format: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(data_format).load(path)


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    interval: str | None = POLL,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` for every micro-batch."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def write_targets(batch: DataFrame, batch_id: int, targets: Sequence[Mapping[str, Any]], task: Mapping[str, Any],
                  event_time: str | None = None, sinks: Mapping[str, Callable] | None = None) -> None:
    """Write the valid rows of a micro-batch to every target, in order.

    ``sinks`` holds writers for kinds of target not known here.
    """
    for target in targets:
        kind, props = next(iter(target.items()))
        if kind in ("bigquery", "bigquery_stream", "table"):
            write_stream_batch(batch, props, batch_id, task.get("is_filename_req_in_target", False))
        elif kind in ("kafka", "pubsub"):
            write_messages(batch, props)
        elif kind in ("rdbms", "rdbms_window"):
            write_database(batch, props, props.get("columns"))
        elif kind in ("gcs", "text"):
            path = f"{text_path(props).rstrip('/')}/batch={batch_label(batch.sparkSession, batch_id)}"
            timed = batch if event_time else batch.withColumn("_arrived", F.current_timestamp())
            records = int(props.get("records_per_file", RECORDS_PER_FILE))
            write_windowed_text(timed, event_time or "_arrived", path, records=records, mode="overwrite")
        elif sinks and kind in sinks:
            sinks[kind](batch, props, task)
        else:
            raise ValueError(f"unknown target {kind!r}")


def stream_audit_table(task: Mapping[str, Any]) -> str | None:
    """Where the counts of a task's micro-batches go, if it is audited.

    A row for each query and micro-batch, in a folder of the micro-batch's own: one that runs again replaces its row.
    """
    audit = task.get("audit") or {}
    if str(audit.get("required", False)).lower() != "true":
        return None
    return audit.get("stream_audit_table") or str(audit["job_audit_table"]).rstrip("/") + "_stream"


def fan_out(task: Mapping[str, Any], job_id: str, shape: Callable[[DataFrame, int], DataFrame] | None = None,
            event_time: str | None = None, sinks: Mapping[str, Callable] | None = None) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer for a task: shape, split, write to all targets and the error table.

    The micro-batch is kept while several writers read it, so ids and results
    are the same for all of them. With ``gcs_triaging_path`` the lines as they
    came are archived there with their ids. ``shape`` gets a micro-batch and its
    number. An audited task counts each micro-batch, see ``stream_audit_table``.
    """
    error = task.get("error") or {}
    audit = stream_audit_table(task)
    archive = task.get("gcs_triaging_path")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        tagged = batch if shape is None else shape(batch, batch_id).persist()
        try:
            if archive:
                arrived = batch.withColumn("_arrived", F.current_timestamp())
                path = f"{str(archive).rstrip('/')}/batch={batch_label(batch.sparkSession, batch_id)}"
                records = int(task.get("triaging_records_per_file", RECORDS_PER_FILE))
                write_archive(arrived, "_arrived", MESSAGE_ID, "value", path, mode="overwrite", records=records)
            parts = split(tagged, task["job_name"], job_id, str(task["targets"]))
            write_targets(parts.valid, batch_id, task["targets"], task, event_time, sinks)
            if error.get("error_table") and str(error.get("insert_error_rec", True)).lower() == "true":
                write_stream_batch(parts.invalid, {"target_table": error["error_table"]}, batch_id, True)
            if audit:
                # Both frames are kept, so their counts read nothing again.
                counts = stream_audit_row(job_counts(tagged), batch.count(), task, job_id, batch_id)
                write_stream_batch(counts, {"target_table": audit}, batch_id, True)
        finally:
            tagged.unpersist()
            batch.unpersist()

    return write


def start_window_counts(messages: DataFrame, ts: str, path: str, checkpoint: str, minutes: float = 1,
                        late: str = "0 seconds", available_now: bool = False) -> StreamingQuery:
    """Counts per closed window to a folder, each window once."""
    counts = window_counts(messages, ts, minutes, late=late)
    writer = counts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=POLL)
    return writer.start(path)


def enrich_batch(read_lookup: Callable[[SparkSession], DataFrame], on: Mapping[str, str],
                 order_by: Sequence[str]) -> Callable[[DataFrame, int], DataFrame]:
    """Lookup join for micro-batches that reads the lookup again for each of them."""

    def enrich(batch: DataFrame, batch_id: int = 0) -> DataFrame:
        return lookup_join(batch, read_lookup(batch.sparkSession), on, order_by)

    return enrich


def enrich_by_period(lookup: PeriodicLookup, on: Mapping[str, str], order_by: Sequence[str]) -> Callable[[DataFrame, int], DataFrame]:
    """Lookup join for micro-batches with the version of the lookup that each of them has pinned."""

    def enrich(batch: DataFrame, batch_id: int) -> DataFrame:
        return lookup_join(batch, lookup.at(batch.sparkSession, batch_id), on, order_by)

    return enrich
