"""Counts and the audit rows made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import ERROR, SOURCE, column

IN_PROGRESS, COMPLETED, FAILED = "In-Progress", "COMPLETED", "FAILED"


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampType()

# Columns of the two audit tables.
JOB_AUDIT = _table(
    job_id=_TEXT, job_name=_TEXT, task_name=_TEXT, source=_TEXT, source_name=_TEXT, target=_TEXT, target_name=_TEXT,
    delta_start_val=_TEXT, delta_end_val=_TEXT, start_ts=_TIME, end_ts=_TIME,
    src_rec_count=_COUNT, tgt_rec_count=_COUNT, err_rec_count=_COUNT, status=_TEXT,
)
FILE_AUDIT = _table(
    job_id=_TEXT, job_name=_TEXT, task_name=_TEXT, source_name=_TEXT, target=_TEXT, target_name=_TEXT,
    src_rec_count=_COUNT, tgt_rec_count=_COUNT, err_rec_count=_COUNT, load_ts=_TIME,
)

#: One row for each micro-batch of a stream; ``messages`` came in and made ``src_rec_count`` records, good or bad.
STREAM_AUDIT = _table(
    job_id=_TEXT, job_name=_TEXT, task_name=_TEXT, batch=_COUNT, messages=_COUNT,
    src_rec_count=_COUNT, tgt_rec_count=_COUNT, err_rec_count=_COUNT, load_ts=_TIME,
)

# Per kind of target, the name audits show for it and the property they show.
_TARGET_LABELS = {
    "bigquery": ("bigquery", "target_table"),
    "bigquery_stream": ("bigquery", "target_table"),
    "pubsub": ("pubsub", "topic_name"),
    "kafka": ("kafka", "topic_name"),
    "rdbms": ("rdbms", "tablename"),
}


def target_text(targets: Sequence[Mapping[str, Any]]) -> str:
    """The targets of a task as audits show them."""
    parts = []
    for target in targets:
        kind, props = next(iter(target.items()))
        if kind in _TARGET_LABELS:
            label, key = _TARGET_LABELS[kind]
            parts.append('{"%s": %s}' % (label, props[key]))
        else:
            parts.append(str(target))
    return ",".join(parts)


def count_columns() -> list[Column]:
    """Source, target and error counts of a tagged frame."""
    return [
        F.count("*").alias("src_rec_count"),
        F.count_if(column(ERROR).isNull()).alias("tgt_rec_count"),
        F.count_if(column(ERROR).isNotNull()).alias("err_rec_count"),
    ]


def job_counts(tagged: DataFrame) -> DataFrame:
    """All three counts in one aggregate; an empty frame gives zeros."""
    return tagged.agg(*count_columns())


def file_counts(tagged: DataFrame) -> DataFrame:
    """The three counts per source; combined before the shuffle, so a large source is no hot key."""
    return tagged.groupBy(column(SOURCE)).agg(*count_columns())


def grouped_counts(valid: DataFrame, invalid: DataFrame) -> DataFrame:
    """The three counts per source from separate valid and error frames."""
    good = valid.select(column(SOURCE), F.lit(1).alias("ok"))
    bad = invalid.select(column(SOURCE), F.lit(0).alias("ok"))
    return good.unionAll(bad).groupBy(SOURCE).agg(
        F.count("*").alias("src_rec_count"),
        F.sum("ok").cast("bigint").alias("tgt_rec_count"),
        F.count_if(F.col("ok") == 0).alias("err_rec_count"),
    )


def count_per_source(df: DataFrame) -> DataFrame:
    return df.groupBy(column(SOURCE)).agg(F.count("*").alias("rows"))


def counted(tagged: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count while the frame is being written: no pass of its own."""
    seen = Observation(name)
    return tagged.observe(seen, *count_columns()), seen


def job_audit_row(spark: SparkSession, values: Mapping[str, Any]) -> DataFrame:
    """One row of the job audit table; columns not given are NULL."""
    return spark.range(1, numPartitions=1).select(
        [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in JOB_AUDIT.fields]
    )


def file_audit_rows(counts: DataFrame, job_id: str, job_name: str, task_name: str,
                    targets: Sequence[Mapping[str, Any]], load_ts: datetime) -> DataFrame:
    """Rows of the file audit table from counts per source."""
    target = target_text(targets)
    given = {
        "job_id": F.lit(job_id), "job_name": F.lit(job_name), "task_name": F.lit(task_name),
        "target": F.lit(target), "target_name": F.lit(target), "load_ts": F.lit(load_ts),
        "source_name": F.when(column(SOURCE) == "CSVProcessor", "delimited_file").otherwise(column(SOURCE)),
    }
    return counts.select([given.get(f.name, column(f.name)).cast(f.dataType).alias(f.name) for f in FILE_AUDIT.fields])


def stream_audit_row(counts: DataFrame, messages: int, task: Mapping[str, Any], job_id: str, batch: int) -> DataFrame:
    """The row of the stream audit table for one micro-batch, from its three counts."""
    given = {
        "job_id": F.lit(job_id), "job_name": F.lit(task["job_name"]), "task_name": F.lit(task.get("task_name")),
        "batch": F.lit(batch), "messages": F.lit(messages), "load_ts": F.current_timestamp(),
    }
    return counts.select([given.get(f.name, column(f.name)).cast(f.dataType).alias(f.name) for f in STREAM_AUDIT.fields])


def stream_totals(audit: DataFrame) -> DataFrame:
    """Counts of streams so far, per job and task, from the rows of their micro-batches."""
    counts = ("messages", "src_rec_count", "tgt_rec_count", "err_rec_count")
    return audit.groupBy("job_name", "task_name").agg(*(F.sum(c).alias(c) for c in counts), F.max("load_ts").alias("load_ts"))
