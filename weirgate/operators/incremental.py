"""Incremental extraction: bounds from the audit table and a typed range filter."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import ERROR, SOURCE, column
from weirgate.session import remove_at_exit, scratch_path

COMPLETED = "COMPLETED"

#: What is kept of the rows at the edge of a load: how many copies of each have been loaded.
EDGE = "job_id string, job_name string, task_name string, digest string, copies bigint, is_null boolean"

# Declared types of increment columns.
DELTA_TYPES = {"integer": "bigint", "timestamp": "timestamp", "date": "date", "datetime": "timestamp_ntz"}


@dataclass(frozen=True)
class Bounds:
    """Rows with ``low < column <= high``; no low bound on the first load.

    ``edge`` has the rows seen so far at the upper bound, or without a value, as ``(digest, copies, is_null)``.
    """

    low: Any
    high: Any
    edge: DataFrame | None = field(default=None, compare=False)

    @property
    def low_text(self) -> str | None:
        return None if self.low is None else str(self.low)

    @property
    def high_text(self) -> str | None:
        return None if self.high is None else str(self.high)


def column_maximum(df: DataFrame, name: str, at_least: Any = None) -> str | None:
    """Largest value as text; NULLs do not count. JDBC sources compute it in the database.

    As text it means the same in the audit table and in the next load, whatever
    the time zone of the driver is. It is never below ``at_least``, the bound of
    the load before: a source that is empty for a while does not start over.
    """
    high = df.agg(F.max(column(name)).alias("hi"))
    if at_least is not None:
        high = high.select(F.greatest("hi", delta_literal(at_least, df.schema[name].dataType)).alias("hi"))
    return high.select(F.col("hi").cast("string")).first().hi


def latest_runs(audit: DataFrame) -> DataFrame:
    """The last completed run of every job and task, without a sort per task."""
    done = audit.where((F.col("status") == COMPLETED) & F.col("end_ts").isNotNull())
    others = [c for c in audit.columns if c not in ("job_name", "task_name", "end_ts")]
    last = done.groupBy("job_name", "task_name").agg(
        F.max(F.struct("end_ts", *[column(c) for c in others])).alias("last")
    )
    return last.select("job_name", "task_name", "last.*")


def latest_run(audit: DataFrame, job_name: str, task_name: str) -> DataFrame:
    """The last completed run of one task: a top-1, not a sort of the audit table."""
    done = audit.where(
        (F.col("status") == COMPLETED) & F.col("end_ts").isNotNull()
        & (F.col("job_name") == job_name) & (F.col("task_name") == task_name)
    )
    return done.orderBy(F.desc("end_ts")).limit(1)


def previous_bound(audit: DataFrame, job_name: str, task_name: str) -> str | None:
    """Upper bound of the last completed load, as kept in the audit table."""
    row = latest_run(audit, job_name, task_name).select("delta_end_val").first()
    return None if row is None else row.delta_end_val


def delta_literal(value: Any, datatype: str | T.DataType) -> Column:
    """A bound as a typed literal, so that filters on it reach the source."""
    if isinstance(datatype, str):
        kind = DELTA_TYPES.get(datatype.lower(), datatype)
    else:
        kind = datatype.simpleString()
    return F.lit(value).cast(kind)


def within(df: DataFrame, name: str, bounds: Bounds) -> DataFrame:
    """The rows of one increment.

    The first load takes everything that is there, so also rows without a value;
    rows that arrive above the upper bound meanwhile are left to the next load.
    """
    kind = df.schema[name].dataType
    if bounds.high is None:
        return df if bounds.low is None else df.where(column(name) > delta_literal(bounds.low, kind))
    upto = column(name) <= delta_literal(bounds.high, kind)
    if bounds.low is None:
        return df.where(upto | column(name).isNull())
    return df.where((column(name) > delta_literal(bounds.low, kind)) & upto)


def previous_edge(edges: DataFrame, audit: DataFrame, job_name: str, task_name: str) -> DataFrame | None:
    """What the last completed load saw at its edge; None if it kept nothing of it."""
    row = latest_run(audit, job_name, task_name).select("job_id").first()
    if row is None:
        return None
    of_task = (F.col("job_name") == job_name) & (F.col("task_name") == task_name)
    edge = edges.where(of_task & (F.col("job_id") == row.job_id)).select("digest", "copies", "is_null")
    return None if edge.isEmpty() else edge


def edge_rows(edge: DataFrame, job_id: str, job_name: str, task_name: str) -> DataFrame:
    """An edge as rows of the table that keeps it for the next load."""
    return edge.select(
        F.lit(job_id).alias("job_id"), F.lit(job_name).alias("job_name"), F.lit(task_name).alias("task_name"),
        "digest", "copies", "is_null",
    )


def _at_edge(df: DataFrame, name: str, bounds: Bounds) -> DataFrame:
    """Rows at either bound or without a value, equal ones as one: ``(digest, copies, is_null, is_high, row)``.

    They are written once, so that what is loaded and what is remembered come from the same reading.
    """
    kind, value = df.schema[name].dataType, column(name)
    ends = {bounds.low, bounds.high} - {None}
    at = value.isNull()
    for end in sorted(map(str, ends)):
        at = at | (value == delta_literal(end, kind))
    row = F.struct(*[column(c) for c in df.columns])
    told_by = F.struct(*[column(c) for c in df.columns if c not in (SOURCE, ERROR)])
    high = F.lit(False) if bounds.high is None else F.coalesce(value == delta_literal(bounds.high, kind), F.lit(False))
    rows = df.where(at).select(
        F.sha2(F.to_json(told_by, {"ignoreNullFields": "false"}).cast("binary"), 256).alias("digest"),
        value.isNull().alias("is_null"), high.alias("is_high"), row.alias("row"),
    )
    grouped = rows.groupBy("digest", "is_null", "is_high").agg(F.count("*").alias("copies"), F.first("row").alias("row"))
    path = scratch_path(df.sparkSession, "edge")
    grouped.write.parquet(path)
    remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(grouped.schema).parquet(path)


def with_ties(df: DataFrame, name: str, bounds: Bounds, seen: DataFrame | None) -> tuple[DataFrame, Bounds]:
    """The rows of one increment, and of those at its lower bound or without a value all that were not loaded before.

    Rows at the edge are told apart by a digest of all their columns, equal ones by their number. Only they are grouped and
    joined with what was seen; all others are taken by their value alone. A row that was seen stays seen if the source
    loses it for a while. Without ``seen``, from a load that kept no edge, rows at its bound count as loaded.
    """
    kind, value = df.schema[name].dataType, column(name)
    edge = _at_edge(df, name, bounds)
    before = seen if seen is not None else df.sparkSession.createDataFrame([], "digest string, copies bigint, is_null boolean")
    known = before.groupBy(F.col("digest").alias("_digest")).agg(F.max("copies").alias("_loaded"))
    left = F.col("copies") - F.coalesce("_loaded", F.lit(0))
    late = edge
    if seen is None and bounds.low is not None:
        late = edge.where(F.col("is_high") & F.lit(str(bounds.low) != str(bounds.high)))
    new = late.join(known, F.col("digest") == F.col("_digest"), "left").where(left > 0)
    rows = new.select("row", F.explode(F.sequence(F.lit(1).cast("long"), left))).select("row.*")
    if bounds.high is not None:
        middle = value < delta_literal(bounds.high, kind)
        if bounds.low is not None:
            middle = (value > delta_literal(bounds.low, kind)) & middle
        rows = df.where(middle).unionByName(rows)
    same = F.lit(str(bounds.low) == str(bounds.high))
    kept = edge.where("is_high OR is_null").select("digest", "copies", "is_null")
    kept = kept.unionByName(before.where(F.col("is_null") | same)).groupBy("digest", "is_null").agg(F.max("copies").alias("copies"))
    return rows, Bounds(bounds.low, bounds.high, kept.select("digest", "copies", "is_null"))


def increment(df: DataFrame, name: str, audit: DataFrame, job_name: str, task_name: str,
              edges: DataFrame | None = None) -> tuple[DataFrame, Bounds]:
    """The rows of ``df`` that the last completed load has not seen, and their bounds.

    With ``edges``, the table that keeps the edges of loads, rows that tie with the last bound and rows
    without a value are loaded when they arrive later, too; without, they are not.
    """
    previous = previous_bound(audit, job_name, task_name)
    bounds = Bounds(previous, column_maximum(df, name, previous))
    if edges is None:
        return within(df, name, bounds), bounds
    return with_ties(df, name, bounds, previous_edge(edges, audit, job_name, task_name))
