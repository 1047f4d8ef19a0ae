"""Enrichment of records from a lookup table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import column, quoted

BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 5_000_000


def last_per_key(lookup: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row per key, as one aggregation (no sort, partial results before the shuffle).

    Rows that ``order_by`` leaves equal are told apart by their other values, so
    the result does not depend on how the lookup is partitioned.
    """
    rest = [c for c in lookup.columns if c not in keys]
    plain = [c for c in rest if c not in order_by and not isinstance(lookup.schema[c].dataType, (T.MapType, T.VariantType))]
    order = F.struct(*[column(c) for c in (*order_by, *plain)])
    row = F.struct(*[column(c) for c in rest]) if rest else F.struct(F.lit(True).alias("_any"))
    last = lookup.groupBy(*[column(k) for k in keys]).agg(F.max_by(row, order).alias("_last"))
    return last.select(*[column(k) for k in keys], *[F.col("_last").getField(c).alias(c) for c in rest])


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows, measured, stay below ``limit`` bytes.

    The planner's estimate only rules frames out early; it is never taken as
    proof that a frame is small.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    inputs = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if min(estimate, inputs) > 64 * limit:
        return False
    size = F.octet_length(F.to_json(F.struct(*[column(c) for c in df.columns])))
    return (df.agg(F.sum(size).alias("bytes")).first().bytes or 0) <= limit


def _same(left: DataFrame, right: DataFrame, pairs: Mapping[str, str]) -> Column:
    condition = F.lit(True)
    for mine, theirs in pairs.items():
        condition &= left[quoted(mine)].eqNullSafe(right[quoted(theirs)])
    return condition


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task should hold, and how many salts spread them.

    There is one such key per ``rows_per_task`` rows at most, and one pass finds them.
    """
    counts = df.groupBy(*[column(k) for k in keys]).agg(F.count("*").alias("_n"))
    salts = F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")
    found = counts.where(F.col("_n") > rows_per_task).select(*[column(k) for k in keys], salts)
    return df.sparkSession.createDataFrame(found.collect(), T.StructType([T.StructField(f.name, f.dataType) for f in found.schema.fields]))


def _salted(records: DataFrame, lookup: DataFrame, on: Mapping[str, str], rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Spread the records of hot keys over salts and repeat their lookup rows for each salt."""
    hot = hot_keys(records, list(on), rows_per_task)
    mine = F.broadcast(hot)
    # From the record's content, so that a task that runs again salts alike whatever order its rows come in.
    values = [records[quoted(f.name)] for f in records.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.coalesce(F.pmod(F.xxhash64(*values), F.col("_salts")), F.lit(0))
    spread = records.join(mine, _same(records, mine, {k: k for k in on}), "left")
    spread = spread.select(*[records[quoted(c)] for c in records.columns], salt.cast("int").alias("_salt"))
    theirs = F.broadcast(hot.toDF(*on.values(), "_salts"))
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = lookup.join(theirs, _same(lookup, theirs, {v: v for v in on.values()}), "left")
    repeated = repeated.select(*[lookup[quoted(c)] for c in lookup.columns], F.explode(salts).alias("_salt"))
    return spread, repeated


def lookup_join(
    records: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    order_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Lay the last matching lookup row over each record; every record comes out once.

    ``on`` maps record columns to lookup columns; NULL matches NULL. Columns of
    the lookup replace those of the same name, also with NULL. ``order_by`` says
    which of several matching rows is the last; without it keys must not repeat.
    A lookup that was measured to be small is broadcast; otherwise both sides are
    shuffled, with hot keys salted.
    """
    if len(set(on.values())) < len(on):
        raise ValueError("a lookup column may be joined once only")
    missing = [c for c in on if c not in records.columns] + [c for c in on.values() if c not in lookup.columns]
    if not on or missing:
        raise ValueError(f"join columns missing: {missing or 'no join columns given'}")
    theirs = list(on.values())
    if not order_by:
        repeated = lookup.groupBy(*[column(c) for c in theirs]).agg(F.count("*").alias("_n")).where("_n > 1")
        if not repeated.isEmpty():
            raise ValueError(f"several lookup rows for one key of {theirs}: order_by has to say which is the last")
        order_by = theirs
    last = last_per_key(lookup, theirs, order_by)
    pairs = dict(on)
    if fits_broadcast(last, broadcast_bytes):
        left, right = records, F.broadcast(last.withColumn("_matched", F.lit(True)))
    elif records.isStreaming:
        left, right = records, last.withColumn("_matched", F.lit(True))
    else:
        left, right = _salted(records, last, on, rows_per_task)
        right = right.withColumn("_matched", F.lit(True))
        pairs["_salt"] = "_salt"
    # Names of its own on the right keep the two sides apart.
    names = {c: f"_r{i}" for i, c in enumerate(right.columns)}
    right = right.toDF(*names.values())
    joined = left.join(right, _same(left, right, {k: names[v] for k, v in pairs.items()}), "left")
    matched = F.col(names["_matched"])
    out = [
        F.when(matched, F.col(names[c])).otherwise(column(c)).alias(c) if c in last.columns else column(c)
        for c in records.columns
    ]
    out += [F.col(names[c]).alias(c) for c in last.columns if c not in records.columns]
    return joined.select(out)
