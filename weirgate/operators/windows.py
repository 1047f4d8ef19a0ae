"""Fixed time windows and bounded batches of the records in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirgate.operators.records import column
from weirgate.session import remove_at_exit, scratch_path

# Fixed value: format of window bounds in file names.
STAMP = "yyyy_MM_dd_HH_mm"


def window_length(minutes: float) -> str:
    """Length of a window given in minutes, as whole seconds."""
    return f"{int(minutes * 60)} seconds"


def fixed_windows(df: DataFrame, ts: str, minutes: float = 1) -> DataFrame:
    """Add the bounds of the window each record falls into."""
    bounds = F.window(column(ts), window_length(minutes))
    return df.withColumn("window", bounds).select(
        *[column(c) for c in df.columns],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def window_counts(df: DataFrame, ts: str, minutes: float = 1, keys: Sequence[str] = (),
                  late: str = "0 seconds") -> DataFrame:
    """Records per window. On a stream, records later than ``late`` behind the
    newest are dropped and a window is given out once, when it closes."""
    if df.isStreaming:
        df = df.withWatermark(ts, late)
    counts = df.groupBy(F.window(column(ts), window_length(minutes)).alias("window"), *[column(k) for k in keys])
    return counts.agg(F.count("*").alias("messages")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[column(k) for k in keys], "messages",
    )


def number_within(df: DataFrame, groups: Sequence[str], name: str, rows_per_slice: int = 1_000_000) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without ever sorting a whole group.

    Groups are cut into slices by row position, as many as the largest group
    needs. Rows are numbered within their slice, and the sizes of the slices
    before give the offset, so a group that holds much of the data, or many
    copies of one row, is still the work of many tasks. The rows and their
    positions are first written to the shared folder: sizes and numbers must
    come from the same cut, also if a task runs again.
    """
    by = [column(g) for g in groups]
    path = scratch_path(df.sparkSession, "positions")
    df.withColumn("_position", F.monotonically_increasing_id()).write.parquet(path)
    remove_at_exit(df.sparkSession, path)
    rows = df.sparkSession.read.parquet(path)
    largest = rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    slices = F.lit(max(1, -(-largest // rows_per_slice)))
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64("_position"), slices).cast("int"))
    keys = [*by, column("_slice")]
    sizes = cut.groupBy(*keys).agg(F.count("*").alias("_size"))
    before = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_size").over(before), F.lit(0))
    # Names of their own, as a group may be NULL and is to match itself.
    offsets = sizes.select(*[column(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                           column("_slice").alias("_s"), offset.alias("_offset"))
    inside = W.partitionBy(*keys).orderBy("_position")
    numbered = cut.withColumn("_row", F.row_number().over(inside) - 1)
    same = column("_slice") == column("_s")
    for i, g in enumerate(groups):
        same &= column(g).eqNullSafe(column(f"_g{i}"))
    joined = numbered.join(offsets, same)
    return joined.select(*[column(c) for c in df.columns], (F.col("_row") + F.col("_offset")).alias(name))


def window_batches(df: DataFrame, ts: str, minutes: float, size: int = 1000, rows_per_slice: int = 1_000_000) -> DataFrame:
    """Cut the records of each window into batches of at most ``size``."""
    windows = fixed_windows(df, ts, minutes)
    numbered = number_within(windows, ["window_start", "window_end"], "_number", rows_per_slice)
    batch = F.floor(F.col("_number") / size).cast("bigint")
    return numbered.withColumn("batch_no", batch).drop("_number")


def window_name() -> Column:
    """``<start>-<end>`` of a window as it appears in file names."""
    return F.concat_ws("-", F.date_format("window_start", STAMP), F.date_format("window_end", STAMP))
