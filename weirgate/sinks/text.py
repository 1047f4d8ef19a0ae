"""Text targets: JSON lines, files per time window, and the raw archive."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.operators.records import archive_line, column, record_json
from weirgate.operators.windows import STAMP, fixed_windows

# Minutes per window of the two sinks, and records per file.
TEXT_MINUTES, ARCHIVE_MINUTES, RECORDS_PER_FILE = 10, 300, 1000


def text_path(target: Mapping[str, Any]) -> str:
    """Where a text target is to be written."""
    return str(target.get("path") or target["output_path"])


def write_text(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line."""
    df.select(record_json(df).alias("value")).write.mode(mode).text(path)


def write_windowed_text(df: DataFrame, ts: str, path: str, line: Column | None = None,
                        minutes: float = TEXT_MINUTES, records: int = RECORDS_PER_FILE, mode: str = "append") -> None:
    """Lines in one folder per window, with at most ``records`` in a file.

    Rows of a window are brought together first, so that not every task writes a
    file for every window; the rebalancing cuts large windows over several tasks.
    """
    rows = fixed_windows(df.withColumn("value", record_json(df) if line is None else line), ts, minutes)
    named = rows.select(
        "value",
        F.date_format("window_start", STAMP).alias("window_start"),
        F.date_format("window_end", STAMP).alias("window_end"),
    )
    writer = named.hint("rebalance", "window_start", "window_end").write.mode(mode).option("maxRecordsPerFile", records)
    writer.partitionBy("window_start", "window_end").text(path)


def write_archive(df: DataFrame, ts: str, message_id: str, payload: str, path: str, mode: str = "append",
                  records: int = RECORDS_PER_FILE) -> None:
    """Raw messages with their ids, in long windows."""
    line = archive_line(column(message_id), column(payload))
    write_windowed_text(df, ts, path, line, ARCHIVE_MINUTES, records, mode)
