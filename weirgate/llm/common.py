"""Staged tables and small rules that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.session import remove_path, scratch_path

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


T = TypeVar("T")


class Stages:
    """Tables written to the shared folder, so that a lost executor loses none of them.

    ``put`` writes a frame and gives it back with its lineage cut; ``drop`` deletes what was
    written so far, but for the tables named in ``keep``. Kept tables go when the session ends.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.paths = spark, label, {}

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = (path, back)
        return back

    def forget(self, *frames: DataFrame) -> None:
        """Delete single tables that are read no more."""
        for frame in frames:
            path, _ = self.paths.pop(id(frame), (None, None))
            if path:
                remove_path(self.spark, path)

    def drop(self, *keep: DataFrame) -> None:
        for path, frame in list(self.paths.values()):
            if not any(frame is k for k in keep):
                self.forget(frame)
            else:
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def returning(batches: Iterable[T]) -> Iterator[T]:
    """The batches of a task; behind the last one, memory that was freed goes back to the system.

    Workers outlive their tasks, and what they hold counts against the executor.
    """
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
