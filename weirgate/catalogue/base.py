"""Registration and small helpers of the catalogue."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir.rstrip("/"))

        QUERIES[fn.__name__] = run
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


def millis(name: str) -> Column:
    """Epoch milliseconds of a table's time, which has no zone and is taken as UTC."""
    return F.unix_millis(F.col(name).cast("timestamp"))


def _framed(first: Sequence[str], last: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.string())], names=["value"])
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(list(last), pa.string())], names=["value"])


def write_lines(lines: DataFrame, path: str, first: Sequence[str] = (), last: Sequence[str] = ()) -> str:
    """Write a single text column; every file starts and ends with the given lines."""
    lines = lines.toDF("value")
    if first or last:
        lines = lines.mapInArrow(partial(_framed, first, last), "value string")
    lines.write.mode("append").text(path)
    return path
