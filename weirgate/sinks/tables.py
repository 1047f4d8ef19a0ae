"""Table targets: a catalog table, or a folder of files when the name is a path."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import base64_binary, column, drop_source_name
from weirgate.sinks.batches import MERGED, children, folder_of, label_of, live, merge_settled

APPEND, TRUNCATE, EMPTY = "WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"
BATCH_COLUMN = "stream_batch"


def is_path(name: str) -> bool:
    return "/" in name


def table_name(name: str) -> str:
    return name if is_path(name) else name.replace(":", ".")


def exists(spark: SparkSession, name: str) -> bool:
    if not is_path(name):
        return spark.catalog.tableExists(name)
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_table(spark: SparkSession, name: str, data_format: str = "parquet") -> DataFrame:
    name = table_name(name)
    if not is_path(name):
        return spark.table(name)
    reader = spark.read.format(data_format)
    folders = [f.path for f in live(children(spark, name, f"{BATCH_COLUMN}=*"))]
    if not folders:
        return reader.load(name)
    files = children(spark, name, "[!_.]*.*")
    # A batch task may have written into the folder before a stream did: files lie beside the partitions.
    reader = reader.option("recursiveFileLookup", True) if files else reader.option("basePath", name)
    return reader.load([*folders, *files])


def has_rows(spark: SparkSession, name: str, data_format: str = "parquet") -> bool:
    if not exists(spark, name):
        return False
    return not read_table(spark, name, data_format).limit(1).isEmpty()


def _true(value: Any) -> bool:
    return str(value).lower() == "true"


def prepared(df: DataFrame, keep_source_name: Any = False) -> DataFrame:
    """What is written for a record: binary as base64, and ``source_name`` only if asked for."""
    df = base64_binary(df)
    return df if _true(keep_source_name) else drop_source_name(df)


def write_table(df: DataFrame, target: Mapping[str, Any], keep_source_name: Any = False) -> None:
    """Write a frame with the write disposition of the target."""
    spark = df.sparkSession
    name, data_format = table_name(str(target["target_table"])), target.get("format", "parquet")
    disposition = str(target.get("write_disposition", APPEND)).upper()
    if disposition not in (APPEND, TRUNCATE, EMPTY):
        raise ValueError(f"unknown write disposition {disposition!r}")
    if disposition == EMPTY and has_rows(spark, name, data_format):
        raise ValueError(f"{name} has rows already")
    # An empty table counts as free, so what is there may be replaced.
    mode = "append" if disposition == APPEND else "overwrite"
    rows = prepared(df, keep_source_name)
    if mode == "append" and in_batches(spark, name):
        # Streams write here too: these rows get a partition of their own beside theirs.
        _write_partition(rows, name, data_format, f"task_{uuid.uuid4().hex}")
        return
    writer = rows.write.mode(mode).format(data_format)
    if is_path(name):
        writer.save(name)
    else:
        writer.saveAsTable(name)


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of an existing target: unknown ones are dropped, missing ones NULL."""
    return df.select(
        [
            (column(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
            if f.name != BATCH_COLUMN
        ]
    )


def in_batches(spark: SparkSession, name: str) -> bool:
    """Whether a target is kept in partitions by batch, as streams leave it."""
    if not exists(spark, name):
        return False
    if not is_path(name):
        return BATCH_COLUMN in spark.table(name).columns
    return bool(children(spark, name, f"{BATCH_COLUMN}=*"))


def _query_id(spark: SparkSession) -> str | None:
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """Name of a micro-batch that no other stream uses: the query's id, which its checkpoint keeps, and the number."""
    return label_of(_query_id(spark), int(batch_id))


def _write_partition(rows: DataFrame, name: str, data_format: str, label: str) -> None:
    spark = rows.sparkSession
    if is_path(name):
        rows.write.mode("overwrite").format(data_format).save(f"{name.rstrip('/')}/{BATCH_COLUMN}={label}")
        return
    table = spark.table(name)
    label = label if isinstance(table.schema[BATCH_COLUMN].dataType, T.StringType) else str(zlib.crc32(label.encode()))
    rows = fitted(rows, table.schema)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH_COLUMN} = '{label}') SELECT * FROM {{rows}}", rows=rows)


def _write_to_folder(rows: DataFrame, name: str, data_format: str, batch_id: int, many: int) -> None:
    """Write a micro-batch to its folder, unless it has been merged already; then merge what is settled."""
    spark, query = rows.sparkSession, _query_id(rows.sparkSession)
    mine = folder_of(f"{BATCH_COLUMN}={label_of(query, batch_id)}")
    there = [f for f in map(folder_of, children(spark, name, f"{BATCH_COLUMN}=*")) if f.span > 1]
    if any(f.covers(mine) for f in there):
        return
    _write_partition(rows, name, data_format, label_of(query, batch_id))

    def read(paths: Sequence[str]) -> DataFrame:
        found = spark.read.format(data_format).option("basePath", name).option("mergeSchema", True).load(list(paths))
        return found.drop(BATCH_COLUMN)

    def write(merged: DataFrame, path: str) -> None:
        merged.write.mode("overwrite").format(data_format).save(path)

    merge_settled(spark, name, BATCH_COLUMN, query, batch_id, many, read, write)


def write_stream_batch(df: DataFrame, target: Mapping[str, Any], batch_id: int, keep_source_name: Any = False) -> None:
    """Write one micro-batch into its own partition of the target.

    A batch that runs again after a failure replaces what its first run left, so
    the target holds every record once; in folders, settled batches are merged, ``merge_batches`` at a time. Other streams, a fresh checkpoint and
    batch tasks have partitions of their own. A catalog table that a batch task
    made has no partitions by batch; it is appended to, at least once.
    """
    spark = df.sparkSession
    label = batch_label(spark, batch_id)
    name, data_format = table_name(str(target["target_table"])), target.get("format", "parquet")
    rows = prepared(df, keep_source_name)
    if target.get("schema") is not None:
        rows = fitted(rows, target["schema"])
    if is_path(name):
        _write_to_folder(rows, name, data_format, int(batch_id), int(target.get("merge_batches", MERGED)))
    elif not exists(spark, name):
        rows.withColumn(BATCH_COLUMN, F.lit(label)).write.partitionBy(BATCH_COLUMN).format(data_format).saveAsTable(name)
    elif in_batches(spark, name):
        _write_partition(rows, name, data_format, label)
    else:
        fitted(rows, spark.table(name).schema).write.mode("append").format(data_format).saveAsTable(name)
