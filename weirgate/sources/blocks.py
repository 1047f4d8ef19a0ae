"""Files read block by block, with what a task has to know of what lies before its block.

A block is what one split of a file holds: the pieces, lines or whatever a separator gives, that begin in it. What
lies before a block is summed up by a prefix over one small row per block; the facts are then attached to the pieces
of each block without moving them. Records that cross blocks come out as fragments, which are joined by number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirgate.operators.records import SOURCE, column
from weirgate.session import remove_at_exit, scratch_path, session_like

START, VALUE = "block_start", "value"
#: Facts up to so many bytes are sent to every task; beyond, pieces are brought to them.
SENT_BYTES = 32 << 20
#: Of blocks smaller than this, a task takes as many as come to it, once there are some tasks for every core.
TASK_BYTES, TASKS_PER_CORE = 8 << 20, 4
#: Roles of fragments, in their order within a block: the end of a record, a middle piece, its beginning.
LAST, MIDDLE, FIRST = 0, 1, 2

FRAGMENT = f"{SOURCE} string, {START} bigint, role int, {VALUE} string"


def block_session(spark: SparkSession, block_bytes: int | None) -> SparkSession:
    """A session that reads files in blocks of ``block_bytes``; the session itself if that is None."""
    if block_bytes is None:
        return spark
    size = str(block_bytes)
    return session_like(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size})


def _together(pieces: DataFrame) -> DataFrame:
    """Pieces of small blocks in fewer tasks, each with neighbouring blocks; the cost of a task would exceed that of a block."""
    spark = pieces.sparkSession
    splits = pieces._jdf.queryExecution().toRdd().getNumPartitions()
    blocks = splits * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-blocks // TASK_BYTES))
    return pieces.coalesce(tasks) if tasks < splits else pieces


def block_pieces(spark: SparkSession, path: str | Sequence[str], separator: str | None = None, above: int = -1) -> DataFrame:
    """(source_name, block_start, value) for the pieces of files, those of a block in order in one task.

    With ``above``, only of files of more bytes than that, and with their ``file_size``.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    meta = [F.col("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_block_start").alias(START)]
    pieces = reader.text(path)
    if above >= 0:
        pieces = pieces.where(F.col("_metadata.file_size") > above)
        meta.append(F.col("_metadata.file_size").alias("file_size"))
    return _together(pieces.select(*meta[:2], VALUE, *meta[2:]))


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bool, pa.RecordBatch]]:
    """Slices of batches that belong to one block: its name, whether they are its first, the rows."""
    before = None
    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)) if _mixed(batch) else None
        at = 0
        while at < batch.num_rows:
            if names is None:
                end, name = batch.num_rows, (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            else:
                name, end = names[at], at + 1
                while end < len(names) and names[end] == name:
                    end += 1
            yield name, name != before, batch.slice(at, end - at)
            before, at = name, end


def _mixed(batch: pa.RecordBatch) -> bool:
    """Whether a batch may hold rows of several blocks; its rows are in order."""
    n = batch.num_rows
    return n > 0 and any(batch.column(i)[0] != batch.column(i)[n - 1] for i in (0, 1))


def keep(blocks: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """A small table of facts, written once, so that all who read it see the same; it belongs to ``spark`` if given."""
    spark = spark or blocks.sparkSession
    path = scratch_path(spark, "blocks")
    blocks.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(blocks.schema).parquet(path)


def before(value: Column) -> Column:
    """Sum of a value over all earlier blocks of a file."""
    order = Window.partitionBy(SOURCE).orderBy(START).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(order), F.lit(0))


def with_state(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks with ``name``, whether they begin inside, from how they end if they begin ``outside`` or ``inside``.

    A block leaves the state as it is, turns it round, or ends in one state whatever it was. So the state is the
    end of the last block of the third kind, turned round as often as later ones do. Files begin outside.
    """
    turning = F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)
    blocks = blocks.withColumn("_turns", before(turning))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("end"), F.col("_turns").alias("at")))
    earlier = Window.partitionBy(SOURCE).orderBy(START).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_last", F.last(fixed, ignorenulls=True).over(earlier))
    turned = F.col("_turns") - F.coalesce(F.col("_last.at"), F.lit(0)) + F.coalesce(F.col("_last.end"), F.lit(0))
    return blocks.withColumn(name, turned % 2 == 1).drop("_turns", "_last")


def attach(pieces: DataFrame, blocks: DataFrame, keys: Sequence[str] = (SOURCE, START)) -> DataFrame:
    """Pieces with the facts of their blocks, or of their files, those of a block still in order in one task.

    Facts go to the pieces if their measured size is small, which it is up to some hundred thousand blocks. The
    result belongs to the session of the facts.
    """
    names = [*pieces.columns, *(c for c in blocks.columns if c not in keys)]
    size = blocks.agg(F.sum(F.octet_length(SOURCE) + 64)).first()[0] or 0
    if size <= SENT_BYTES:
        return F.broadcast(blocks).join(pieces, list(keys), "right").select(*names)
    placed = blocks.hint("merge").join(pieces.withColumn("_at", F.monotonically_increasing_id()), list(keys), "right")
    return placed.sortWithinPartitions(*keys, "_at").select(*names)


def joined(fragments: DataFrame, separator: str) -> DataFrame:
    """(source_name, value): records from their fragments; each begins with a first one, in an earlier block than its last."""
    order = Window.partitionBy(SOURCE).orderBy(START, "role").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = fragments.withColumn("_number", F.sum(F.when(F.col("role") == FIRST, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct(START, VALUE)))
    records = numbered.groupBy(column(SOURCE), "_number").agg(parts.alias("_parts"))
    return records.select(SOURCE, F.array_join(F.transform("_parts", lambda p: p[VALUE]), separator).alias(VALUE))
