"""Packing documents into sequences of at most so many tokens, by best fit in bulk.

Documents longer than a sequence are cut into pieces of that length; such a piece fills a sequence. All
other pieces are range-sorted: each gets its rank among the pieces of its length. Gaps in open sequences are
kept sorted likewise, as runs of sequences with equal room.

Matching goes in supersteps, from the longest pieces to the shortest. In each, all pieces of a length look
for their successor among the gaps, the smallest that holds them: the first of them, by rank, take the gaps
of the smallest run, the next those of the run behind it, until the pieces or the gaps are used up; pieces
left over open sequences. The gaps taken are updated and are runs of a smaller room in the next superstep. That is
exactly what best fit decreasing does piece by piece, for a whole run at a time.

What a superstep needs to know of the pieces is how many there are of each length, at most as many numbers as a
sequence has tokens; what it decides is which ranks go to which run. So matching reads and writes tables of
that size, whatever the number of documents, and the pieces find their sequence by a join on length
and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import Stages, free_name, returning
from weirgate.llm.tokens import VOCABULARY, ids_of

SEQUENCE = 2048
END = 0
#: Pieces numbered together at least; more for a length that very many pieces have.
SLICE = 100


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
    vocabulary: str = VOCABULARY, with_ids: bool = False,
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)`` for each piece of each document, and its ``ids`` if wanted.

    A document's ids are followed by one ``END``; a null or empty text has only that. Repeated rows have pieces
    of their own, null keys are kept.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"`{key}` {rows.schema[0].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = ids_of(vocabulary), END.to_bytes(4, "little")
        size = 4 * sequence
        for batch in returning(ids.task(batches)):
            take, number, start, length, check, parts = [], [], [], [], [], []
            for row, found in enumerate(ids.batches(batch.column(1))):
                data = found.tobytes() + end
                for at in range(0, len(data), size):
                    part = data[at : at + size]
                    take.append(row)
                    number.append(at // size)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    check.append(zlib.crc32(part))
                    if with_ids:
                        parts.append(part)
            columns = [
                batch.column(0).take(pa.array(take, pa.int64())), pa.array(number, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(check, pa.int64()),
            ]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                values = [memoryview(p).cast("i").tolist() for p in parts]
                columns, names = [*columns, pa.array(values, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def best_fit(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces, first sequence, offset)`` for so many pieces of each length.

    Piece ``first rank + i`` of a length goes to sequence ``first sequence + i``, at the offset. A run of gaps
    is ``(room, first sequence, sequences)``. A gap that still holds a piece of the same length is the
    successor of the next one too, so it takes as many as fit before the gap behind it.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # sorted, so that the successor of a length is found by bisection
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left, changed = 0, counts[length], []
        while left:
            at = bisect_left(gaps, (length, -1, -1))
            if at < len(gaps):
                room, first, n = gaps.pop(at)
            else:
                room, first, n = sequence, opened, -(-left // (sequence // length))
                opened += n
            each = room // length
            filled = min(n, left // each)
            steps = [(filled, each)] if filled else []
            if filled < n and left > filled * each:
                steps.append((1, left - filled * each))
            for sequences, copies in steps:
                for copy in range(copies):
                    runs.append((length, rank, sequences, first, sequence - room + copy * length))
                    rank, left = rank + sequences, left - sequences
                changed.append((room - copies * length, first, sequences))
                first, n = first + sequences, n - sequences
            if n:
                insort(gaps, (room, first, n))
        for gap in changed:
            if gap[0]:
                insort(gaps, gap)
    return runs


def pack(found: DataFrame, key: str = "doc_id", sequence: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces, which have a ``length`` of 1 to ``sequence``.

    Sequences have no gaps inside and nothing beyond their size. No pieces give no rows.
    """
    stages = Stages(found.sparkSession, "packing")
    spark = found.sparkSession
    at, part = free_name(found, "at"), free_name(found, "part")
    rows = stages.put(found.withColumn(at, F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        stages.drop(rows)
        return rows.drop(at).select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # both tables have a number of rows that the size of a sequence bounds
    parts = spark.createDataFrame(
        [(length, -(-n // max(SLICE, isqrt(n)))) for length, n in counts.items()], "length bigint, parts bigint"
    )
    runs = spark.createDataFrame(
        [(a, b, b + n, c - b, d) for a, b, n, c, d in best_fit(counts, sequence)],
        "length bigint, low bigint, high bigint, shift bigint, offset bigint",
    )
    rows = rows.join(F.broadcast(parts), "length").withColumn(part, F.expr(f"pmod(xxhash64(`{at}`), parts)")).drop("parts")
    before = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", part).agg(F.count("*").alias("n"))
    sizes = sizes.select("length", part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", part).orderBy(key, "piece", at)
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1)
    ranked = ranked.join(stages.put(sizes), ["length", part]).withColumn("rank", F.col("rank") + F.col("before"))
    fits = [ranked["length"] == runs["length"], ranked["rank"] >= runs["low"], ranked["rank"] < runs["high"]]
    placed = ranked.join(F.broadcast(runs), fits)
    result = stages.put(
        placed.select(
            *[ranked[f"`{c}`"] for c in found.columns], (ranked["rank"] + runs["shift"]).alias("sequence_id"), runs["offset"]
        )
    )
    stages.drop(result)
    return result
