"""Large JSON documents, cut into the elements of their list by many tasks.

A file is read in the pieces between its commas, block by block. A first pass finds what each block does to the state of
a lexer: whether quotes are left open, and how much deeper or higher the nesting is behind it, for either way it may
begin. A prefix over the blocks tells each how it begins, and then it knows which of its commas lie between
elements. The pieces are written once; those that cross blocks are joined from their parts. Then the list is looked for and its
elements are judged, as one syntax error makes a document bad, before they are given out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirgate.operators.records import SOURCE, column
from weirgate.sources.blocks import FIRST, LAST, MIDDLE, START, VALUE, attach, before, block_pieces, block_session, keep, runs_of

PIECE = f"{SOURCE} string, {START} bigint, at bigint, level int, role int, {VALUE} string"
_STRING = r'"(?:[^"\\]++|\\.)*+"'
#: What stands before the elements of a list under a key: maybe the document's brace, and the key.
_MEMBER = re.compile(rf"\s*(\{{)?\s*({_STRING})\s*:\s*(\[)?", re.DOTALL)


class Commas:
    """Bytes of pieces with their commas, and the state of the lexer at each comma, for a block that begins ``inside`` a string or not."""

    def __init__(self, pieces: pa.Array) -> None:
        texts = pieces.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.bytes = np.insert(data, offsets[1:] - offsets[0], ord(","))
        self.commas = offsets[1:] - offsets[0] + np.arange(len(texts))
        quotes = self.bytes == ord('"')
        slashes = self.bytes == ord("\\")
        if slashes.any():
            at = np.arange(len(self.bytes))
            last = np.maximum.accumulate(np.where(slashes, -1, at))
            run = at[1:] - 1 - last[:-1]
            quotes[1:] &= run % 2 == 0
        self.open = np.cumsum(quotes) % 2 == 1
        opening = (self.bytes == ord("{")) | (self.bytes == ord("["))
        closing = (self.bytes == ord("}")) | (self.bytes == ord("]"))
        self.steps = opening.astype(np.int64) - closing

    def depths(self, inside: bool) -> np.ndarray:
        """Levels gained up to each comma."""
        return np.cumsum(np.where(self.open == inside, self.steps, 0))[self.commas]

    def inside(self, inside: bool) -> np.ndarray:
        return self.open[self.commas] != inside


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does: quotes left open, levels gained if it begins outside of strings or inside; its bytes, the file's, its last letter."""
    row: list = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=[SOURCE, START, "turns", "outside", "inside", "bytes", "file_size", "tail"])

    for name, begins, rows in runs_of(batches):
        if begins:
            if row:
                yield out()
            row = [*name, False, 0, 0, 0, rows.column(3)[0].as_py(), ""]
        found = Commas(rows.column(2))
        turned, gained = bool(found.open[-1]), (int(found.depths(False)[-1]), int(found.depths(True)[-1]))
        # Behind an odd number of quotes the rest of the block is lexed the other way round.
        row[3] += gained[row[2]]
        row[4] += gained[not row[2]]
        row[2] ^= turned
        row[5] += len(found.bytes)
        row[7] = (row[7] + found.bytes[-64:].tobytes().decode("ascii", "replace").removesuffix(",")).rstrip(" \t\r\n")[-1:]
    if row:
        yield out()


def _cut(deepest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces between commas at most ``deepest`` levels down; those that cross blocks in parts, which have a role.

    ``level`` is that of the comma before a piece, 0 at the beginning of a file.
    """
    block, final = None, False
    pending, at, crossing, level, inside, depth = [], 0, False, 0, False, 0

    def out(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True))
        columns = [[block[0]] * len(pieces), [block[1]] * len(pieces), *columns]
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
        names = [SOURCE, START, "at", "level", "role", VALUE]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def text_of(parts: list[bytes]) -> str:
        return b"".join(parts).decode("utf-8", "replace")

    def rest() -> Iterator[pa.RecordBatch]:
        """What is open at the end of a block: the last piece of the file, or a part of one."""
        if pending:
            role = (LAST if crossing else None) if final else (MIDDLE if crossing else FIRST)
            pending[-1] = pending[-1].removesuffix(b",")
            yield out([(at, level, role, text_of(pending))])

    for name, begins, rows in runs_of(batches):
        if begins:
            yield from rest()
            inside, depth, final = (rows.column(i)[0].as_py() for i in (3, 4, 5))
            block, pending, at, level = name, [], 0, depth if name[1] else 0
            crossing = bool(name[1]) and (inside or depth > deepest)
        found = Commas(rows.column(2))
        within, levels = found.inside(inside), depth + found.depths(inside)
        text, begin, pieces = found.bytes.tobytes(), 0, []
        for i in np.flatnonzero(~within & (levels <= deepest)).tolist():
            end = int(found.commas[i])
            pieces.append((at, level, LAST if crossing else None, text_of([*pending, text[begin:end]])))
            pending, begin, at, crossing, level = [], end + 1, at + 1, False, int(levels[i])
        if begin < len(text):
            pending.append(text[begin:])
        inside, depth = bool(within[-1]), int(levels[-1])
        if pieces:
            yield out(pieces)
    yield from rest()


def _blocks(spark: SparkSession, lines: DataFrame, closing: str) -> DataFrame:
    """How each block begins, whether it is the last of its file, and whether quotes and nesting close there, with ``closing``."""
    shape = f"{SOURCE} string, {START} bigint, turns boolean, outside bigint, inside bigint, bytes bigint, file_size bigint, tail string"
    found = lines.mapInArrow(_facts, shape)
    found = found.withColumn("begins_inside", before(F.col("turns").cast("int")) % 2 == 1)
    found = found.withColumn("gained", F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside")))
    found = found.withColumn("depth", before(F.col("gained")))
    file = Window.partitionBy(SOURCE)
    found = found.withColumn("final", F.max(START).over(file) == F.col(START))
    closes = (F.col("begins_inside") == F.col("turns")) & (F.col("depth") + F.col("gained") == 0)
    # A comma is counted behind every piece; only a file that ends with one has as many. A byte order mark is not read.
    more = ~(F.sum("bytes").over(file) - F.col("file_size")).isin(0, -3)
    tail = F.max(F.when(F.col("tail") != "", F.struct(START, "tail"))).over(file)
    found = found.withColumn("closed", F.max(F.when(F.col("final"), closes)).over(file) & more & (tail["tail"] == closing))
    return keep(found.select(SOURCE, START, "begins_inside", "depth", "final", "closed"), spark)


def _pieces(lines: DataFrame, blocks: DataFrame, deepest: int) -> DataFrame:
    """(source_name, block_start, at, level, value): all pieces; (block_start, at) is their place in a file."""
    known = attach(lines.drop("file_size"), blocks.select(SOURCE, START, "begins_inside", "depth", "final"))
    cut = keep(known.mapInArrow(partial(_cut, deepest), PIECE))
    parts = cut.where("role IS NOT NULL")
    order = Window.partitionBy(SOURCE).orderBy(START, "role").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_number", F.sum(F.when(F.col("role") == FIRST, 1).otherwise(0)).over(order))
    parts = parts.groupBy(column(SOURCE), "_number").agg(F.array_sort(F.collect_list(F.struct(START, "at", "level", VALUE))).alias("_parts"))
    first = F.get("_parts", F.lit(0))
    text = F.array_join(F.transform("_parts", lambda p: p[VALUE]), ",").alias(VALUE)
    return cut.where("role IS NULL").drop("role").unionByName(parts.select(SOURCE, *(first[c].alias(c) for c in (START, "at", "level")), text))


def _members(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pieces that begin members of documents: whether they do so, whether their key is ``root``, and whether a list opens there."""
    for batch in batches:
        found = []
        for text, level in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True):
            member = _MEMBER.match(text)
            if member is None or bool(member[1]) != (level < 1) or not _parses(member[2]):
                found.append((False, False, False))
            else:
                found.append((True, json.loads(member[2], strict=False) == root, member[3] is not None))
        flags = [pa.array(f, pa.bool_()) for f in zip(*found, strict=True)] if found else [pa.array([], pa.bool_())] * 3
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *flags], names=[SOURCE, START, "at", "level", "fits", "root", "list"])


def _lists(pieces: DataFrame, root: str | None) -> DataFrame:
    """(source_name, first, beyond, fits): per file the places where its list begins and where what follows it does.

    Files without such a list are left out. ``fits`` says whether what lies around the list is one document.
    """
    place = F.struct(START, "at")
    alone = F.count_if(F.col("level") < 1) == 1
    if root is None:
        heads = pieces.where("level < 1").groupBy(column(SOURCE)).agg(F.min(F.struct(START, "at", VALUE)).alias("head"), alone.alias("fits"))
        heads = heads.where(F.rtrim(F.regexp_extract(F.col("head").getField(VALUE), r"^\s*(.)", 1)) == "[")
        first = F.struct(*(F.col("head").getField(c).alias(c) for c in (START, "at")))
        return keep(heads.select(SOURCE, first.alias("first"), F.lit(None).cast(f"struct<{START}: bigint, at: bigint>").alias("beyond"), "fits"))
    shape = f"{SOURCE} string, {START} bigint, at bigint, level int, fits boolean, root boolean, list boolean"
    members = pieces.where("level < 2").select(SOURCE, START, "at", "level", VALUE).mapInArrow(partial(_members, root), shape)
    members = keep(members.withColumn("place", place))
    last = F.max(F.when(F.col("root"), F.struct("place", "list"))).alias("last")  # of equal keys the last one counts
    fits = (alone & F.bool_and("fits")).alias("fits")
    found = keep(members.groupBy(column(SOURCE)).agg(last, fits).where("last.list"))
    found = found.select(SOURCE, F.col("last.place").alias("first"), "fits")
    later = attach(members.select(SOURCE, "place"), found.drop("fits"), [SOURCE]).where(F.col("place") > F.col("first"))
    beyond = later.groupBy(column(SOURCE)).agg(F.min("place").alias("beyond"))
    return keep(found.join(beyond, SOURCE, "left").select(SOURCE, "first", "beyond", "fits"))


def _stripped(root: str | None, text: str, first: bool, last: bool, final: bool) -> str | None:
    """A piece of a list without what opens and closes the list; None if that is not there."""
    if first:
        opening = re.match(r"\s*(\[)", text) if root is None else _MEMBER.match(text)
        if opening is None or opening[opening.re.groups] is None:
            return None
        text = text[opening.end() :]
    if last:
        closing = re.search(r"\]\s*\}\s*\Z" if root is not None and final else r"\]\s*\Z", text)
        return text[: closing.start()] if closing else None
    return text


def _parses(text: str | None) -> bool:
    try:
        json.loads(text, strict=False)
    except (ValueError, TypeError, RecursionError):
        return False
    return True


def _judged(root: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pieces of lists: whether they are an element, and whether the list closes behind them.

    Columns: source_name, block_start, at, level, value, whether the list begins there, whether nothing follows it.
    """
    for batch in batches:
        found = []
        for level, text, first, final in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6)), strict=True):
            if level < 1 and not first:
                found.append((False, False))
                continue
            good = _parses(_stripped(root, text, first, False, final))
            closed = None if good else _stripped(root, text, first, True, final)
            closes = closed is not None and (_parses(closed) or first and not closed.strip())
            found.append((good or closes, closes))
        flags = [pa.array(f, pa.bool_()) for f in zip(*found, strict=True)] if found else [pa.array([], pa.bool_())] * 2
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), *flags], names=[SOURCE, START, "at", "level", VALUE, "good", "closes"])


def _wrapped(root: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each element as a document with a list of one."""
    opened, closed = ("[", "]") if root is None else (f"{{{json.dumps(root)}:[", "]}")
    for batch in batches:
        texts = []
        for text, first, last, final in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
            text = _stripped(root, text, first, last, final)
            texts.append(f"{opened}{text}{closed}" if text.strip() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[SOURCE, VALUE])


def list_elements(spark: SparkSession, path: str | Sequence[str], root: str | None, above: int,
                  block_bytes: int | None = None) -> tuple[DataFrame, list[str]]:
    """(source_name, value) for the JSON files above a size, and the files among them that hold no list to cut.

    Each element of a document's list, or of that under ``root``, comes as a document with a list of one. A document
    with a syntax error in its list or its nesting comes as one text that does not parse either: the first
    piece that is wrong, with the comma beside it, or the last one of a list that does not end as it should. Other members
    of a document are only looked at for their keys and nesting.
    """
    lines = block_pieces(block_session(spark, block_bytes), path, ",", above)
    blocks = _blocks(spark, lines, "]" if root is None else "}")
    pieces = _pieces(lines, blocks, 1 if root is None else 2)
    lists = _lists(pieces, root)
    files = blocks.groupBy(column(SOURCE)).agg(F.first("closed").alias("closed"))
    others = [r[0] for r in files.join(lists, SOURCE, "left_anti").select(SOURCE).collect()]  # a row for each large file at most
    place = F.struct(START, "at")
    inside = attach(pieces, lists.drop("fits"), [SOURCE]).where((place >= F.col("first")) & (F.col("beyond").isNull() | (place < F.col("beyond"))))
    inside = inside.select(SOURCE, START, "at", "level", VALUE, (place == F.col("first")).alias("first"), F.col("beyond").isNull().alias("final"))
    shape = f"{SOURCE} string, {START} bigint, at bigint, level int, {VALUE} string, good boolean, closes boolean"
    text = F.concat(F.when(F.col("level") > 0, ",").otherwise(""), VALUE, F.when(F.col("level") > 0, "").otherwise(",")).alias("text")
    found = inside.mapInArrow(partial(_judged, root), shape).groupBy(column(SOURCE)).agg(
        F.max(F.struct(place.alias("place"), "closes", text)).alias("last"), F.count_if("closes").alias("ends"),
        F.min(F.when(~F.col("good"), F.struct(place.alias("place"), text))).alias("wrong"),
    )
    whole = F.col("closed") & F.col("fits") & F.col("last.closes") & (F.col("ends") == 1) & F.col("wrong").isNull()
    found = keep(found.join(files, SOURCE).join(lists.select(SOURCE, "fits"), SOURCE).select(
        SOURCE, F.coalesce(whole, F.lit(False)).alias("whole"), F.col("last.place").alias("end"), F.coalesce("wrong.text", "last.text").alias("text"),
    ))
    good = attach(inside, found.where("whole").select(SOURCE, "end"), [SOURCE]).where("end IS NOT NULL")
    good = good.select(SOURCE, VALUE, "first", (place == F.col("end")).alias("last"), "final")
    elements = good.mapInArrow(partial(_wrapped, root), f"{SOURCE} string, {VALUE} string").where(F.col(VALUE).isNotNull())
    return elements.unionByName(found.where("NOT whole").select(SOURCE, F.col("text").alias(VALUE))), others
