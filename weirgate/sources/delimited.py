"""Delimited files: per-file headers, leading rows to skip, ragged rows.

Lines are read split by split, so a file of any size is spread over many tasks;
only the first lines of each file are looked at separately, for its header.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import (
    ERROR,
    INVALID_RECORD,
    SOURCE,
    column,
    error_when,
    null_markers,
    single_pass,
    typed_nulls,
)
from weirgate.session import session_like
from weirgate.sources.blocks import (
    FIRST,
    FRAGMENT,
    LAST,
    MIDDLE,
    START,
    VALUE,
    attach,
    before,
    block_pieces,
    block_session,
    joined,
    keep,
    runs_of,
    with_state,
)

# Fields that stand for NULL unless the task says otherwise.
NULL_MARKERS = ("-1", "Null")

# Unicode noncharacters: they never occur in text meant for interchange.
_QUOTE, _DELIMITER, _ESCAPE, _END, _NONE = "﷐", "﷑", "﷒", "﷓", "﷔"

_ONE_FILE_PER_TASK = 1 << 40
#: Up to so many bytes a file is read whole for its first lines, so many records at a time.
_SMALL_FILE, _HEAD_RECORDS = 16 << 20, 1000
#: What Python's ``strip`` leaves something of.
_NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"


def _complete(lines: list[str], count: int) -> bool:
    """Whether there are so many lines, the last one not blank."""
    return len(lines) >= count and bool(lines[-1].strip())


def _first_lines(count: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines with their numbers in their file; blank ones that were left out before are NULL."""
    path, lines = None, []
    for batch in batches:
        for file, number, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if file != path and path is not None:
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([lines])], names=["path", "lines"])
                lines = []
            path = file
            if not _complete(lines, count):
                lines += [None] * (number - len(lines)) + [line]
        if _complete(lines, count):
            break
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([lines])], names=["path", "lines"])


def file_heads(spark: SparkSession, path: str | Sequence[str], count: int) -> DataFrame:
    """The first ``count`` lines of each file, and more while the last is blank, as (path, lines).

    One task per file, so the cost follows the number of files. Small ones are read to their end, of large ones no
    more than those lines, blank ones behind the first ``count`` as NULL: a limit ends a scan, while a Python function
    that is done does not.
    """
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(max(count, _HEAD_RECORDS))}
    heads = session_like(block_session(spark, _ONE_FILE_PER_TASK), settings)
    size, name = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("path")

    def first(lines: DataFrame) -> DataFrame:
        number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("number")
        return lines.where(F.col("_metadata.file_block_start") == 0).select(name, number, "value")

    large = heads.read.format("binaryFile").load(path).where(size > _SMALL_FILE).select(name).collect()
    found = [first(heads.read.text(path).where(size <= _SMALL_FILE))]
    wanted = (F.col("number") < count) | F.col("value").rlike(_NOT_BLANK)
    found += [first(heads.read.text(as_path(r.path))).where(wanted).limit(count + 1) for r in large]
    return reduce(DataFrame.unionAll, found).mapInArrow(partial(_first_lines, count), "path string, lines array<string>")


def _headers(spark: SparkSession, path: str | Sequence[str], skip_rows: int) -> list[Row]:
    """(path, header, leading, far) of each file.

    The header is the first line after the skipped ones that is not blank, ``leading`` how many lines end with
    it, and ``far`` whether those may reach beyond the first split.
    """
    size = F.aggregate("lines", F.lit(0), lambda n, line: n + F.octet_length(line) + 2)
    heads = file_heads(spark, path, skip_rows + 1)
    rest = F.filter(F.slice("lines", skip_rows + 1, F.greatest(F.size("lines"), F.lit(1))), lambda line: F.trim(line) != "")
    conf = spark._jsparkSession.sessionState().conf()
    smallest = min(conf.filesOpenCostInBytes(), conf.filesMaxPartitionBytes())
    heads = heads.select("path", F.get(rest, F.lit(0)).alias("header"), F.size("lines").alias("leading"), F.coalesce(size >= smallest, F.lit(True)).alias("far"))
    return heads.collect()


def as_path(uri: str) -> str:
    """What a reader takes for the file of a URI: decoded, and no part of it a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def _drop_leading(count: int, header: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out the first ``count`` lines of each file, and with ``header`` all up to one that is not blank.

    They are all in the split that starts at byte 0; the lines of a split reach
    one task in file order. Batches of other splits pass as they are.
    """
    path, start, seen, pending = None, None, 0, header
    for batch in batches:
        if batch.num_rows and pc.min(batch.column(1)).as_py() > 0:
            path = None
            yield batch
            continue
        keep = []
        for file, begin, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, begin) != (path, start):
                path, start, seen, pending = file, begin, 0, header
            seen += 1
            if begin != 0 or seen > count and not pending:
                keep.append(True)
            else:
                keep.append(False)
                if seen > count and line.strip():
                    pending = False
        yield batch.filter(pa.array(keep, pa.bool_()))


def lines_after(spark: SparkSession, path: str | Sequence[str], skip: int, header: bool = False,
                far: Sequence[Row] = ()) -> DataFrame:
    """(source_name, value) for the lines of all files but the first ``skip`` of each, and the header behind them."""
    source = F.col("_metadata.file_path").alias(SOURCE)
    if skip == 0 and not header:
        return spark.read.text(path).select(source, "value")
    if skip == 0 and not far:
        # The CSV reader leaves out one header line per file by itself, the first that
        # is not blank; with a separator that never occurs each line is a single field.
        reader = spark.read.schema("value string").options(
            header=True, sep=_END, quote="", escape="", nullValue=_NONE, emptyValue="", mode="PERMISSIVE"
        )
        return reader.csv(path).select(source, "value")
    return _after_leading(block_pieces(spark, path), skip, header, far).select(SOURCE, VALUE)


def _drop_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out as many of the first lines of each block as its rows say."""
    left = 0
    for _, begins, rows in runs_of(batches):
        if begins:
            left = rows.column(3)[0].as_py() or 0
        cut = min(left, rows.num_rows)
        left -= cut
        yield rows.slice(cut).select([0, 1, 2])


def _after_leading(lines: DataFrame, skip: int, header: bool, far: Sequence[Row], spark: SparkSession | None = None) -> DataFrame:
    """Lines ``(source_name, block_start, value)`` without the leading ones of their files.

    Usually those lie in the first block of a file. Where they may not, lines are counted block by block, and
    each block leaves out what is left of them when it begins.
    """
    shape = f"{SOURCE} string, {START} bigint, {VALUE} string"
    if not far:
        return lines.mapInArrow(partial(_drop_leading, skip, header), shape) if skip or header else lines
    counts = lines.groupBy(SOURCE, START).agg(F.count("*").alias("lines"))
    # A row for each file whose first lines are that long.
    spans = lines.sparkSession.createDataFrame([(r.path, r.leading if header else skip) for r in far], f"{SOURCE} string, leading long")
    passed = counts.withColumn("passed", before(F.col("lines"))).join(spans, SOURCE, "left")
    others = F.lit(skip) if not header else F.lit(None)
    left = F.greatest(F.coalesce("leading", others) - F.col("passed"), F.lit(0)).cast("long")
    return attach(lines, keep(passed.select(SOURCE, START, left.alias("left")), spark)).mapInArrow(_drop_counted, shape)


class Quotes:
    """Whether a line break behind a line is inside a quoted field.

    A field is quoted if it begins with a quote; doubled quotes are part of it. What stands behind its last quote
    belongs to the field and opens no other.
    """

    def __init__(self, delimiter: str) -> None:
        d = re.escape(delimiter)
        quoted, plain = rf'"(?:[^"]++|"")*+"[^{d}]*+', rf'(?!")[^{d}]*+'
        self.opening = re.compile(rf'(?>(?:{quoted}|{plain}){d})*+"(?:[^"]++|"")*+\Z')
        self.closing = re.compile(rf'(?:[^"]++|"")*+"[^{d}]*+({d}|\Z)')

    def after(self, inside: bool, line: str) -> bool:
        if '"' not in line:
            return inside
        if not inside:
            return self.opening.match(line) is not None
        end = self.closing.match(line)
        if end is None:
            return True
        return bool(end[1]) and self.opening.match(line, end.end()) is not None


def _quote_states(delimiter: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each block ends, from either state it may begin in."""
    quotes, block, states = Quotes(delimiter), None, (False, True)

    def row() -> pa.RecordBatch:
        values = [[block[0]], [block[1]], [states[0]], [states[1]]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=[SOURCE, START, "outside", "inside"])

    for name, begins, rows in runs_of(batches):
        if begins and block is not None:
            yield row()
        if begins:
            block, states = name, (False, True)
        lines = rows.column(2)
        for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
            states = tuple(quotes.after(s, line) for s in states)
    if block is not None:
        yield row()


def _records(delimiter: str, fragments: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that know how their block begins: those that lie in one block, or the parts of the others."""
    quotes, names = Quotes(delimiter), [SOURCE, START, "role", VALUE]
    block, inside, crossing = None, False, False
    lines: list[str] = []

    def out(texts: list[str], role: int | None) -> pa.RecordBatch:
        values = [[block[0]] * len(texts), [block[1]] * len(texts), [role] * len(texts), texts]
        types = (pa.string(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

    def rest() -> list[pa.RecordBatch]:
        return [out(["\n".join(lines)], MIDDLE if crossing else FIRST)] if lines and fragments else []

    for name, begins, rows in runs_of(batches):
        if begins:
            yield from rest()
            block, inside, lines = name, bool(rows.column(3)[0].as_py()), []
            crossing = inside
        complete = []
        for line in rows.column(2).to_pylist():
            inside = quotes.after(inside, line)
            if inside:
                lines.append(line)
                continue
            line = line.removesuffix("\r")
            text = "\n".join([*lines, line]) if lines else line
            lines = []
            if crossing:
                crossing = False
                if fragments:
                    yield out([text], LAST)
            else:
                complete.append(text)
        if complete and not fragments:
            yield out(complete, None)
    yield from rest()


def quoted_records(read: Callable[[str | Sequence[str]], DataFrame], path: str | Sequence[str], delimiter: str = ",",
                   spark: SparkSession | None = None) -> DataFrame:
    """(source_name, value): records of the lines ``(source_name, block_start, value)`` of files, with the line breaks inside quotes.

    Tasks first find how quotes leave each block, then cut their blocks into records knowing how they begin. Only
    files in which a record crosses blocks are gone through once more, for its parts. A quote that never closes
    makes one record of the rest of the file, which is to fit one value.
    """
    lines = read(path)
    ends = lines.mapInArrow(partial(_quote_states, delimiter), f"{SOURCE} string, {START} bigint, outside boolean, inside boolean")
    end = F.when(F.col("begins"), F.col("inside")).otherwise(F.col("outside"))
    blocks = keep(with_state(ends, "begins").select(SOURCE, START, "begins", end.alias("ends")), spark)
    begins = blocks.select(SOURCE, START, "begins")
    records = attach(lines, begins).mapInArrow(partial(_records, delimiter, False), FRAGMENT).select(SOURCE, VALUE)
    crossed = [as_path(r[0]) for r in blocks.where("begins OR ends").select(SOURCE).distinct().collect()]  # at most a row per file
    if not crossed:
        return records
    parts = attach(read(crossed), begins).mapInArrow(partial(_records, delimiter, True), FRAGMENT)
    return records.unionByName(joined(parts, "\n"))


def _plain_line(line: Column, delimiter: str, escape: str | None) -> Column:
    """Replace escaped characters by stand-ins the field parser leaves alone."""
    if not escape:
        return line
    e = "\\" + escape if not escape.isalnum() else escape
    d = "\\" + delimiter if not delimiter.isalnum() else delimiter
    found = F.regexp_replace(line, e + e, _ESCAPE)
    found = F.regexp_replace(found, e + '"', _QUOTE)
    found = F.regexp_replace(found, e + d, _DELIMITER)
    found = F.regexp_replace(found, e + "(.)", "$1")
    return F.when(F.contains(line, F.lit(escape)), found).otherwise(line)


def split_fields(
    lines: DataFrame, value: str, width: int, delimiter: str = ",", escape: str | None = "\\"
) -> tuple[DataFrame, list[Column]]:
    """Add ``_count``, the number of fields of each line, and give the fields as columns.

    The count is NULL where quotes do not close or there are more than ``width``
    fields. A mark after the last field shows where the line ends, which tells an
    empty field (``''``) from one that is missing (NULL).
    """
    marked = F.concat(_plain_line(column(value), delimiter, escape), F.lit(delimiter + _END))
    parsed = F.from_csv(
        marked,
        ", ".join(f"c{i} string" for i in range(width + 1)),
        {"sep": delimiter, "quote": '"', "escape": '"', "nullValue": _NONE, "emptyValue": "",
         "mode": "PERMISSIVE", "maxColumns": str(max(20480, width + 2)), "maxCharsPerColumn": "-1"},
    )
    rows = single_pass(lines, parsed, "_parsed")
    places = F.array(*[F.col(f"_parsed.c{i}") for i in range(1, width + 1)])
    rows = rows.withColumn("_count", F.nullif(F.array_position(places, _END), F.lit(0)).cast("int"))

    def field(i: int) -> Column:
        text = F.coalesce(F.col(f"_parsed.c{i}"), F.lit(""))
        if escape:
            back = F.translate(text, _QUOTE + _DELIMITER + _ESCAPE, '"' + delimiter + escape)
            text = F.when(F.contains(column(value), F.lit(escape)), back).otherwise(text)
        return F.when(F.col("_count") > i, text)

    return rows, [field(i) for i in range(width)]


def widest_line(lines: DataFrame, value: str, delimiter: str = ",", escape: str | None = "\\") -> int:
    """Upper bound of the number of fields per line, over all lines."""
    bare = F.regexp_replace(_plain_line(column(value), delimiter, escape), '"(?:[^"]|"")*"', "")
    found = lines.agg(F.max(F.size(F.split(bare, "\\" + delimiter if not delimiter.isalnum() else delimiter)))).first()
    return found[0] or 0


def _named_rows(lines: DataFrame, names: Sequence[str], extra: int | None, delimiter: str, escape: str | None,
                markers: Sequence[str]) -> DataFrame:
    width = len(names) + extra if extra is not None else max(widest_line(lines, "value", delimiter, escape), len(names))
    columns = list(names) + [f"column_{i + 1}" for i in range(len(names), width)]
    rows, fields = split_fields(lines.where(F.length("value") > 0), "value", width, delimiter, escape)
    decoded = F.is_valid_utf8(column("value"))
    desc = F.when(~decoded, F.lit("not UTF-8 text")).otherwise(
        F.lit(f"quotes do not close or more than {width} fields")
    )
    error = error_when(~decoded | F.col("_count").isNull(), INVALID_RECORD, desc, column("value"))
    # Of two fields with the same header the later one counts.
    positions = {c: i for i, c in enumerate(columns)}
    cells = [fields[i].alias(c) for c, i in positions.items()]
    return null_markers(rows.select(*cells, column(SOURCE), error.alias(ERROR)), markers, positions)


def delimited_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    delimiter: str = ",",
    escape: str | None = "\\",
    markers: Sequence[str] = NULL_MARKERS,
    header: bool = True,
    schema: T.StructType | None = None,
    skip_rows: int = 0,
    extra_columns: int | None = None,
    multi_line: bool = False,
    block_bytes: int | None = None,
) -> DataFrame:
    """Rows of delimited files as strings, named by each file's own header.

    Without a header, ``schema`` names the fields by position. Fields beyond the
    names become ``column_<n>``; how many there are at most is found in a pass
    over the lines unless ``extra_columns`` says it. Missing fields are NULL,
    empty ones ``''``. Files are grouped by header, not joined with it, so each
    group is an ordinary splittable scan. Values with line breaks need
    ``multi_line``, which knows doubled quotes but no escape character and takes no
    extra columns unless told; without it, lines whose quotes do not close are bad records.
    Such files are read in blocks of ``block_bytes``, or as the session splits files.
    """
    blocks = block_session(spark, block_bytes if multi_line else None)
    if multi_line:
        escape, extra_columns = None, extra_columns or 0

    def read(files: str | Sequence[str], skip: int, header: bool, far: Sequence[Row]) -> DataFrame:
        if not multi_line:
            return lines_after(spark, files, skip, header, far)
        return quoted_records(lambda some: _after_leading(block_pieces(blocks, some, "\n"), skip, header, far, spark), files, delimiter, spark)

    if not header:
        if schema is None:
            raise ValueError("files without a header need a schema")
        far = [r for r in _headers(blocks, path, skip_rows) if r.far] if skip_rows else []
        return _named_rows(read(path, skip_rows, False, far), schema.names, extra_columns, delimiter, escape, markers)
    groups: dict[tuple[str, ...], list[Row]] = defaultdict(list)
    for row in _headers(blocks, path, skip_rows):
        if row.header is not None:
            reader = csv.reader([row.header], delimiter=delimiter, escapechar=escape)
            groups[tuple(next(reader))].append(row)
    if not groups:
        raise ValueError(f"no file with a header at {path}")
    parts = []
    for names, rows in groups.items():
        files = path if len(groups) == 1 else [as_path(r.path) for r in rows]
        lines = read(files, skip_rows, True, rows if any(r.far for r in rows) else [])
        parts.append(_named_rows(lines, names, extra_columns, delimiter, escape, markers))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    data = [c for c in rows.columns if c not in (SOURCE, ERROR)]
    return rows.select(*[column(c) for c in data], column(SOURCE), column(ERROR))


def unload_scan(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, source_name: str,
                delimiter: str = ",") -> DataFrame:
    """Header-less files of a warehouse unload, named by the declared schema.

    Values stay text; ``n`` is NULL in columns that are not strings.
    """
    rows = delimited_scan(spark, path, header=False, schema=schema, delimiter=delimiter, escape=None, markers=(),
                          extra_columns=0)
    return typed_nulls(rows, schema).withColumn(SOURCE, F.lit(source_name))
