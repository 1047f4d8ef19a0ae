"""JSON, NDJSON, XML, Avro and Parquet files, and plain lines."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators import documents as D
from weirgate.operators.layout import Layout, infer, infer_texts
from weirgate.operators.mapping import map_documents, parse_column_map
from weirgate.operators.records import (
    ERROR,
    INVALID_RECORD,
    INVALID_XML,
    MESSAGE_ID,
    SOURCE,
    as_tagged,
    column,
    error_when,
    message_ids,
    read_together,
    rewrite_source,
    single_pass,
    spread,
)
from weirgate.sources.elements import list_elements

_DOCUMENT = "_document"
_DECODER, _SPACE = json.JSONDecoder(), re.compile(r"[ \t\r\n]*")
_ELEMENTS = 1000


def line_scan(spark: SparkSession, path: str | Sequence[str], whole: bool = False, upto: int | None = None) -> DataFrame:
    """(source_name, value) per line, or per file with ``whole``; with ``upto``, of files up to that size only."""
    found = spark.read.text(path, wholetext=whole)
    if upto is not None:
        found = found.where(F.col("_metadata.file_size") <= upto)
    return found.select(F.col("_metadata.file_path").alias(SOURCE), "value")


def _rows(tagged: DataFrame, layout: Layout | T.StructType | None, kind: str = INVALID_RECORD) -> DataFrame:
    if layout is None:
        layout = infer(tagged.where(column(ERROR).isNull()), _DOCUMENT)
    elif isinstance(layout, T.StructType):
        layout = Layout.of(layout)
    raw = F.coalesce(F.to_json(column(_DOCUMENT)), column("value"))
    fitting = D.judged(tagged, _DOCUMENT, layout, raw, kind)
    return D.nested_rows(fitting.drop("value"), _DOCUMENT, layout)


def json_scan(spark: SparkSession, path: str | Sequence[str], root: str | None = None,
              layout: Layout | T.StructType | None = None, block_bytes: int | None = None) -> DataFrame:
    """One JSON document per file; a list gives one row per element.

    A document that fits one split of a file is gone through by one task; larger ones are cut into the elements
    of their list by many. Elements are parsed one by one, so only an element, not the list, must fit a VARIANT.
    A large document that holds no list to cut has to be one value. Splits are those of the session, or of ``block_bytes``.
    """
    limit = block_bytes or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    shape = f"{SOURCE} string, value string"
    documents = line_scan(spark, path, whole=True, upto=limit).mapInArrow(partial(_list_elements, root), shape)
    if not spark.read.format("binaryFile").load(path).select("length").where(F.col("length") > limit).isEmpty():
        elements, others = list_elements(spark, path, root, limit, block_bytes)
        documents = documents.unionByName(elements)
        if others:
            rest = spark.read.text(path, wholetext=True).where(F.col("_metadata.file_path").isin(others))
            rest = rest.select(F.col("_metadata.file_path").alias(SOURCE), "value")
            documents = documents.unionByName(rest.mapInArrow(partial(_list_elements, root), shape))
    return document_rows(documents, root, layout)


def _elements(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Where the elements of the list that opens at ``at`` begin and end, and where the list ends."""
    found, at = [], _SPACE.match(text, at + 1).end()
    if text[at] == "]":
        return found, at + 1
    while True:
        _, end = _DECODER.raw_decode(text, at)
        found.append((at, end))
        at = _SPACE.match(text, end).end()
        if text[at] == "]":
            return found, at + 1
        if text[at] != ",":
            raise ValueError("neither comma nor end of list")
        at = _SPACE.match(text, at + 1).end()


def _root_elements(text: str, root: str | None) -> list[tuple[int, int]] | None:
    """Elements of the list a document is, or has under ``root``; None if there is none or the text is no JSON."""
    try:
        at, found = _SPACE.match(text, 0).end(), None
        if root is None:
            if text[at] != "[":
                return None
            found, at = _elements(text, at)
        else:
            if text[at] != "{":
                return None
            at = _SPACE.match(text, at + 1).end()
            while text[at] != "}":
                key, at = _DECODER.raw_decode(text, at)
                at = _SPACE.match(text, at).end()
                if not isinstance(key, str) or text[at] != ":":
                    return None
                at = _SPACE.match(text, at + 1).end()
                if key == root:  # of two equal keys the last one counts
                    found, at = _elements(text, at) if text[at] == "[" else (None, _DECODER.raw_decode(text, at)[1])
                else:
                    _, at = _DECODER.raw_decode(text, at)
                at = _SPACE.match(text, at).end()
                if text[at] == ",":
                    at = _SPACE.match(text, at + 1).end()
                    if text[at] == "}":
                        return None
                elif text[at] != "}":
                    return None
            at += 1
        return found if _SPACE.match(text, at).end() == len(text) else None
    except (ValueError, IndexError, RecursionError):
        return None


def _list_elements(root: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each element of a document's list as a document with a list of one; other documents as they are."""
    before, after = ("[", "]") if root is None else (f"{{{json.dumps(root)}:[", "]}")
    for batch in batches:
        for source, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            found = None if text is None else _root_elements(text, root)
            for at in range(0, 1 if found is None else len(found), _ELEMENTS):
                texts = [text] if found is None else [f"{before}{text[a:b]}{after}" for a, b in found[at : at + _ELEMENTS]]
                sources = pa.array([source.as_py()] * len(texts), pa.string())
                yield pa.RecordBatch.from_arrays([sources, pa.array(texts, pa.string())], names=[SOURCE, "value"])


def ndjson_scan(spark: SparkSession, path: str | Sequence[str], root: str | None = None,
                layout: Layout | T.StructType | None = None) -> DataFrame:
    """One JSON document per line."""
    return document_rows(spread(line_scan(spark, path)), root, layout)


def document_rows(lines: DataFrame, root: str | None = None,
                  layout: Layout | T.StructType | None = None, kind: str = INVALID_RECORD) -> DataFrame:
    """JSON texts (column ``value``) to rows with one column per key.

    Without a layout the keys are found in a pass over all documents.
    """
    documents = D.read_documents(lines, "value", kind, _DOCUMENT)
    return _rows(D.explode_root(documents, _DOCUMENT, root, column("value"), kind), layout, kind)


def flatten_lines(lines: DataFrame, column_map: Mapping | str, layout: Layout | T.StructType | None = None,
                  topic: str | None = None, kind: str = INVALID_RECORD) -> DataFrame:
    """JSON lines (``value``, ``source_name``, message id) flattened through a column map."""
    documents = D.read_documents(lines, "value", kind, _DOCUMENT)
    if layout is None:
        layout = infer_texts(lines, "value")
    elif isinstance(layout, T.StructType):
        layout = Layout.of(layout)
    fitting = D.judged(documents, _DOCUMENT, layout, column("value"), kind, flat=True)
    return map_documents(fitting, _DOCUMENT, parse_column_map(column_map), layout, column("value"), topic)


def flatten_json_scan(spark: SparkSession, path: str | Sequence[str], column_map: Mapping | str,
                      layout: Layout | T.StructType | None = None, staging: tuple[str, str] | None = None,
                      topic: str | None = None) -> DataFrame:
    """Files of JSON lines, flattened and renamed; every line gets a message id.

    ``staging`` = (prefix read, prefix to report) rewrites the source names.
    """
    lines = line_scan(spark, path)
    if staging is not None:
        lines = lines.withColumn(SOURCE, rewrite_source(column(SOURCE), *staging))
    # Ids come from the positions in the files, before anything moves the lines.
    return flatten_lines(spread(message_ids(lines)), column_map, layout, topic)


def parquet_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet rows, nested values as they are."""
    paths = [path] if isinstance(path, str) else list(path)
    return as_tagged(spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias(SOURCE)))


def avro_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Avro rows; the session needs the spark-avro package."""
    return as_tagged(spark.read.format("avro").load(path).select("*", F.col("_metadata.file_path").alias(SOURCE)))


def xml_options() -> dict[str, str]:
    """How XML becomes records: attributes as ``@name``, all values text."""
    return {"attributePrefix": "@", "valueTag": "#text", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "true",
            "columnNameOfCorruptRecord": "_corrupt"}


def xml_rows(texts: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """XML documents of a text column as one nested record each; other text is tagged."""
    shape = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = single_pass(texts, F.from_xml(column(text), shape, xml_options()), "_record")
    bad = F.col("_record").isNull() | F.col("_record._corrupt").isNotNull()
    error = error_when(bad, INVALID_XML, "not an XML document", column(text))
    others = [column(c) for c in texts.columns if c != text]
    values = [F.col("_record").getField(f.name).alias(f.name) for f in schema.fields]
    return rows.select(*values, *others, error.alias(ERROR))


def xml_scan(spark: SparkSession, path: str | Sequence[str], row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    """Elements ``row_tag`` of XML files; elements that do not parse are tagged.

    A file has one root element and is read by one task. Files with one element
    per line are better read with ``line_scan`` and ``xml_rows``, which splits them.
    """
    reader = spark.read.format("xml").options(rowTag=row_tag, **xml_options(), inferSchema="false")
    if schema is None:
        schema = T.StructType([f for f in reader.load(path).schema.fields if f.name != "_corrupt"])
    shape = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = read_together(reader.schema(shape).load(path).withColumn(SOURCE, F.col("_metadata.file_path")))
    error = error_when(F.col("_corrupt").isNotNull(), INVALID_XML, "not an XML element", F.col("_corrupt"))
    return rows.select(*[column(f.name) for f in schema.fields], column(SOURCE), error.alias(ERROR))


__all__ = [
    "MESSAGE_ID", "avro_scan", "document_rows", "flatten_json_scan", "flatten_lines", "json_scan", "line_scan",
    "ndjson_scan", "parquet_scan", "xml_rows", "xml_scan",
]
