"""What a collection of JSON documents looks like: its keys, lists and scalars.

A ``Layout`` node may be scalar, object and list at once, because documents of
one collection need not agree (``items`` may be an object in one document and
a list of objects in the next).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIGINT, DECIMAL, DOUBLE, BOOLEAN, STRING = "bigint", "decimal(38,0)", "double", "boolean", "string"
NUMERIC = (BIGINT, DECIMAL, DOUBLE)


@dataclass
class Layout:
    scalars: set[str] = field(default_factory=set)
    fields: dict[str, Layout] | None = None
    items: Layout | None = None
    complete: bool = False  # nothing but what is noted here occurs in the documents

    def completed(self) -> Layout:
        """The same layout, vouched for by a pass over all documents."""
        fields = None if self.fields is None else {k: v.completed() for k, v in self.fields.items()}
        return Layout(self.scalars, fields, None if self.items is None else self.items.completed(), True)

    @staticmethod
    def of(kind: T.DataType) -> Layout:
        """Layout of a declared Spark type."""
        if isinstance(kind, T.StructType):
            return Layout(fields={f.name: Layout.of(f.dataType) for f in kind.fields})
        if isinstance(kind, T.ArrayType):
            return Layout(items=Layout.of(kind.elementType))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return Layout({DOUBLE})
        if isinstance(kind, T.DecimalType):
            return Layout({DOUBLE if kind.scale else DECIMAL})
        if isinstance(kind, T.IntegralType):
            return Layout({BIGINT})
        if isinstance(kind, T.BooleanType):
            return Layout({BOOLEAN})
        if isinstance(kind, T.NullType):
            return Layout()
        return Layout({STRING})

    def element(self) -> Layout:
        """What is left after the lists at this place are exploded once."""
        left = Layout().merge(Layout(self.scalars, self.fields)).merge(self.items)
        return left.completed() if self.complete else left

    def scalar_type(self) -> str:
        """One column type for all scalars seen here."""
        if len(self.scalars) == 1:
            return next(iter(self.scalars))
        if self.scalars and self.scalars <= set(NUMERIC):
            return DOUBLE if DOUBLE in self.scalars else DECIMAL
        return STRING

    def spark_type(self) -> T.DataType:
        """A nested Spark type; where documents disagree, the JSON text is kept."""
        ways = bool(self.scalars) + (self.fields is not None) + (self.items is not None)
        if ways > 1:
            return T.StringType()
        if self.fields:
            return T.StructType([T.StructField(k, v.spark_type()) for k, v in self.fields.items()])
        if self.items is not None:
            return T.ArrayType(self.items.spark_type())
        return T._parse_datatype_string(self.scalar_type())

    def observe(self, value) -> None:
        """Widen the layout so that it covers one more parsed value."""
        if isinstance(value, dict):
            self.fields = {} if self.fields is None else self.fields
            for k, v in value.items():
                self.fields.setdefault(k, Layout()).observe(v)
        elif isinstance(value, list):
            self.items = Layout() if self.items is None else self.items
            for v in value:
                self.items.observe(v)
        elif isinstance(value, bool):
            self.scalars.add(BOOLEAN)
        elif isinstance(value, int):
            self.scalars.add(BIGINT if -(2**63) <= value < 2**63 else DECIMAL)
        elif isinstance(value, float):
            self.scalars.add(DOUBLE)
        elif isinstance(value, str):
            self.scalars.add(STRING)

    def merge(self, other: Layout) -> Layout:
        self.scalars |= other.scalars
        if other.fields is not None:
            self.fields = {} if self.fields is None else self.fields
            for k, v in other.fields.items():
                self.fields.setdefault(k, Layout()).merge(v)
        if other.items is not None:
            self.items = (self.items or Layout()).merge(other.items)
        return self

    def dump(self) -> dict:
        return {
            "s": sorted(self.scalars),
            "f": None if self.fields is None else {k: v.dump() for k, v in self.fields.items()},
            "i": None if self.items is None else self.items.dump(),
        }

    @staticmethod
    def load(data: dict) -> Layout:
        return Layout(
            set(data["s"]),
            None if data["f"] is None else {k: Layout.load(v) for k, v in data["f"].items()},
            None if data["i"] is None else Layout.load(data["i"]),
        )


def _type_of_shape(shape: str) -> T.DataType:
    """Spark type for the text ``schema_of_variant_agg`` returns."""
    parts = re.split(r"(`(?:[^`]|``)*`)", shape)
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return T._parse_datatype_string("".join(parts))


def _has_conflict(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_conflict(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_conflict(kind.elementType)
    return isinstance(kind, T.VariantType)


def _batch(layout: Layout) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([json.dumps(layout.dump())])], names=["layout"])


def _observe_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = Layout()
    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                seen.observe(json.loads(text.as_py()))
    yield _batch(seen)


def _merge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = Layout()
    for batch in batches:
        for text in batch.column(0):
            seen.merge(Layout.load(json.loads(text.as_py())))
    yield _batch(seen)


def infer_texts(texts: DataFrame, text: str) -> Layout:
    """Layout of the objects among JSON texts.

    Texts that are rejected later for what follows the object are looked at too;
    at most this adds keys for which no document has a value.
    """
    objects = texts.where(F.ltrim(F.col(text), F.lit(" \t\r\n")).startswith("{"))
    return infer(objects.select(F.try_parse_json(F.col(text)).alias("_document")), "_document")


def infer(df: DataFrame, document: str) -> Layout:
    """Layout of all documents in a VARIANT column, over the whole data.

    The JVM aggregate settles collections whose documents agree. Where they do
    not, it only says VARIANT, so a second pass folds the documents of each
    partition into one small layout and merges those in two steps; the driver
    receives at most a few dozen of them.
    """
    row = df.agg(F.schema_of_variant_agg(F.col(document)).alias("shape")).first()
    if row.shape is None or row.shape == "VOID":
        return Layout(fields={}, complete=True)
    kind = _type_of_shape(row.shape)
    if not _has_conflict(kind):
        return Layout.of(kind).completed()
    texts = df.select(F.to_json(F.col(document)).alias("document"))
    folded = texts.mapInArrow(_observe_partition, "layout string")
    merged = folded.repartition(32).mapInArrow(_merge_partition, "layout string")
    layout = Layout()
    for part in merged.collect():
        layout.merge(Layout.load(json.loads(part.layout)))
    return layout.completed()
