"""Declared schemas: ``{"fields": [{"name", "type", "mode", "fields"}]}``."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import ERROR, ERROR_TYPE, INVALID_RECORD, column, error_when, quoted, single_pass

# Declared type names (any case) and what they are in Spark.
TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "DATETIME": T.TimestampNTZType(),
}
DECIMALS = {"NUMERIC": (38, 9), "BIGNUMERIC": (38, 18)}


def _field(spec: Mapping) -> T.StructField:
    kind = str(spec["type"]).upper()
    if kind in ("RECORD", "STRUCT"):
        data: T.DataType = T.StructType([_field(f) for f in spec.get("fields", [])])
    elif kind in DECIMALS:
        precision, scale = DECIMALS[kind]
        if "precision" in spec:
            precision, scale = int(spec["precision"]), int(spec.get("scale", 0))
        data = T.DecimalType(precision, scale)
    elif kind in TYPES:
        data = TYPES[kind]
    else:
        raise ValueError(f"unknown declared type {spec['type']!r} of {spec.get('name')!r}")
    mode = str(spec.get("mode", "NULLABLE")).upper()
    if mode == "REPEATED":
        return T.StructField(spec["name"], T.ArrayType(data), True)
    return T.StructField(spec["name"], data, mode != "REQUIRED")


def declared_schema(source: Mapping | Sequence | str) -> T.StructType:
    """Spark schema for a declared one: an object with ``fields``, a bare list, or JSON text."""
    data = json.loads(source) if isinstance(source, str) else source
    fields = data["fields"] if isinstance(data, Mapping) else data
    return T.StructType([_field(f) for f in fields])


def read_schema_file(spark: SparkSession, path: str) -> T.StructType:
    """Declared schema kept in a file on any file system Spark can read."""
    return declared_schema(spark.read.text(path, wholetext=True).first().value)


def type_text(kind: T.DataType) -> str:
    """DDL text of a type with every nested name quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {type_text(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{type_text(kind.elementType)}>"
    return kind.simpleString()


def _converted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value as the wanted type; structs go by field names, and what does not fit is NULL."""
    nested = isinstance(want, (T.StructType, T.ArrayType))
    if nested and isinstance(have, T.StringType):
        return F.try_variant_get(F.try_parse_json(value), "$", type_text(want))
    if nested and isinstance(have, T.VariantType):
        return F.try_variant_get(value, "$", type_text(want))
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = [
            (_converted(value.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda v: _converted(v, have.elementType, want.elementType))
    if nested:
        return F.lit(None).cast(want)
    if isinstance(have, (T.StructType, T.ArrayType)):
        return F.to_json(value) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    if isinstance(want, T.IntegralType) and isinstance(have, (T.DoubleType, T.FloatType)):
        return F.when(value == F.floor(value), value).try_cast(want)
    if isinstance(want, T.BinaryType):
        return value.cast("string").cast(want) if not isinstance(have, T.BinaryType) else value
    return value.try_cast(want)


def _misfit(value: Column, typed: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value, or one inside it, is there but NULL once it is converted, or missing where it is required."""
    lost = value.isNotNull() & typed.isNull()
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        for f in want.fields:
            inner = typed.getField(f.name)
            if f.name in kinds:
                lost |= _misfit(value.getField(f.name), inner, kinds[f.name], f.dataType)
            if not f.nullable:
                lost |= typed.isNotNull() & inner.isNull()
    elif isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        pairs = F.arrays_zip(value.alias("a"), typed.alias("b"))
        wrong = F.exists(pairs, lambda p: _misfit(p.getField("a"), p.getField("b"), have.elementType, want.elementType))
        lost |= F.coalesce(wrong, F.lit(False))
    elif isinstance(want, (T.StructType, T.ArrayType)) and isinstance(have, (T.StringType, T.VariantType)):
        from weirgate.operators.documents import misfit
        from weirgate.operators.layout import Layout

        document = F.try_parse_json(value) if isinstance(have, T.StringType) else value
        lost |= F.coalesce(misfit(document, Layout.of(want)), F.lit(False))
    return F.coalesce(lost, F.lit(False))


def conform(tagged: DataFrame, declared: T.StructType, extra: str = "keep") -> DataFrame:
    """Bring the columns to their declared types.

    Nested values are matched by the names of their fields. A value that is
    there, at whatever depth, and cannot be converted, or a NULL in a required
    column, tags its record as bad; declared columns the frame lacks are NULL.
    Columns beyond the declared ones are kept, or dropped with ``extra="drop"``.
    """
    have = {f.name: f.dataType for f in tagged.schema.fields}
    data = [c for c in tagged.columns if c != ERROR]
    names = {f.name for f in declared.fields}
    others = [c for c in data if c not in names]
    was = column(ERROR) if ERROR in tagged.columns else F.lit(None).cast(ERROR_TYPE)
    # The values are converted once, next to what they were; then the record is judged.
    typed = [
        (_converted(column(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in declared.fields
    ]
    old = {c: f"_old{i}" for i, c in enumerate(data) if c in names}
    both = tagged.select(*typed, *[column(c) for c in others], *[column(c).alias(o) for c, o in old.items()], was.alias("_was"))
    problems = [F.lit(None).cast("string")]
    for f in declared.fields:
        if f.name in old:
            wrong = _misfit(column(old[f.name]), column(f.name), have[f.name], f.dataType)
            problems.append(F.when(wrong, F.lit(f"{f.name} is not of type {f.dataType.simpleString()}")))
        if not f.nullable:
            problems.append(F.when(column(f.name).isNull(), F.lit(f"{f.name} column cannot be Null")))
    judged = single_pass(both, F.coalesce(*problems), "_problem")
    raw = F.to_json(F.struct([column(old.get(c, c)).alias(c) for c in data]))
    bad = column("_problem").isNotNull()
    error = F.coalesce(column("_was"), error_when(bad, INVALID_RECORD, column("_problem"), raw))
    kept = [] if extra == "drop" else [column(c) for c in others]
    return judged.select(*[column(f.name) for f in declared.fields], *kept, error.alias(ERROR))
