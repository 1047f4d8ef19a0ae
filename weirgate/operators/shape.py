"""Explode and flatten for DataFrames whose nesting is in the schema.

``explode_lists`` expands every top-level array (a cross product when there
are several), ``flatten`` joins nested field names, ``flatsplode`` alternates
the two until neither arrays nor structs are left. All of it is a chain of
``explode`` and ``select``: no shuffle, one streaming pass per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.records import column


def _truthy(value: Column, kind: T.DataType) -> Column:
    """Whether a list element counts as present: not null, zero, false or empty."""
    if isinstance(kind, T.NumericType):
        return value != F.lit(0)
    if isinstance(kind, T.BooleanType):
        return value
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.length(value) > 0
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.size(value) > 0
    return value.isNotNull()


def list_or_null(value: Column, kind: T.ArrayType) -> Column:
    """The list itself, or a list of one NULL when no element is truthy."""
    any_truthy = F.coalesce(F.exists(value, lambda x: _truthy(x, kind.elementType)), F.lit(False))
    return F.when(any_truthy, value).otherwise(F.array(F.lit(None).cast(kind.elementType)))


def explode_lists(df: DataFrame) -> DataFrame:
    """One row per combination of the elements of all top-level arrays."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            others = [column(c) for c in df.columns]
            at = df.columns.index(f.name)
            others[at] = F.explode(list_or_null(column(f.name), f.dataType)).alias(f.name)
            df = df.select(others)
    return df


def _leaves(schema: T.StructType, join: str) -> Iterator[tuple[str, int, Column]]:
    def walk(value: Column, name: str, kind: T.DataType, depth: int):
        if isinstance(kind, T.StructType):
            if not kind.fields:
                yield name, depth, F.lit(None).cast("string")
            for f in kind.fields:
                yield from walk(value.getField(f.name), f"{name}{join}{f.name}", f.dataType, depth + 1)
        else:
            yield name, depth, value

    for f in schema.fields:
        yield from walk(column(f.name), f.name, f.dataType, 0)


def flatten(df: DataFrame, join: str = ".") -> DataFrame:
    """Struct fields become ``parent<join>child`` columns, at any depth.

    If two leaves get the same name, the one nearer the top is kept.
    """
    chosen: dict[str, tuple[int, Column]] = {}
    for name, depth, value in _leaves(df.schema, join):
        if name not in chosen or depth < chosen[name][0]:
            chosen[name] = (depth, value)
    return df.select([value.alias(name) for name, (_, value) in chosen.items()])


def flatsplode(df: DataFrame, join: str = "_") -> DataFrame:
    """Explode and flatten until only plain columns are left."""
    while any(isinstance(f.dataType, (T.ArrayType, T.StructType)) for f in df.schema.fields):
        df = flatten(explode_lists(df), join)
    return df


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Fields of the top-level structs as ``parent_child``; other columns are dropped."""
    return df.select(
        [
            column(f.name).getField(g.name).alias(f"{f.name}_{g.name}")
            for f in df.schema.fields
            if isinstance(f.dataType, T.StructType)
            for g in f.dataType.fields
        ]
    )
