"""JSON documents: strict parsing, root extraction, explode and flatten.

Documents are parsed once into VARIANT, which keeps each value's own type, so
that truthiness of list elements and objects that are sometimes lists behave
as the documents say and not as a widened column type would have it.
"""

from __future__ import annotations

import operator
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.layout import BIGINT, BOOLEAN, DECIMAL, STRING, Layout
from weirgate.operators.records import ERROR, INVALID_RECORD, column, error_when, single_pass
from weirgate.schema import type_text


def parse_strict(df: DataFrame, text: Column, document: str) -> DataFrame:
    """Add VARIANT for text that is exactly one JSON value, NULL for other text.

    The parser itself ignores whatever follows the first value, so the text is
    parsed as the first of two array elements; the second, a token made up for
    this plan, is where it should be only if nothing followed.
    """
    token = uuid.uuid4().hex
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{token}"]')))
    closed = F.try_variant_get(column("_pair"), "$[1]", "string") == token
    alone = F.try_variant_get(column("_pair"), "$[2]", "variant").isNull()
    value = F.try_variant_get(column("_pair"), "$[0]", "variant")
    return single_pass(df, pair, "_pair").withColumn(document, F.when(closed & alone, value)).drop("_pair")


def at(value: Column, keys: tuple[str, ...], kind: str) -> Column:
    """The value under nested keys as a Spark type; NULL where there is none that fits.

    A path is followed inside the document and only what it leads to is copied.
    Keys that cannot be written in a path are opened one by one.
    """
    path = "$"
    for i, key in enumerate(keys):
        if not key or ('"' in key and ("." in key or "[" in key)) or "?" in key:
            inner = F.element_at(at(value, keys[:i], "map<string,variant>"), F.lit(key))
            return at(inner, keys[i + 1:], kind)
        path += f'["{key}"]' if "." in key or "[" in key else f".{key}"
    return F.try_variant_get(value, path, kind)


def as_list(value: Column) -> Column:
    return at(value, (), "array<variant>")


def is_object(value: Column) -> Column:
    return at(value, (), "struct<_: variant>").isNotNull()


def is_object_text(text: Column) -> Column:
    """Whether a JSON text is that of an object."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def is_json_null(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def child(value: Column, key: str) -> Column:
    """The value under a key, whatever characters the key holds."""
    return at(value, (key,), "variant")


# JSON texts that do not count as a list element: null, false, zero and the empty ones.
_EMPTY = r'^(null|false|""|\[\]|\{\}|-?0(\.0*)?([eE].*)?)$'


def _truthy(layout: Layout, value: Column) -> Column:
    """Whether a list element counts as present: not null, false, zero or empty.

    ``layout`` is that of the elements; where it leaves no doubt about their kind
    a look at the value is enough, otherwise its JSON text decides.
    """
    kinds = sorted(layout.scalars)
    if not layout.complete:
        present = ~F.to_json(value).rlike(_EMPTY)
    elif layout.items is None and layout.fields is None and len(kinds) == 1:
        plain = at(value, (), kinds[0])
        present = F.length(plain) > 0 if kinds[0] == STRING else plain if kinds[0] == BOOLEAN else plain != 0
    elif not kinds and layout.items is None and layout.fields and len(layout.fields) <= 16:
        present = F.coalesce(*[child(value, key) for key in layout.fields]).isNotNull()
    elif not kinds and layout.fields is None and layout.items is not None:
        present = F.try_variant_get(value, "$[0]", "variant").isNotNull()
    else:
        present = ~F.to_json(value).rlike(_EMPTY)
    return F.coalesce(present, F.lit(False))


def list_values(value: Column, items: Column, layout: Layout) -> Column:
    """The elements to continue with: those of a list, or the value itself.

    ``items`` is ``as_list(value)``. A list without a truthy element stands for
    one NULL.
    """
    nothing = F.array(F.lit(None).cast("variant"))
    elements = F.when(F.exists(items, partial(_truthy, layout.items)), items).otherwise(nothing)
    if layout.scalars or layout.fields is not None:
        return F.when(items.isNull(), F.array(value)).otherwise(elements)
    return elements


def explode_root(tagged: DataFrame, document: str, root: str | None, raw: Column,
                 kind: str = INVALID_RECORD) -> DataFrame:
    """Take ``root`` out of each document; a list becomes one row per element.

    Elements that are not objects, documents without the root and documents
    that are neither object nor list become bad records one by one.
    """
    value = column(document) if root is None else child(column(document), root)
    items = as_list(value)
    nothing = F.array(F.lit(None).cast("variant"))
    elements = (
        F.when(column(ERROR).isNotNull(), nothing).when(items.isNotNull(), items).otherwise(F.array(value))
    )
    others = [column(c) for c in tagged.columns if c != document]
    rows = tagged.select(*others, F.explode(elements).alias(document))
    element = column(document)
    bad = ~is_object(element) | element.isNull()
    desc = "document is not an object" if root is None else f"no object under {root!r}"
    text = F.coalesce(F.to_json(element), raw)
    return rows.withColumn(ERROR, F.coalesce(column(ERROR), error_when(bad, kind, desc, text)))


def read_documents(lines: DataFrame, text: str, kind: str = INVALID_RECORD, document: str = "_document") -> DataFrame:
    """Parse a text column; text that is not JSON tags the record as bad."""
    parsed = parse_strict(lines, column(text), document)
    bad = column(document).isNull()
    return parsed.withColumn(ERROR, error_when(bad, kind, "not a JSON document", column(text)))


def _scalar_misfit(value: Column, layout: Layout, flat: bool) -> Column:
    kind = layout.scalar_type()
    nested = is_object(value) | as_list(value).isNotNull()
    plain = at(value, (), kind)
    if kind == STRING:
        return nested if flat else F.lit(False)
    wrong = nested | plain.isNull()
    if kind in (BIGINT, DECIMAL):
        number = at(value, (), "double")
        wrong |= number.isNotNull() & (number != plain.cast("double"))  # a fraction would be cut off
    return wrong


def misfit(value: Column, layout: Layout, flat: bool = False) -> Column:
    """Whether a document holds something that its declared layout has no place for.

    A value that is there but not of the declared kind, at whatever depth. With
    ``flat`` lists count that the layout does not know, as each would multiply the
    rows; other keys it does not know are left out. Declared text takes any value,
    unless it is to be flattened.
    """
    ways = []
    if layout.fields is not None:
        wrong = ~is_object(value)
        for key, inner in layout.fields.items():
            wrong |= misfit(child(value, key), inner, flat)
        if flat:
            others = F.map_filter(at(value, (), "map<string,variant>"), lambda k, _: ~k.isin(list(layout.fields)))
            hidden = F.exists(F.map_values(others), lambda v: F.schema_of_variant(v).contains("ARRAY<"))
            # Few documents hold a list at all, which their schema tells without a map of their values.
            listed = F.schema_of_variant(value).contains("ARRAY<")
            wrong |= F.when(listed, F.coalesce(hidden, F.lit(False))).otherwise(F.lit(False))
        ways.append(wrong)
    if layout.items is not None:
        inside = F.exists(as_list(value), lambda v: misfit(v, layout.items, flat))
        ways.append(as_list(value).isNull() | F.coalesce(inside, F.lit(False)))
    if layout.scalars:
        ways.append(_scalar_misfit(value, layout, flat))
    if not ways:
        return F.lit(False)
    return ~is_json_null(value) & F.coalesce(reduce(operator.and_, ways), F.lit(False))


def judged(tagged: DataFrame, document: str, layout: Layout, raw: Column, kind: str = INVALID_RECORD,
           flat: bool = False) -> DataFrame:
    """Tag documents that do not fit a declared layout; one found in the data fits by itself."""
    if layout.complete:
        return tagged
    checked = single_pass(tagged, column(ERROR).isNull() & misfit(column(document), layout, flat), "_misfit")
    error = error_when(column("_misfit"), kind, "value does not fit the declared layout", raw)
    return checked.withColumn(ERROR, F.coalesce(column(ERROR), error)).drop("_misfit")


def nested_rows(tagged: DataFrame, document: str, layout: Layout) -> DataFrame:
    """One column per top-level key, nested values as structs and arrays."""
    kind = layout.spark_type()
    if not isinstance(kind, T.StructType) or not kind.fields:
        return tagged.drop(document)
    others = [c for c in tagged.columns if c != document]
    wanted = [f for f in kind.fields if f.name not in others]
    typed = F.try_variant_get(column(document), "$", type_text(T.StructType(wanted)))
    rows = single_pass(tagged, typed, "_row")
    return rows.select([column("_row").getField(f.name).alias(f.name) for f in wanted] + [column(c) for c in others])


# The way from a document to a value: keys, and None for "the elements of the list".
Steps = tuple[str | None, ...]


@dataclass(frozen=True)
class FlatColumn:
    """A column of the flattened documents and how to find its values."""

    name: str
    steps: Steps
    layout: Layout

    @property
    def in_list(self) -> bool:
        return None in self.steps

    @property
    def depth(self) -> int:
        return sum(step is not None for step in self.steps)


def flat_columns(layout: Layout, join: str = "_") -> dict[str, FlatColumn]:
    """Flat name -> column. Of two leaves with one name the upper one counts."""
    found: dict[str, FlatColumn] = {}

    def walk(node: Layout, name: str, steps: Steps) -> None:
        if node.items is not None:
            walk(node.element(), name, (*steps, None))
            return
        leaf = FlatColumn(name, steps, node)
        if name and (node.scalars or not node.fields) and (name not in found or leaf.depth < found[name].depth):
            found[name] = leaf
        for key, inner in (node.fields or {}).items():
            walk(inner, f"{name}{join}{key}", (*steps, key))

    for key, inner in (layout.fields or {}).items():
        walk(inner, key, (key,))
    return found


def scalar(value: Column, keys: tuple[str, ...], layout: Layout, kind: str) -> Column:
    """A leaf as a plain column; an object in the place of a scalar gives NULL."""
    plain = at(value, keys, kind)
    return plain if layout.fields is None else F.when(~is_object(at(value, keys, "variant")), plain)


@dataclass(frozen=True)
class ListColumn:
    """A list taken out of a document, not exploded yet."""

    items: str
    other: str | None  # the value where it is no list, if documents disagree
    steps: Steps
    layout: Layout

    def elements(self) -> Column:
        value = F.lit(None).cast("variant") if self.other is None else column(self.other)
        return list_values(value, column(self.items), self.layout)

    def leaf_values(self, leaf: FlatColumn) -> Column:
        """All values a flat column takes below this list, as an array of VARIANT.

        Its size follows the document, not the cross product of its lists.
        """
        values, layout, keys = self.elements(), self.layout.element(), ()
        for step in leaf.steps[len(self.steps) + 1:]:
            if step is None:
                values = F.flatten(F.transform(values, partial(_elements, keys, layout)))
                layout, keys = layout.element(), ()
            else:
                keys += (step,)
                layout = layout.fields[step]
        return F.transform(values, partial(_value, keys)) if keys else values


def _elements(keys: tuple[str, ...], node: Layout, v: Column) -> Column:
    return list_values(at(v, keys, "variant"), at(v, keys, "array<variant>"), node)


def _value(keys: tuple[str, ...], v: Column) -> Column:
    return at(v, keys, "variant")


# Extracts of a place in the documents: column name and (VARIANT, keys, layout) -> Column.
Extract = tuple[str, Callable[[Column, tuple[str, ...], Layout], Column]]


class Flattening:
    """Explode and flatten documents of a VARIANT column, in two steps.

    ``open`` puts the wanted scalars and the lists of the documents in their
    place; records can be judged there, before ``explode`` multiplies them: one
    ``explode`` per list in the layout, wanted or not, as each counts. Scalars
    are taken out before the next list is exploded, so rows do not drag whole
    documents along. There is no shuffle.
    """

    def __init__(self, layout: Layout, join: str = "_") -> None:
        self.layout = layout
        self.leaves = flat_columns(layout, join)
        self.lists: list[ListColumn] = []
        self._places: dict[Steps, list[Extract]] = {}

    def want(self, name: str, flat: str, kind: str) -> None:
        """Ask for a flat column of a type, to be called ``name``."""
        self.extract(name, flat, partial(_scalar, kind))

    def extract(self, name: str, flat: str, take: Callable[[Column, tuple[str, ...], Layout], Column]) -> None:
        self._places.setdefault(self.leaves[flat].steps, []).append((name, take))

    def open(self, df: DataFrame, document: str) -> DataFrame:
        opened, self.lists = self._opened(df, document, (), Layout(fields=self.layout.fields or {}))
        return opened

    def explode(self, df: DataFrame) -> DataFrame:
        lists = list(self.lists)
        while lists:
            found = lists.pop()
            others = [column(c) for c in df.columns if c not in (found.items, found.other)]
            df = df.select(*others, F.explode(found.elements()).alias(found.items))
            df, inner = self._opened(df, found.items, (*found.steps, None), found.layout.element())
            lists += inner
        return df

    def _opened(self, df: DataFrame, base: str, steps: Steps, layout: Layout) -> tuple[DataFrame, list[ListColumn]]:
        columns: list[Column] = []
        lists: list[ListColumn] = []

        def visit(node: Layout, keys: tuple[str, ...]) -> None:
            if node.items is not None:
                items = f"{base}_{len(lists)}"
                mixed = bool(node.scalars) or node.fields is not None
                columns.append(at(column(base), keys, "array<variant>").alias(items))
                if mixed:
                    columns.append(at(column(base), keys, "variant").alias(f"{items}_other"))
                lists.append(ListColumn(items, f"{items}_other" if mixed else None, (*steps, *keys), node))
                return
            for name, take in self._places.get((*steps, *keys), ()):
                columns.append(take(column(base), keys, node).alias(name))
            for key, inner in (node.fields or {}).items():
                visit(inner, (*keys, key))

        visit(layout, ())
        return df.select(*[column(c) for c in df.columns if c != base], *columns), lists


def _scalar(kind: str, value: Column, keys: tuple[str, ...], layout: Layout) -> Column:
    return scalar(value, keys, layout, kind)


def number_kind(value: Column) -> Column:
    """Whether a VARIANT holds a JSON number."""
    return F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def flat_rows(tagged: DataFrame, document: str, layout: Layout, join: str = "_") -> DataFrame:
    """Exploded and flattened documents as typed columns, next to the other columns."""
    others = [c for c in tagged.columns if c != document]
    flattening = Flattening(layout, join)
    names = [n for n in flattening.leaves if n not in others]
    for name in names:
        flattening.want(name, name, flattening.leaves[name].layout.scalar_type())
    rows = flattening.explode(flattening.open(tagged, document))
    return rows.select(*[column(n) for n in names], *[column(c) for c in others])
