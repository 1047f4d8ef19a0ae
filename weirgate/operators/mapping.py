"""Column maps: keep, rename and convert the flat columns of a record.

``{"flat_table_mapping": {"target": "flat_name|procedure,procedure"}}``
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.procedures import Procedure, lookup
from weirgate.operators.documents import (
    Flattening,
    at,
    is_json_null,
    is_object,
    is_object_text,
    number_kind,
    scalar,
)
from weirgate.operators.layout import DOUBLE, NUMERIC, Layout
from weirgate.operators.records import (
    ERROR,
    ERROR_TYPE,
    INVALID_RECORD,
    MESSAGE_ID,
    SOURCE,
    column,
    error_when,
    single_pass,
)

FILE_NAME = "FileName"

# Texts in the data that stand for something known at run time.
NOW_TOKEN = "CURRENT_TIMESTAMP"
TOPIC_TOKEN = "KAFKA_TOPIC_NAME"
TOPIC_ID_TOKEN = "ALTERNATE_KAFKA_TOPIC_ID"
TOKEN_ZONE = "US/Mountain"


@dataclass(frozen=True)
class Target:
    name: str
    source: str
    procedures: tuple[Procedure, ...]

    @property
    def wants_number(self) -> bool:
        return any(p.wants_number for p in self.procedures)

    def value(self, value: Column) -> Column:
        for p in self.procedures:
            value = p.apply(value, self.name)
        return value

    def problem(self, value: Column) -> Column | None:
        """Message of the first procedure that rejects the value; NULL if none does."""
        messages = []
        for p in self.procedures:
            if p.check is not None:
                messages.append(p.check(value, self.name))
            value = p.apply(value, self.name)
        return F.coalesce(*messages) if messages else None


def parse_column_map(source: Mapping | str) -> list[Target]:
    """Read a column map given as a dict or as JSON text."""
    data = json.loads(source) if isinstance(source, str) else source
    targets = []
    for name, spec in data["flat_table_mapping"].items():
        flat, _, chain = spec.partition("|")
        names = [n for part in chain.split("|") for n in part.split(",") if n]
        targets.append(Target(name, flat, tuple(lookup(n) for n in names)))
    return targets


def now_text(now: Column | None = None) -> Column:
    """Current wall time of the token zone with its UTC offset."""
    now = F.current_timestamp() if now is None else now
    wall = F.from_utc_timestamp(now, TOKEN_ZONE)
    hours = (F.unix_timestamp(now) - F.unix_timestamp(wall)) / 3600
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.format_string("-%02d:00", hours.cast("int"))
    )


def substitute_tokens(
    df: DataFrame, topic: str | None, now: Column | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """Replace values that equal a token, in text columns."""
    stamp = now_text(now)
    chosen = set(df.columns if columns is None else columns)

    def one(f: T.StructField) -> Column:
        c = column(f.name)
        if f.name not in chosen or not isinstance(f.dataType, T.StringType):
            return c
        replaced = F.when(c == NOW_TOKEN, stamp)
        if topic is not None:
            replaced = replaced.when(c == TOPIC_TOKEN, F.lit(topic)).when(
                c == TOPIC_ID_TOKEN, F.concat(F.lit(topic + "_"), stamp)
            )
        return replaced.otherwise(c).alias(f.name)

    return df.select([one(f) for f in df.schema.fields])


def map_columns(df: DataFrame, targets: list[Target], keep: Iterable[str] = (SOURCE, MESSAGE_ID)) -> DataFrame:
    """Apply a column map to a frame that is flat already.

    Mapped columns the frame lacks become NULL. A value a procedure rejects tags
    its record; the mapped values of a tagged record are NULL.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    problems, values = [], []
    for t in targets:
        kind = kinds.get(t.source)
        value = F.lit(None).cast("string") if kind is None else column(t.source)
        if t.wants_number:
            if kind is not None and not isinstance(kind, T.NumericType):
                problems.append(F.when(value.isNotNull(), F.lit(f"{t.name} is not a number")))
                value = F.lit(None)
            value = value.cast("double" if not isinstance(kind, T.IntegralType) else "bigint")
        problem = t.problem(value)
        if problem is not None:
            problems.append(problem)
        values.append((t.name, t.value(value)))
    raw = F.to_json(F.struct([column(c) for c in df.columns if c != ERROR]))
    error = column(ERROR) if ERROR in df.columns else F.lit(None)
    if problems:
        message = F.coalesce(*problems)
        error = F.coalesce(error, error_when(message.isNotNull(), INVALID_RECORD, message, raw))
    kept = [c for c in keep if c in df.columns and c not in {t.name for t in targets}]
    tagged = df.select(
        *[column(c) for c in df.columns if c != ERROR],
        error.cast(ERROR_TYPE).alias(ERROR),
    )
    return tagged.select(
        *[F.when(column(ERROR).isNull(), v).alias(n) for n, v in values],
        *[column(c) for c in kept],
        column(ERROR),
    )


def _leaf_type(target: Target, layout: Layout) -> str:
    kind = layout.scalar_type()
    if target.wants_number and kind not in NUMERIC:
        return DOUBLE
    return kind


def _number_problem(target: Target, value: Column, keys: tuple[str, ...], layout: Layout) -> Column:
    """Message for a value that is there but not a number; the layout may rule that out."""
    if not target.wants_number or layout.scalars <= set(NUMERIC):
        return F.lit(None).cast("string")
    plain = at(value, keys, "variant")
    empty = is_json_null(plain) | is_object(plain)
    return F.when(~empty & ~number_kind(plain), F.lit(f"{target.name} is not a number"))


def _element_problem(target: Target, layout: Layout, value: Column) -> Column:
    found = target.problem(scalar(value, (), layout, _leaf_type(target, layout)))
    return F.coalesce(_number_problem(target, value, (), layout), F.lit(None) if found is None else found)


def _problem(flattening: Flattening, targets: list[Target]) -> Column:
    """Why an opened document is rejected as a whole, judged before anything is exploded.

    Every list contributes at least one row, so a rejected value anywhere in the
    document means at least one rejected flat row, and a look at the values of
    each checked column on its own finds it.
    """
    messages = [F.lit(None).cast("string")]
    for i, t in enumerate(targets):
        checked = t.problem(F.lit(None).cast("double" if t.wants_number else "string"))
        if checked is None and not t.wants_number:
            continue
        leaf = flattening.leaves.get(t.source)
        if leaf is None:
            messages += [] if checked is None else [checked]
        elif not leaf.in_list:
            found = t.problem(column(f"_t{i}"))
            messages += [column(f"_n{i}")] + ([] if found is None else [found])
        else:
            above = next(x for x in flattening.lists if leaf.steps[: len(x.steps) + 1] == (*x.steps, None))
            found = F.transform(above.leaf_values(leaf), partial(_element_problem, t, leaf.layout))
            messages.append(F.get(F.filter(found, lambda m: m.isNotNull()), F.lit(0)))
    return F.coalesce(*messages)


def map_documents(
    tagged: DataFrame,
    document: str,
    targets: list[Target],
    layout: Layout,
    raw: Column,
    topic: str | None = None,
    keep: Iterable[str] = (SOURCE, MESSAGE_ID),
) -> DataFrame:
    """Flatten JSON documents and apply a column map.

    ``raw`` is the text of the documents. A document with a rejected value gives
    one bad record and no rows.
    """
    flattening = Flattening(layout)
    for i, t in enumerate(targets):
        leaf = flattening.leaves.get(t.source)
        if leaf is not None:
            flattening.want(f"_t{i}", t.source, _leaf_type(t, leaf.layout))
            if not leaf.in_list:
                flattening.extract(f"_n{i}", t.source, partial(_number_problem, t))
    kept = [c for c in keep if c in tagged.columns]
    error = F.coalesce(
        column(ERROR), error_when(~is_object_text(raw), INVALID_RECORD, "document is not an object", raw)
    )
    opened = flattening.open(
        tagged.select(*[column(c) for c in kept], raw.alias("_raw"), error.alias(ERROR), column(document)), document
    )
    judged = single_pass(opened, _problem(flattening, targets), "_problem")
    rejected = error_when(column("_problem").isNotNull(), INVALID_RECORD, column("_problem"), column("_raw"))
    good = column(ERROR).isNull() & column("_problem").isNull()
    held = {c: column(c) for x in flattening.lists for c in (x.items, x.other) if c}
    # Values outside of lists are converted once per document, not once per row.
    outside = {
        f"_t{i}": t.value(column(f"_t{i}"))
        for i, t in enumerate(targets)
        if t.source in flattening.leaves and not flattening.leaves[t.source].in_list
    }
    # Without its lists a rejected document is one row.
    checked = judged.select(
        *[column(c) for c in kept],
        *[F.when(good, value).alias(c) for c, value in (held | outside).items()],
        F.coalesce(column(ERROR), rejected).alias(ERROR),
    )
    rows = flattening.explode(checked)
    values = []
    for i, t in enumerate(targets):
        if t.source not in flattening.leaves:
            value = t.value(F.lit(None).cast("double" if t.wants_number else "string"))
        elif f"_t{i}" in outside:
            value = column(f"_t{i}")
        else:
            value = t.value(column(f"_t{i}"))
        values.append(F.when(column(ERROR).isNull(), value).alias(t.name))
    names = {t.name for t in targets}
    extra = [column(c) for c in kept if c not in names]
    if SOURCE in kept and FILE_NAME not in names:
        extra.insert(0, column(SOURCE).alias(FILE_NAME))
    mapped = rows.select(*values, *extra, column(ERROR))
    return substitute_tokens(mapped, topic)
