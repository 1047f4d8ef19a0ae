"""Named procedures of a column map.

A procedure is a pair of Column expressions: ``apply`` gives the new value and
``check`` a message for values it cannot take (NULL where the value is fine).
Checks are data, not exceptions: one bad record never stops the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 1 to 9999.
MIN_MILLIS, MAX_MILLIS = -62135596800000, 253402300799999


@dataclass(frozen=True)
class Procedure:
    name: str
    apply: Callable[[Column, str], Column]
    check: Callable[[Column, str], Column] | None = None
    wants_number: bool = False
    result: str | None = None  # type of the result; None keeps the type of the input


_registry: dict[str, Procedure] = {}


def register(
    name: str,
    apply: Callable[[Column, str], Column],
    check: Callable[[Column, str], Column] | None = None,
    *,
    wants_number: bool = False,
    result: str | None = None,
) -> Procedure:
    """Make ``name`` usable in column maps; both callables get (value, target name)."""
    _registry[name] = Procedure(name, apply, check, wants_number, result)
    return _registry[name]


def lookup(name: str) -> Procedure:
    if name not in _registry:
        raise ValueError(f"unknown procedure {name!r}; known: {', '.join(sorted(_registry))}")
    return _registry[name]


def long_to_timestamp(millis: Column, target: str = "") -> Column:
    """Epoch milliseconds as UTC text with milliseconds."""
    micros = F.rint(millis.cast("double") * 1000).cast("bigint")
    exact = F.coalesce(F.try_multiply(millis.cast("bigint"), F.lit(1000)), micros)
    whole = millis == F.floor(millis)
    return F.date_format(
        F.timestamp_micros(F.when(whole, exact).otherwise(micros)), "yyyy-MM-dd HH:mm:ss.SSS"
    )


def _timestamp_range(millis: Column, target: str) -> Column:
    return F.when(~millis.between(MIN_MILLIS, MAX_MILLIS), F.lit(f"{target} is out of the date range"))


def not_null(value: Column, target: str = "") -> Column:
    return value


def _null_message(value: Column, target: str) -> Column:
    return F.when(value.isNull(), F.lit(f"{target} column cannot be Null"))


register("long_to_timestamp", long_to_timestamp, _timestamp_range, wants_number=True, result="string")
register("not_null", not_null, _null_message)
