"""API responses: resolved addresses, and bodies flattened into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators import documents as D
from weirgate.operators.layout import Layout, infer
from weirgate.operators.records import ERROR, INVALID_RECORD, SOURCE, column, error_when


def resolved_url(base: Column | str, params: Column | Sequence[str] | str | None) -> Column:
    """``base?first&second``; parameters may be an array column, a list or one text."""
    base = F.lit(base) if isinstance(base, str) else base
    if params is None or (not isinstance(params, Column) and not params):
        return base
    if isinstance(params, str):
        params = [params]
    if not isinstance(params, Column):
        params = F.array(*[F.lit(p) for p in params])
    joined = F.concat(base, F.lit("?"), F.array_join(params, "&"))
    return F.when(F.coalesce(F.size(params), F.lit(0)) > 0, joined).otherwise(base)


def response_rows(responses: DataFrame, root: str | None = None,
                  layout: Layout | T.StructType | None = None) -> DataFrame:
    """Rows of (url, body) responses. The payload, or what lies under ``root``, must be an object."""
    named = responses.select(column("url").alias(SOURCE), column("body").alias("value"))
    documents = D.read_documents(named, "value", INVALID_RECORD, "_document")
    value = column("_document") if root is None else D.child(column("_document"), root)
    rooted = documents.withColumn("_document", F.when(column(ERROR).isNull(), value))
    bad = ~D.is_object(column("_document"))
    error = F.coalesce(column(ERROR), error_when(bad, INVALID_RECORD, "payload is not an object", column("value")))
    tagged = rooted.withColumn(ERROR, error).drop("value")
    # Payloads that are not objects have no keys and give one tagged row each.
    objects = tagged.withColumn("_document", F.when(column(ERROR).isNull(), column("_document")))
    if layout is None:
        layout = infer(objects.where(column(ERROR).isNull()), "_document")
    elif isinstance(layout, T.StructType):
        layout = Layout.of(layout)
    return D.flat_rows(objects, "_document", layout)
