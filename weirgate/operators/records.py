"""Record-level operators: valid/invalid split, projections, null rules, ids.

A *tagged* DataFrame is what every source returns: the data columns,
``source_name``, and a nullable ``_error`` struct that is set on bad records.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "_error"
SOURCE = "source_name"
MESSAGE_ID = "RawMessageId"
ARCHIVE_SEPARATOR = "\u0001"

# The kinds of bad record.
INVALID_RECORD = "Invalid Record"
INVALID_JSON = "Invalid Json"
INVALID_XML = "Invalid Xml"

ERROR_TYPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

# The columns of the error table.
ERROR_TABLE = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("error_record", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_desc", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("insert_ts", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Ingested:
    """The two outputs of a source."""

    valid: DataFrame
    invalid: DataFrame


def quoted(name: str) -> str:
    """Column reference text for a name that may hold dots or back-ticks."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def no_error() -> Column:
    return F.lit(None).cast(ERROR_TYPE)


def error_when(bad: Column, kind: str, desc: Column | str, raw: Column) -> Column:
    """The ``_error`` value: filled where ``bad`` holds, NULL elsewhere."""
    desc = F.lit(desc) if isinstance(desc, str) else desc
    filled = F.struct(F.lit(kind).alias("type"), desc.alias("desc"), raw.cast("string").alias("raw"))
    return F.when(bad, filled.cast(ERROR_TYPE))


def as_tagged(df: DataFrame) -> DataFrame:
    """Add the ``_error`` column to a frame whose records are all good."""
    return df if ERROR in df.columns else df.withColumn(ERROR, no_error())


def single_pass(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a costly column that later filters must not evaluate a second time.

    Catalyst pushes a filter on a projected expression below the projection and
    so computes it twice (once per JSON document here). Predicates on generator
    output stay where they are, hence the one-element ``explode``.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def spread(scan: DataFrame) -> DataFrame:
    """Hand the rows of a scan to all cores when it has fewer splits than cores.

    Meant for a few unsplittable or small files whose records are costly to
    parse. A scan with enough splits stays as it is, without a shuffle.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan.repartition(cores) if splits < cores else scan


def read_together(df: DataFrame) -> DataFrame:
    """Keep the columns of a scan together, whatever is used of them later.

    A CSV or XML scan refuses to read its column of raw bad records alone, which
    is what a count of the bad records would otherwise come down to.
    """
    rows = df.select(F.explode(F.array(F.struct(*[column(c) for c in df.columns]))).alias("_scan"))
    return rows.select([column("_scan").getField(c).alias(c) for c in df.columns])


def error_records(
    tagged: DataFrame, job_name: str, job_id: str | None, target: str, insert_ts: datetime | None = None
) -> DataFrame:
    """Bad records of a tagged frame in the layout of the error table."""
    stamp = F.current_timestamp() if insert_ts is None else F.lit(insert_ts)
    bad = tagged.where(column(ERROR).isNotNull())
    return bad.select(
        F.lit(job_name).cast("string").alias("job_name"),
        F.lit(job_id).cast("string").alias("job_id"),
        F.col(f"{ERROR}.raw").alias("error_record"),
        F.col(f"{ERROR}.type").alias("error_type"),
        F.col(f"{ERROR}.desc").alias("error_desc"),
        F.lit(target).cast("string").alias("target_table"),
        column(SOURCE).cast("string").alias(SOURCE) if SOURCE in tagged.columns
        else F.lit(None).cast("string").alias(SOURCE),
        stamp.cast("timestamp").alias("insert_ts"),
    )


def split(
    tagged: DataFrame, job_name: str = "", job_id: str | None = None, target: str = "",
    insert_ts: datetime | None = None,
) -> Ingested:
    """Valid rows keep their shape; bad ones become error records."""
    valid = tagged.where(column(ERROR).isNull()).drop(ERROR)
    return Ingested(valid, error_records(tagged, job_name, job_id, target, insert_ts))


def select_required(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Keep the listed columns (any case) and ``source_name``; order and case stay."""
    wanted = {name.lower() for name in required}
    keep = [c for c in df.columns if c in (SOURCE, ERROR) or c.lower() in wanted]
    return df.select([column(c) for c in keep])


def drop_source_name(df: DataFrame) -> DataFrame:
    return df.select([column(c) for c in df.columns if c.lower() != SOURCE])


def attach_source_name(df: DataFrame, name: Column | str) -> DataFrame:
    return df.withColumn(SOURCE, F.lit(name) if isinstance(name, str) else name)


def null_markers(df: DataFrame, markers: Sequence[str], columns: Iterable[str] | None = None) -> DataFrame:
    """Values that equal one of the markers become NULL."""
    if not markers:
        return df
    chosen = set(columns if columns is not None else [c for c in df.columns if c != ERROR])
    return df.select(
        [
            F.when(~column(c).isin(list(markers)), column(c)).alias(c) if c in chosen else column(c)
            for c in df.columns
        ]
    )


def typed_nulls(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``n`` (any case) stands for NULL in columns whose declared type is not a string."""
    kinds = {f.name: f.dataType for f in declared.fields}
    return df.select(
        [
            F.when(F.lower(column(c)) != "n", column(c)).alias(c)
            if c in kinds and not isinstance(kinds[c], T.StringType)
            else column(c)
            for c in df.columns
        ]
    )


def timestamp_text(ts: Column) -> Column:
    """UTC text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def normalise_database_rows(df: DataFrame) -> DataFrame:
    """The text ``None`` becomes NULL and timestamps become UTC text."""

    def one(f: T.StructField) -> Column:
        c = column(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = timestamp_text(c)
        elif isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit("None"))
        return c.alias(f.name)

    return df.select([one(f) for f in df.schema.fields])


def base64_binary(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.base64(column(f.name)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else column(f.name)
            for f in df.schema.fields
        ]
    )


def stringify(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """All target columns as text: missing columns, NULL and ``None`` become ``''``.

    Target columns come first in their order; further columns of the record
    follow, as the record itself decides what is written.
    """
    names = list(target_columns) + [c for c in df.columns if c not in target_columns]

    def one(name: str) -> Column:
        if name not in df.columns:
            return F.lit("").alias(name)
        text = F.coalesce(column(name).cast("string"), F.lit(""))
        return F.when(text == "None", "").otherwise(text).alias(name)

    return df.select([one(n) for n in names])


def message_ids(df: DataFrame, name: str = MESSAGE_ID) -> DataFrame:
    """Give each row an id ``<uuid>_<UTC time>``.

    In batch the uuid is a digest of a run token and the row's position, and the
    time is fixed when the plan is built. A task that runs again after an
    executor is lost, or a second sink over the same plan, so sees the same ids,
    which ``uuid()`` would not give. Row positions start over in every
    micro-batch, so an unbounded frame takes ``uuid()``.
    """
    if df.isStreaming:
        token = F.expr("uuid()")
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd_HH:mm:ss.SSSSSS")
    else:
        digest = F.md5(F.concat(F.lit(uuid.uuid4().hex), F.monotonically_increasing_id().cast("string")))
        token = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        stamp = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d_%H:%M:%S.%f"))
    return df.withColumn(name, F.concat_ws("_", token, stamp))


def archive_line(message_id: Column, payload: Column) -> Column:
    """Line of the raw archive: id and payload around a control character."""
    return F.concat(message_id, F.lit(ARCHIVE_SEPARATOR), payload)


def rewrite_source(path: Column, staging: str, original: str) -> Column:
    """Put the original location in place of the staging one."""
    return F.replace(path, F.lit(staging.strip("*")), F.lit(original.strip("/")))


def utf8_text(value: Column) -> Column:
    """Decode message bytes; bytes that are not UTF-8 keep replacement characters."""
    return F.make_valid_utf8(value.cast("string"))


def record_json(df: DataFrame) -> Column:
    """Each record as one JSON object with explicit nulls."""
    return F.to_json(
        F.struct([column(c) for c in df.columns if c != ERROR]), {"ignoreNullFields": "false"}
    )


def resolve_variables(text: str, variables: dict[str, str]) -> str:
    """Put values in place of ``##name##``.

    For identifiers and connector queries, which have no parameter markers;
    queries Spark runs itself take markers instead (``sources.warehouse``).
    """
    for name, value in variables.items():
        text = text.replace(f"##{name}##", value)
    return text
