"""Message sources: frames of (key, value, timestamp), batch or streaming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.layout import Layout
from weirgate.operators.records import (
    ERROR,
    INVALID_JSON,
    INVALID_RECORD,
    SOURCE,
    column,
    error_when,
    message_ids,
    single_pass,
    utf8_text,
)
from weirgate.sources.files import document_rows, flatten_lines


def kafka_options(topic: str, consumer: Mapping[str, str], starting: str | None = None) -> dict[str, str]:
    """Reader options for a topic. The session needs the spark-sql-kafka package."""
    options = {}
    for key, value in consumer.items():
        key = {"bootstrap.server": "bootstrap.servers"}.get(key, key)
        if key == "auto.offset.reset":
            starting = starting or str(value)
        elif key not in ("enable.auto.commit", "group.id"):
            options[f"kafka.{key}"] = str(value)
    options["subscribe"] = topic
    options["kafka.group.id"] = str(consumer.get("group.id", f"{topic}Group"))
    if starting:
        options["startingOffsets"] = starting
    return options


def kafka_messages(spark: SparkSession, topic: str, consumer: Mapping[str, str], *, stream: bool = True,
                   starting: str | None = None) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**kafka_options(topic, consumer, starting)).load()


def _texts(messages: DataFrame, name: str) -> DataFrame:
    others = [column(c) for c in messages.columns if c not in ("key", "value", SOURCE)]
    return messages.select(utf8_text(column("value")).alias("value"), F.lit(name).alias(SOURCE), *others)


def json_messages(messages: DataFrame, name: str, layout: Layout | T.StructType | None = None,
                  kind: str = INVALID_JSON) -> DataFrame:
    """One record per JSON message. A stream needs a layout: it cannot be read twice."""
    if messages.isStreaming and layout is None:
        raise ValueError("a stream of JSON messages needs a layout")
    return document_rows(_texts(messages, name), None, layout, kind)


def flatten_messages(messages: DataFrame, topic: str, column_map: Mapping | str,
                     layout: Layout | T.StructType | None = None) -> DataFrame:
    """JSON messages flattened and renamed; every message gets an id."""
    if messages.isStreaming and layout is None:
        raise ValueError("a stream of JSON messages needs a layout")
    return flatten_lines(message_ids(_texts(messages, topic)), column_map, layout, topic)


def avro_messages(messages: DataFrame, name: str, avro_schema: str) -> DataFrame:
    """One record per Avro message written with one schema; needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    rows = single_pass(
        messages.select("value", F.lit(name).alias(SOURCE)),
        from_avro(F.col("value"), avro_schema, {"mode": "PERMISSIVE"}),
        "_record",
    )
    # In permissive mode a message that cannot be decoded has only NULL fields.
    fields = [f.name for f in rows.schema["_record"].dataType.fields]
    empty = F.coalesce(*[F.col("_record").getField(f).cast("string") for f in fields]).isNull()
    error = error_when(empty, INVALID_RECORD, "not a message of the Avro schema", F.base64("value"))
    return rows.select(
        *[F.col("_record").getField(f).alias(f) for f in fields], column(SOURCE), error.alias(ERROR)
    )
