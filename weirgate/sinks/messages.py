"""Message targets."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.operators.records import record_json


def as_messages(df: DataFrame) -> DataFrame:
    """(key, value): an empty key and the record as UTF-8 JSON."""
    return df.select(F.lit(b"").alias("key"), record_json(df).cast("binary").alias("value"))


def producer_options(target: Mapping[str, Any]) -> dict[str, str]:
    options = {f"kafka.{k}": str(v) for k, v in target.get("producer_config", {}).items()}
    return options | {"topic": str(target["topic_name"])}


def write_messages(df: DataFrame, target: Mapping[str, Any]) -> None:
    """Send records as messages; ``format`` names another connector than Kafka, with its ``options``."""
    data_format = target.get("format", "kafka")
    if data_format == "kafka":
        as_messages(df).write.format("kafka").options(**producer_options(target)).save()
    else:
        as_messages(df).write.mode("append").format(data_format).options(**target.get("options", {})).save()
