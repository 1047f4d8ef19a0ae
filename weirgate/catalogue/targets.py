"""Targets: written, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.catalogue.base import query, scratch, table
from weirgate.operators.records import SOURCE
from weirgate.sinks.database import database_rows
from weirgate.sinks.messages import as_messages, write_messages
from weirgate.sinks.tables import read_table, write_table
from weirgate.sinks.text import write_text


@query("""
    SELECT 'append' AS target, c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'append', c_custkey, c_name FROM customer WHERE c_custkey % 2 = 1
    UNION ALL SELECT 'truncate', c_custkey, c_name FROM customer WHERE c_custkey % 2 = 1
    UNION ALL SELECT 'empty', c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'refused', count(*), NULL FROM customer WHERE c_custkey = 0
""")
def table_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "dispositions")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("here").alias(SOURCE))
    even, odd = customer.where(F.col("c_custkey") % 2 == 0), customer.where(F.col("c_custkey") % 2 == 1)
    for kind, lots in (("append", (even, odd)), ("truncate", (even, odd)), ("empty", (customer.limit(0), even))):
        for lot in lots:
            write_table(lot, {"target_table": f"{path}/{kind}", "write_disposition": f"write_{kind}"})
    refused = 0
    try:
        write_table(odd, {"target_table": f"{path}/empty", "write_disposition": "WRITE_EMPTY"})
    except ValueError:
        refused = 1
    kinds = [read_table(spark, f"{path}/{k}").select(F.lit(k).alias("target"), "c_custkey", "c_name") for k in ("append", "truncate", "empty")]
    note = spark.createDataFrame([("refused", refused, None)], "target string, c_custkey bigint, c_name string")
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(note)


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the session catalog, replaced as a whole."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch(spark, "catalog")
    name = "weirgate_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING) USING parquet LOCATION '{path}'")
    write_table(rows, {"target_table": name, "write_disposition": "WRITE_APPEND"})
    return read_table(spark, name)


@query("""
    SELECT '' AS key_text, '{"n_nationkey":' || c_custkey || ',"name":"' || c_name || '","segment":' ||
           CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS value_text
    FROM customer
""")
def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("n_nationkey"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("segment"),
    )
    return as_messages(rows).select(F.col("key").cast("string").alias("key_text"), F.col("value").cast("string").alias("value_text"))


@query("""SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' AS value_text, 0 AS key_bytes FROM supplier""")
def message_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through a connector given by name."""
    path = scratch(spark, "messages-out")
    write_messages(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), {"format": "parquet", "options": {"path": path}})
    rows = spark.read.parquet(path)
    return rows.select(F.col("value").cast("string").alias("value_text"), F.octet_length("key").alias("key_bytes"))


@query("""SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' AS value FROM supplier""")
def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "text-out")
    write_text(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.text(path)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, '' AS clerk,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS o_orderstatus, '' AS source_name
    FROM orders
""")
def database_sink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a database target receives: all text, in the columns of the table."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", status)
    return database_rows(rows, ["o_orderkey", "clerk", "o_orderstatus"])
