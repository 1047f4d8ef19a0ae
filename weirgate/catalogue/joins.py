"""Lookup joins, incremental loads and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.catalogue.base import query, table
from weirgate.operators.incremental import column_maximum, delta_literal, increment, latest_run, latest_runs
from weirgate.operators.lookup import lookup_join
from weirgate.operators.windows import window_batches, window_counts

LOOKUP_ORACLE = """
    WITH r AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey % 27 END AS nation, o_orderstatus AS status FROM orders
    ), l AS (
        SELECT CASE WHEN s_suppkey % 10 <> 0 THEN s_nationkey END AS nationkey,
               CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS status, s_suppkey,
               row_number() OVER (PARTITION BY CASE WHEN s_suppkey % 10 <> 0 THEN s_nationkey END ORDER BY s_suppkey DESC) AS rn
        FROM supplier
    )
    SELECT o_orderkey, nation, CASE WHEN l.rn IS NOT NULL THEN l.status ELSE r.status END AS status, l.nationkey, l.s_suppkey
    FROM r LEFT JOIN (SELECT * FROM l WHERE rn = 1) l ON r.nation IS NOT DISTINCT FROM l.nationkey
"""


def _lookup_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey") % 27).alias("nation"),
        F.col("o_orderstatus").alias("status"),
    )
    lookup = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 10 != 0, F.col("s_nationkey")).alias("nationkey"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("status"), "s_suppkey",
    )
    return records, lookup


@query(LOOKUP_ORACLE)
def lookup_join_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_join(*_lookup_inputs(spark, sf_dir), {"nation": "nationkey"}, ["s_suppkey"])


@query(LOOKUP_ORACLE)
def lookup_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_join(*_lookup_inputs(spark, sf_dir), {"nation": "nationkey"}, ["s_suppkey"], broadcast_bytes=0)


@query("""
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, c_custkey, c_name, c_mktsegment
    FROM events LEFT JOIN customer ON c_custkey = CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AND c_mktsegment <> 'BUILDING'
""")
def lookup_join_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the records share one key; the lookup is taken as too large to broadcast."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")).cast("bigint").alias("user_id")
    records = table(spark, sf_dir, "events").select("event_id", user, "event_type")
    lookup = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    lookup = lookup.select("c_custkey", "c_name", "c_mktsegment")
    return lookup_join(records, lookup, {"user_id": "c_custkey"}, ["c_custkey"], broadcast_bytes=0, rows_per_task=500)


def _run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per order year; loads of odd years failed."""
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(year.alias("year")).agg(
        F.min("o_orderdate").cast("string").alias("delta_start_val"), F.max("o_orderdate").cast("string").alias("delta_end_val"),
        F.max("o_orderdate").alias("end_ts"),
    ).select(
        F.lit("orders-job").alias("job_name"), F.lit("orders-task").alias("task_name"), "delta_start_val", "delta_end_val",
        "end_ts", F.when(F.col("year") % 2 == 0, "COMPLETED").otherwise("FAILED").alias("status"),
    )


LAST_BOUND = "(SELECT max(o_orderdate) FROM orders WHERE year(o_orderdate) % 2 = 0)"


@query(f"""
    SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS low_seen, true AS upper_is_max FROM orders WHERE o_orderdate > {LAST_BOUND}
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows, bounds = increment(orders, "o_orderdate", _run_history(spark, sf_dir), "orders-job", "orders-task")
    return rows.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("low_seen"),
        (F.lit(bounds.high) == F.lit(column_maximum(orders, "o_orderdate"))).alias("upper_is_max"),
    )


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT CAST(max(o_orderkey) / 2 AS BIGINT) FROM orders WHERE o_orderkey % 2 = 0)
""")
def incremental_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    half = (F.max("o_orderkey") / 2).cast("bigint").cast("string").alias("delta_end_val")
    history = orders.where(F.col("o_orderkey") % 2 == 0).agg(half, F.max("o_orderdate").alias("end_ts")).select(
        F.lit("j").alias("job_name"), F.lit("t").alias("task_name"), "delta_end_val", "end_ts", F.lit("COMPLETED").alias("status")
    )
    rows, _ = increment(orders, "o_orderkey", history, "j", "t")
    return rows.select("o_orderkey", "o_totalprice")


@query("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS top FROM orders")
def increment_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    top = delta_literal(column_maximum(orders, "o_orderdate"), "DATETIME")
    return orders.where(F.col("o_orderdate") == top).select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("top")).distinct()


@query(f"""
    SELECT 'orders-job' AS job_name, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS delta_end_val
    FROM orders WHERE o_orderdate = {LAST_BOUND}
""")
def latest_completed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = latest_run(_run_history(spark, sf_dir), "orders-job", "orders-task")
    return run.select("job_name", "delta_end_val")


@query("""
    SELECT 'job-' || (o_custkey % 50) AS job_name, o_orderpriority AS task_name, strftime(o_orderdate, '%Y-%m-%d') AS last_end,
           CAST(o_orderkey AS VARCHAR) AS delta_end_val
    FROM orders WHERE o_orderstatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY o_custkey % 50, o_orderpriority
                               ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1
""")
def latest_run_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("job-"), (F.col("o_custkey") % 50).cast("string")).alias("job_name"), F.col("o_orderpriority").alias("task_name"),
        F.col("o_orderdate").alias("end_ts"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("FAILED").alias("status"),
        F.col("o_orderkey").cast("string").alias("delta_end_val"),
    )
    return latest_runs(audit).select(
        "job_name", "task_name", F.date_format("end_ts", "yyyy-MM-dd").alias("last_end"), "delta_end_val"
    )


@query("""
    SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS messages
    FROM events GROUP BY ALL
""")
def window_message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = window_counts(table(spark, sf_dir, "events"), "ts", 10, ["event_type"])
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "messages")


@query("""
    WITH numbered AS (
        SELECT date_trunc('day', ts) AS day, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY event_id) - 1 AS n FROM events
    )
    SELECT strftime(day, '%Y-%m-%d') AS day, CAST(n // 100 AS BIGINT) AS batch_no, count(*) AS messages FROM numbered GROUP BY ALL
""")
def window_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = window_batches(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 1440, size=100)
    counts = batches.groupBy("window_start", "batch_no").agg(F.count("*").alias("messages"))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "batch_no", "messages")
