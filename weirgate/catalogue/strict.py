"""Values that don't fit, targets that several writers share, sources that come and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.catalogue.base import query, scratch, table, write_lines
from weirgate.operators.records import split, spread
from weirgate.plans import run_stream_task, run_task, run_tasks
from weirgate.schema import conform, declared_schema
from weirgate.sinks.tables import read_table
from weirgate.sources import config, delimited, files, messages
from weirgate.streaming import runner

LAYOUT = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType())])
MAPPING = {"flat_table_mapping": {"id": "id|not_null", "kind": "kind"}}

# Every fifth id is text that is no number, every seventh a list of two.
OUTCOMES = """
    SELECT event_id AS id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'error' ELSE event_type END AS outcome FROM events
"""


def _odd_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id").cast("string")
    odd = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('"x'), number, F.lit('"')))
    odd = odd.when(F.col("event_id") % 7 == 0, F.concat(F.lit("["), number, F.lit(","), number, F.lit("]"))).otherwise(number)
    text = F.concat(F.lit('{"id":'), odd, F.lit(',"kind":"'), F.col("event_type"), F.lit('"}'))
    return spread(table(spark, sf_dir, "events")).select("event_id", "ts", text.alias("value"))


def _record_id() -> Column:
    return F.regexp_extract("error_record", "([0-9]+)", 1).cast("bigint").alias("id")


def _outcomes(valid: DataFrame, errors: DataFrame) -> DataFrame:
    """Each source record once: its row, or its error record."""
    return valid.select("id", F.col("kind").alias("outcome")).unionByName(errors.select(_record_id(), F.lit("error").alias("outcome")))


@query(OUTCOMES)
def ndjson_layout_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_odd_ids(spark, sf_dir).select("value"), scratch(spark, "misfits"))
    parts = split(files.ndjson_scan(spark, path, layout=LAYOUT))
    return _outcomes(parts.valid, parts.invalid)


@query(OUTCOMES)
def flatten_layout_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_odd_ids(spark, sf_dir).select("value"), scratch(spark, "misfits"))
    parts = split(files.flatten_json_scan(spark, path, MAPPING, LAYOUT))
    return _outcomes(parts.valid, parts.invalid)


def _message_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    rows = _odd_ids(spark, sf_dir).select(F.lit(b"").alias("key"), F.col("value").cast("binary").alias("value"), F.col("ts").alias("timestamp"))
    rows.write.parquet(path)
    return runner.stream_table(spark, path, rows.schema)


def _run_stream(tagged: DataFrame, path: str) -> None:
    task = {"job_name": "strict", "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}], "error": {"error_table": f"{path}/errors"}}
    runner.start(tagged, runner.fan_out(task, "job"), f"{path}/checkpoint", available_now=True).awaitTermination()


@query(OUTCOMES)
def stream_layout_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-misfits")
    _run_stream(messages.json_messages(_message_stream(spark, sf_dir, f"{path}/in"), "topic", LAYOUT), path)
    return _outcomes(read_table(spark, f"{path}/out"), read_table(spark, f"{path}/errors"))


@query(OUTCOMES)
def stream_message_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-flatten")
    _run_stream(messages.flatten_messages(_message_stream(spark, sf_dir, f"{path}/in"), "topic", MAPPING, LAYOUT), path)
    return _outcomes(read_table(spark, f"{path}/out"), read_table(spark, f"{path}/errors"))


@query("""
    SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS times, 0 AS broken
    FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0
    UNION ALL SELECT NULL, 'errors', NULL, (SELECT count(*) + count(*) FILTER (event_id % 3 = 0) FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0)
""")
def streams_share_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, one of them once more from a fresh checkpoint, and a batch task write into the same tables."""
    path = scratch(spark, "shared")
    lines = _odd_ids(spark, sf_dir)
    task = {
        "job_name": "shared", "column_name_map": MAPPING, "layout": LAYOUT,
        "schema": [{"name": "id", "type": "INTEGER"}, {"name": "kind", "type": "STRING"}],
        "targets": [{"bigquery": {"target_table": f"{path}/out"}}], "error": {"error_table": f"{path}/errors"},
    }
    for part in range(3):
        write_lines(lines.where(F.col("event_id") % 3 == part).select("value"), f"{path}/in{part}")
    for part, checkpoint in ((0, "a"), (1, "b"), (0, "c")):
        stream = task | {"task_name": f"stream {part}", "input_processor": "JsonFlattenStreamingProcessor", "data_file": f"{path}/in{part}"}
        run_stream_task(spark, stream, f"{path}/{checkpoint}", available_now=True).awaitTermination()
    run_task(spark, task | {"task_name": "batch", "input_processor": "JsonFlattenBatchProcessor", "data_file": f"{path}/in2"})
    rows = read_table(spark, f"{path}/out").groupBy("id", "kind").agg(F.count("*").alias("times"))
    errors = read_table(spark, f"{path}/errors").agg(F.count("*").alias("broken"))
    return rows.select("id", "kind", "times", F.lit(0).cast("bigint").alias("broken")).unionByName(
        errors.select(F.lit(None).cast("bigint").alias("id"), F.lit("errors").alias("kind"), F.lit(None).cast("bigint").alias("times"), "broken")
    )


@query("""
    SELECT l_orderkey AS orderkey, l_linenumber AS line,
           CASE WHEN bad THEN NULL ELSE CAST(l_partkey AS BIGINT) END AS part, CASE WHEN bad THEN NULL ELSE l_returnflag END AS flag,
           CASE WHEN bad THEN NULL ELSE l_quantity > 25 END AS many, bad
    FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) = 7 AS bad FROM lineitem)
""")
def nested_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs in a list, declared in an order of their own: one leaf is bad in orders of seven lines, one field is absent."""
    item = table(spark, sf_dir, "lineitem")
    part = F.when(F.col("l_linenumber") == 7, F.lit("none")).otherwise(F.col("l_partkey").cast("string"))
    line = F.struct(F.col("l_linenumber").alias("line"), part.alias("part"), F.col("l_returnflag").alias("flag"), (F.col("l_quantity") > 25).alias("many"))
    orders = item.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.collect_list(line).alias("lines"))
    declared = declared_schema([
        {"name": "orderkey", "type": "INTEGER"},
        {"name": "lines", "type": "RECORD", "mode": "REPEATED", "fields": [
            {"name": "part", "type": "INTEGER"}, {"name": "many", "type": "BOOLEAN"}, {"name": "flag", "type": "STRING"},
            {"name": "absent", "type": "FLOAT"}, {"name": "line", "type": "INTEGER"}]},
    ])
    parts = split(conform(orders, declared))
    good = parts.valid.select("orderkey", F.explode("lines").alias("l"))
    good = good.select("orderkey", "l.line", "l.part", "l.flag", "l.many", F.lit(False).alias("bad"))
    bad = parts.invalid.select(F.from_json("error_record", "orderkey bigint, lines array<struct<line: bigint>>").alias("r"))
    bad = bad.select("r.orderkey", F.explode("r.lines.line").alias("line"), *[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in ("part", "flag", "many")], F.lit(True).alias("bad"))
    return good.unionByName(bad)


@query("""
    SELECT 1 AS load, count(*) AS rows FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 2, 0
    UNION ALL SELECT 3, count(*) FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 4, 0
""")
def incremental_after_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that is empty for one load does not start over."""
    path = scratch(spark, "incremental-empty")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    middle = int(orders.agg(F.max("o_orderkey")).first()[0]) // 2
    task = {
        "job_name": "orders", "task_name": "now and then", "input_processor": "BigQueryProcessor",
        "source_db": {"query": "SELECT * FROM weirgate_fitful", "incremental_mode": {"column_name": "o_orderkey", "column_datatype": "INTEGER"}},
        "targets": [{"bigquery": {"target_table": f"{path}/out"}}], "audit": {"required": True, "job_audit_table": f"{path}/audit"},
    }
    results = []
    for rows in (orders.where(F.col("o_orderkey") <= middle), orders.where("false"), orders, orders):
        rows.createOrReplaceTempView("weirgate_fitful")
        results.append(run_task(spark, task))
    return spark.createDataFrame([(i + 1, r.target_rows) for i, r in enumerate(results)], "load int, rows bigint")


@query("SELECT o_orderkey, 1 AS times FROM orders")
def incremental_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of a growing table whose rows tie with the bound, or have no value, before and after: each row comes once."""
    path = scratch(spark, "incremental-ties")
    day = F.when(F.col("o_orderkey") % 11 > 0, F.date_trunc("month", "o_orderdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    last = orders.agg(F.max("day")).first()[0]
    early = (F.col("day") < last) | (F.col("o_orderkey") % 2 == 0)
    task = {
        "job_name": "orders", "task_name": "monthly", "input_processor": "BigQueryProcessor",
        "source_db": {"query": "SELECT * FROM weirgate_ties", "incremental_mode": {"column_name": "day", "column_datatype": "TIMESTAMP"}},
        "targets": [{"bigquery": {"target_table": f"{path}/out"}}], "audit": {"required": True, "job_audit_table": f"{path}/audit"},
    }
    for rows in (orders.where(F.col("day") < F.lit(last)), orders.where(early), orders.where("false"), orders, orders):
        rows.createOrReplaceTempView("weirgate_ties")
        run_task(spark, task)
    return read_table(spark, f"{path}/out").groupBy("o_orderkey").agg(F.count("*").cast("int").alias("times"))


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS market
    FROM customer
""")
def csv_odd_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headers behind blank lines, in folders whose names hold blanks and brackets."""
    path = scratch(spark, "csv paths [x]")
    rows = table(spark, sf_dir, "customer")
    for part, name in ((0, "segment"), (1, "market")):
        lines = rows.where(F.col("c_custkey") % 2 == part).select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment").alias("value"))
        write_lines(lines, f"{path}/part {part} 100%", ["", " ", f"c_custkey,{name}"])
    found = split(delimited.delimited_scan(spark, delimited.as_path(path) + "/*", extra_columns=0)).valid
    return found.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "segment", "market")


@query("""
    SELECT o_orderkey, c_name FROM orders
    LEFT JOIN (SELECT CAST(c_nationkey AS BIGINT) AS nation, max_by(c_name, c_custkey) AS c_name FROM customer GROUP BY ALL) ON o_custkey % 25 = nation
""")
def enrichment_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup with several rows per key: without an order the task fails, with one the last row counts."""
    path = scratch(spark, "duplicates")
    table(spark, sf_dir, "orders").createOrReplaceTempView("weirgate_lookup_orders")
    table(spark, sf_dir, "customer").createOrReplaceTempView("weirgate_lookup_customer")
    task = {
        "job_name": "lookup", "task_name": "duplicates", "input_processor": "query",
        "source_db": {"query": "SELECT o_orderkey, CAST(o_custkey % 25 AS BIGINT) AS nation FROM weirgate_lookup_orders"},
        "read_properties": {"query": "SELECT CAST(c_nationkey AS BIGINT) AS nation, c_name, c_custkey FROM weirgate_lookup_customer"},
        "filter_properties": {"join_column": {"nation": "nation"}}, "targets": [{"table": {"target_table": f"{path}/out"}}],
    }
    ordered = task | {"read_properties": task["read_properties"] | {"order_by": ["c_custkey"]}}
    results = run_tasks(spark, [task, ordered])
    if [r.status for r in results] != ["FAILED", "COMPLETED"]:
        raise ValueError(f"unexpected: {results}")
    return read_table(spark, f"{path}/out").select("o_orderkey", "c_name")


@query("SELECT 'In-Progress' AS status, count(*) AS rows, count(*) AS without_end FROM region UNION ALL SELECT 'FAILED', count(*), 0 FROM region")
def failed_runs_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task per region whose source does not exist: each leaves its beginning and its failure."""
    path = scratch(spark, "failed")
    names = [r.r_name for r in table(spark, sf_dir, "region").collect()]
    run_tasks(spark, [
        {"job_name": "failing", "task_name": name, "input_processor": "parquet", "data_file": f"{path}/nothing",
         "targets": [{"table": {"target_table": f"{path}/out"}}], "audit": {"required": True, "job_audit_table": f"{path}/audit"}}
        for name in names
    ])
    return read_table(spark, f"{path}/audit").groupBy("status").agg(
        F.count("*").alias("rows"), F.count_if(F.col("end_ts").isNull()).alias("without_end")
    )


@query("""
    SELECT 'JOB_' || o_orderkey AS job_name, o_orderpriority AS region FROM orders
    WHERE 'JOB_' || o_orderkey = (SELECT min('JOB_' || o_orderkey) FROM orders WHERE o_orderkey::VARCHAR LIKE '2%')
""")
def job_properties_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of the rows whose name matches, of a configuration table that grows with the orders."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("JOB_"), F.col("o_orderkey").cast("string")).alias("job_name"), F.col("o_orderpriority").alias("region"),
        F.lit(None).cast("string").alias("additional_input"),
    )
    return config.first_job(rows, "JOB_2%", "job_name").select("job_name", "region")
