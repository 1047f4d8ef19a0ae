"""Counts, audit rows and whole tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.catalogue.base import query, scratch, table
from weirgate.operators import shape
from weirgate.operators.audit import counted, file_audit_rows, file_counts, grouped_counts, job_audit_row, job_counts
from weirgate.operators.records import ERROR, SOURCE, as_tagged, error_when
from weirgate.plans import run_task, run_tasks
from weirgate.plans.registry import sink, source
from weirgate.sinks.tables import read_table, write_table


def _tagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("event_id") % 7 == 0
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias(SOURCE), error_when(bad, "Invalid Record", "multiple of seven", F.col("props")).alias(ERROR)
    )


@query("""
    SELECT count(*) AS src_rec_count, count(*) FILTER (event_id % 7 <> 0) AS tgt_rec_count,
           count(*) FILTER (event_id % 7 = 0) AS err_rec_count
    FROM events
""")
def job_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_counts(_tagged_events(spark, sf_dir))


FILE_COUNTS = """
    SELECT event_type AS source_name, count(*) AS src_rec_count, count(*) FILTER (event_id % 7 <> 0) AS tgt_rec_count,
           count(*) FILTER (event_id % 7 = 0) AS err_rec_count
    FROM events GROUP BY event_type
"""


@query(f"""
    SELECT *, 'j1' AS job_id, 'load' AS job_name, 'events' AS task_name, '{{"bigquery": d.t}}' AS target,
           '{{"bigquery": d.t}}' AS target_name, '2024-01-02 03:04:05' AS load_ts
    FROM ({FILE_COUNTS})
""")
def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = file_counts(_tagged_events(spark, sf_dir))
    targets = [{"bigquery": {"target_table": "d.t"}}]
    rows = file_audit_rows(counts, "j1", "load", "events", targets, datetime(2024, 1, 2, 3, 4, 5))
    return rows.withColumn("load_ts", F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss"))


@query("""
    SELECT event_type AS source_name, count(*) AS src_rec_count,
           CAST(count(*) FILTER (event_id % 7 <> 0 AND event_type <> 'error') AS BIGINT) AS tgt_rec_count,
           count(*) FILTER (NOT (event_id % 7 <> 0 AND event_type <> 'error')) AS err_rec_count
    FROM events GROUP BY event_type
""")
def grouped_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source has error records only."""
    events = table(spark, sf_dir, "events").withColumn(SOURCE, F.col("event_type"))
    good = (F.col("event_id") % 7 != 0) & (F.col("event_type") != "error")
    return grouped_counts(events.where(good), events.where(~good))


@query("""
    SELECT count(*) AS rows_in, CAST(sum(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_linenumber % 3 END) AS BIGINT) AS rows_out
    FROM lineitem
""")
def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after the explode, counted while the result is written."""
    lists = F.when(F.col("l_linenumber") % 3 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.col("l_linenumber") % 3))
    lines = as_tagged(table(spark, sf_dir, "lineitem").select("l_orderkey", lists.alias("n")))
    before, seen_in = counted(lines, f"in-{id(lines)}")
    after, seen_out = counted(shape.explode_lists(before), f"out-{id(lines)}")
    after.drop(ERROR).write.parquet(scratch(spark, "counters"))
    return spark.createDataFrame(
        [(seen_in.get["src_rec_count"], seen_out.get["src_rec_count"])], "rows_in bigint, rows_out bigint"
    )


def _event_task(spark: SparkSession, sf_dir: str) -> tuple[dict, str]:
    """A task over event lines, every seventh of them cut short."""
    path = scratch(spark, "task")
    text = F.to_json(F.struct("event_id", "user_id", "event_type", F.struct(F.col("value").alias("amount")).alias("detail")))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    table(spark, sf_dir, "events").select("event_type", cut.alias("value")).write.partitionBy("event_type").text(f"{path}/in")
    task = {
        "job_name": "events-job", "task_name": "events-task", "job_id": "job-1", "source": "files",
        "input_processor": "JsonFlattenBatchProcessor", "data_file": f"{path}/in",
        "column_name_map": {"flat_table_mapping": {"id": "event_id|not_null", "kind": "event_type", "amount": "detail_amount"}},
        "required_columns": ["ID", "kind", "amount"],
        "targets": [{"bigquery": {"target_table": f"{path}/out", "write_disposition": "write_append"}}],
        "error": {"insert_error_rec": True, "error_table": f"{path}/errors"},
        "audit": {"required": True, "job_audit_table": f"{path}/audit", "file_audit_table": f"{path}/files",
                  "enable_file_level_auditing": False},
    }
    return task, path


@query("SELECT event_id AS id, event_type AS kind, value AS amount FROM events WHERE event_id % 7 <> 0")
def run_task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    task, path = _event_task(spark, sf_dir)
    run_task(spark, task)
    return read_table(spark, f"{path}/out").select("id", "kind", "amount")


@query("""
    SELECT 'events-job' AS job_name, 'job-1' AS job_id, 'Invalid Record' AS error_type, event_type AS kind, count(*) AS errors
    FROM events WHERE event_id % 7 = 0 GROUP BY event_type
""")
def run_task_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    task, path = _event_task(spark, sf_dir)
    run_task(spark, task)
    kind = F.regexp_extract(SOURCE, "event_type=([^/]+)", 1).alias("kind")
    return read_table(spark, f"{path}/errors").groupBy("job_name", "job_id", "error_type", kind).agg(F.count("*").alias("errors"))


@query("""
    SELECT 'In-Progress' AS status, 'events-task' AS task_name, CAST(NULL AS BIGINT) AS src_rec_count,
           CAST(NULL AS BIGINT) AS tgt_rec_count, CAST(NULL AS BIGINT) AS err_rec_count, false AS ended
    UNION ALL
    SELECT 'COMPLETED', 'events-task', count(*), count(*) FILTER (event_id % 7 <> 0), count(*) FILTER (event_id % 7 = 0), true FROM events
""")
def run_task_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    task, path = _event_task(spark, sf_dir)
    run_task(spark, task)
    audit = read_table(spark, f"{path}/audit")
    return audit.select("status", "task_name", "src_rec_count", "tgt_rec_count", "err_rec_count", F.col("end_ts").isNotNull().alias("ended"))


@query(f"SELECT * FROM ({FILE_COUNTS})")
def run_task_file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    task, path = _event_task(spark, sf_dir)
    task["audit"]["enable_file_level_auditing"] = True
    run_task(spark, task)
    kind = F.regexp_extract(SOURCE, "event_type=([^/]+)", 1).alias(SOURCE)
    audit = read_table(spark, f"{path}/files").select(kind, "src_rec_count", "tgt_rec_count", "err_rec_count")
    return audit.groupBy(SOURCE).agg(*[F.sum(c).alias(c) for c in ("src_rec_count", "tgt_rec_count", "err_rec_count")])


@query("""
    SELECT 'a' AS task_name, 'COMPLETED' AS status, count(*) AS target_rows FROM events WHERE event_id % 7 <> 0
    UNION ALL SELECT 'b', 'FAILED', NULL
    UNION ALL SELECT 'c', 'COMPLETED', count(*) FROM events WHERE event_id % 7 <> 0
""")
def run_many_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second task has no input; the others run all the same."""
    first, path = _event_task(spark, sf_dir)
    tasks = [first | {"task_name": "a"}, first | {"task_name": "b", "data_file": f"{path}/nowhere"}, first | {"task_name": "c"}]
    results = run_tasks(spark, tasks)
    return spark.createDataFrame(
        [(r.task_name, r.status, r.target_rows) for r in results], "task_name string, status string, target_rows bigint"
    )


@query("""
    SELECT 'up' AS place, o_orderkey, o_orderstatus FROM orders
    UNION ALL SELECT 'down', o_orderkey, o_orderstatus FROM orders
""")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source, two targets."""
    path = scratch(spark, "fan-out")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.parquet(f"{path}/in")
    run_task(spark, {
        "job_name": "copy", "task_name": "orders", "input_processor": "ParquetProcessor", "data_file": f"{path}/in",
        "targets": [{"bigquery": {"target_table": f"{path}/up"}}, {"bigquery": {"target_table": f"{path}/down"}}],
    })
    up, down = (read_table(spark, f"{path}/{p}").withColumn("place", F.lit(p)) for p in ("up", "down"))
    return up.unionByName(down)


@query("SELECT s_suppkey, upper(s_name) AS s_name FROM supplier WHERE s_suppkey % 2 = 1")
def custom_connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source and a target of the user's own."""
    path = scratch(spark, "custom")

    @source("odd_suppliers")
    def read(session: SparkSession, task: dict) -> DataFrame:
        rows = session.read.parquet(task["data_file"]).withColumn(SOURCE, F.lit("suppliers"))
        return rows.withColumn(ERROR, error_when(F.col("s_suppkey") % 2 == 0, "Invalid Record", "even", F.col("s_name")))

    @sink("shouting")
    def write(df: DataFrame, target: dict, task: dict) -> None:
        write_table(df.withColumn("s_name", F.upper("s_name")), target)

    run_task(spark, {
        "job_name": "custom", "task_name": "suppliers", "input_processor": "odd_suppliers",
        "data_file": f"{sf_dir}/supplier.parquet", "required_columns": ["s_suppkey", "s_name"],
        "targets": [{"shouting": {"target_table": path}}],
    })
    return read_table(spark, path)


@query("""
    SELECT o_orderkey, s_name, CASE WHEN s_suppkey IS NOT NULL THEN s_nationkey ELSE o_orderkey % 30 END AS nation
    FROM orders LEFT JOIN (SELECT s_nationkey, max(s_suppkey) AS s_suppkey, arg_max(s_name, s_suppkey) AS s_name FROM supplier GROUP BY s_nationkey)
      ON s_nationkey = o_orderkey % 30
""")
def enrichment_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task whose records are looked up in a query before they are written."""
    path = scratch(spark, "enriched")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 30).alias("nation"))
    orders.write.parquet(f"{path}/in")
    table(spark, sf_dir, "supplier").createOrReplaceTempView("weirgate_supplier")
    run_task(spark, {
        "job_name": "enrich", "task_name": "orders", "input_processor": "ParquetProcessor", "data_file": f"{path}/in",
        "read_properties": {"query": "SELECT CAST(s_nationkey AS BIGINT) AS nation, s_name, s_suppkey FROM weirgate_supplier",
                            "order_by": ["s_suppkey"]},
        "filter_properties": {"join_column": {"nation": "nation"}}, "required_columns": ["o_orderkey", "s_name", "nation"],
        "targets": [{"bigquery": {"target_table": f"{path}/out"}}],
    })
    return read_table(spark, f"{path}/out").select("o_orderkey", "s_name", "nation")


@query("""
    SELECT count(*) AS src_rec_count, 'COMPLETED' AS status, '{"kafka": out}' AS target FROM orders
""")
def job_audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = job_counts(as_tagged(table(spark, sf_dir, "orders"))).first()
    row = job_audit_row(spark, {"status": "COMPLETED", "target": '{"kafka": out}', **counts.asDict()})
    return row.select("src_rec_count", "status", "target")


@query("""
    SELECT 1 AS load, count(*) AS rows FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 2, count(*) FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)
    UNION ALL SELECT 3, 0
""")
def incremental_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of a growing table; the audit table keeps the bounds."""
    path = scratch(spark, "incremental")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    middle = int(orders.agg(F.max("o_orderkey")).first()[0]) // 2
    task = {
        "job_name": "orders", "task_name": "daily", "input_processor": "BigQueryProcessor",
        "source_db": {"query": "SELECT * FROM weirgate_growing",
                      "incremental_mode": {"column_name": "o_orderkey", "column_datatype": "INTEGER"}},
        "targets": [{"bigquery": {"target_table": f"{path}/out"}}],
        "audit": {"required": True, "job_audit_table": f"{path}/audit"},
    }
    results = []
    for rows in (orders.where(F.col("o_orderkey") <= middle), orders, orders):
        rows.createOrReplaceTempView("weirgate_growing")
        results.append(run_task(spark, task))
    return spark.createDataFrame([(i + 1, r.target_rows) for i, r in enumerate(results)], "load int, rows bigint")


