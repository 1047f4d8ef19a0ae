"""Streams over the event table: each runs until its input is used up, then its target is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.catalogue.base import millis, query, scratch, table, write_lines
from weirgate.operators.audit import stream_totals
from weirgate.operators.records import message_ids, split, spread
from weirgate.operators.windows import fixed_windows
from weirgate.plans import run_stream_task
from weirgate.sinks.tables import read_table, write_stream_batch
from weirgate.sinks.text import write_archive, write_windowed_text
from weirgate.sources import messages
from weirgate.streaming import runner
from weirgate.streaming.snapshots import PeriodicLookup

EVENT_MAP = {
    "flat_table_mapping": {
        "id": "event_id|not_null", "kind": "event_type", "happened": "detail_millis|long_to_timestamp", "topic": "topic",
    }
}


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        "event_id", "event_type", F.struct(millis("ts").alias("millis")).alias("detail"),
        F.lit("KAFKA_TOPIC_NAME").alias("topic"),
    )
    text = F.to_json(record)
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return spread(table(spark, sf_dir, "events")).select("event_id", cut.alias("value"))


EVENT_SCHEMA = [{"name": "id", "type": "INTEGER"}, {"name": "kind", "type": "STRING"}, {"name": "happened", "type": "STRING"}]


@query("""
    SELECT event_id AS id, event_type AS kind, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS happened, 'live' AS topic
    FROM events WHERE event_id % 7 <> 0
""")
def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in two lots; the second run takes up where the first ended."""
    path = scratch(spark, "stream")
    task = {
        "job_name": "stream", "task_name": "events", "input_processor": "JsonFlattenStreamingProcessor",
        "data_file": f"{path}/in", "column_name_map": EVENT_MAP, "topic_name": "live",
        "schema": EVENT_SCHEMA,
        "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}],
        "error": {"error_table": f"{path}/errors"},
    }
    lines = _event_lines(spark, sf_dir)
    for lot in (0, 1):
        write_lines(lines.where(F.col("event_id") % 2 == lot).select("value"), f"{path}/in")
        run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/out").select("id", "kind", "happened", "topic")


@query("SELECT 'Invalid Record' AS error_type, 'events' AS kind, count(*) AS errors FROM events WHERE event_id % 7 = 0")
def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-errors")
    write_lines(_event_lines(spark, sf_dir).select("value"), f"{path}/in")
    task = {
        "job_name": "stream", "task_name": "events", "input_processor": "JsonFlattenStreamingProcessor",
        "data_file": f"{path}/in", "column_name_map": EVENT_MAP, "topic_name": "live",
        "schema": EVENT_SCHEMA,
        "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}], "error": {"error_table": f"{path}/errors"},
    }
    run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/errors").groupBy("error_type", F.lit("events").alias("kind")).agg(F.count("*").alias("errors"))


@query("""
    SELECT 'Invalid Record' AS error_type, 'stream' AS job_name,
           '{"event_id":' || event_id || ',"event_type":"' || event_type || '","detail":{"millis":' || epoch_ms(ts) || '},"topic":"KAFKA_TOPIC_NAME"'
           AS error_record
    FROM events WHERE event_id % 7 = 0
""")
def stream_error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records themselves that a stream could not use."""
    path = scratch(spark, "stream-error-records")
    write_lines(_event_lines(spark, sf_dir).select("value"), f"{path}/in")
    task = {
        "job_name": "stream", "task_name": "events", "input_processor": "JsonFlattenStreamingProcessor",
        "data_file": f"{path}/in", "column_name_map": EVENT_MAP, "topic_name": "live", "schema": EVENT_SCHEMA,
        "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}], "error": {"error_table": f"{path}/errors"},
    }
    run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/errors").select("error_type", "job_name", "error_record")


@query("""
    SELECT event_id AS id, event_id % 7 = 0 AS rejected FROM events
""")
def stream_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive holds every line; its ids lead to the rows that came of it."""
    path = scratch(spark, "stream-triage")
    write_lines(_event_lines(spark, sf_dir).select("value"), f"{path}/in")
    task = {
        "job_name": "stream", "task_name": "events", "input_processor": "JsonFlattenStreamingProcessor",
        "data_file": f"{path}/in", "column_name_map": EVENT_MAP, "topic_name": "live", "schema": EVENT_SCHEMA,
        "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}], "gcs_triaging_path": f"{path}/raw",
    }
    run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    raw = spark.read.text(f"{path}/raw").select(
        F.substring_index("value", "\u0001", 1).alias("message"),
        F.regexp_extract("value", "\u0001\\{\"event_id\":(\\d+)", 1).cast("bigint").alias("id"),
    )
    rows = read_table(spark, f"{path}/out").select(F.col("RawMessageId").alias("message"), F.col("id").alias("found"))
    joined = raw.join(rows, "message", "left")
    return joined.where("found IS NULL OR found = id").select("id", F.col("found").isNull().alias("rejected"))


MESSAGE_LAYOUT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])


def _message_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The events as a stream of (key, value, timestamp); every eleventh is no JSON."""
    text = F.to_json(F.struct("event_id", "event_type"))
    bad = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("!"), text)).otherwise(text)
    rows = spread(table(spark, sf_dir, "events")).select(
        F.lit(b"").alias("key"), bad.cast("binary").alias("value"), F.col("ts").alias("timestamp")
    )
    rows.write.parquet(path)
    return runner.stream_table(spark, path, rows.schema)


@query("""
    SELECT event_id, event_type, strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start
    FROM events WHERE event_id % 11 <> 0
""")
def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in windows of half a minute, each message judged by itself."""
    path = scratch(spark, "messages")
    windowed = fixed_windows(_message_stream(spark, sf_dir, f"{path}/in"), "timestamp", 0.5)
    tagged = messages.json_messages(windowed, "subscription", MESSAGE_LAYOUT)
    task = {"job_name": "messages", "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}]}
    runner.start(tagged, runner.fan_out(task, "job"), f"{path}/checkpoint", available_now=True).awaitTermination()
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return read_table(spark, f"{path}/out").select("event_id", "event_type", start)


@query("""
    SELECT event_id, event_type, strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end
    FROM events WHERE event_id % 11 <> 0
""")
def stream_windowing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task whose messages are put into windows by its ``windowing_time``, in minutes."""
    path = scratch(spark, "windowing-time")
    schema = _message_stream(spark, sf_dir, f"{path}/in").schema
    task = {
        "job_name": "messages", "task_name": "windows", "input_processor": "PubsubProcessor", "input_subscription": "subscription",
        "messages": {"format": "parquet", "schema": schema, "options": {"path": f"{path}/in"}}, "windowing_time": "0.5",
        "layout": MESSAGE_LAYOUT, "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}],
    }
    run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    ends = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")]
    return read_table(spark, f"{path}/out").select("event_id", "event_type", *ends)


@query("SELECT event_id, 1 AS times FROM events")
def stream_merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of many small micro-batches whose folders are merged as they grow old; one of them is written once more."""
    path = scratch(spark, "merged-batches")
    events = table(spark, sf_dir, "events").select("event_id")
    events.repartition(20).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    target = {"target_table": f"{path}/out", "merge_batches": 4}

    def write(batch: DataFrame, batch_id: int) -> None:
        write_stream_batch(batch, target, batch_id)
        if batch_id == 2:
            write_stream_batch(batch, target, batch_id)

    runner.start(stream, write, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/out").groupBy("event_id").agg(F.count("*").cast("int").alias("times"))


@query("""
    SELECT 'stream' AS job_name, 'events' AS task_name, count(*) AS messages, count(*) AS src_rec_count,
           count(*) FILTER (event_id % 7 <> 0) AS tgt_rec_count, count(*) FILTER (event_id % 7 = 0) AS err_rec_count
    FROM events
""")
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream that runs in two lots, from the audit rows of its micro-batches."""
    path = scratch(spark, "stream-audit")
    task = {
        "job_name": "stream", "task_name": "events", "input_processor": "JsonFlattenStreamingProcessor",
        "data_file": f"{path}/in", "column_name_map": EVENT_MAP, "topic_name": "live", "schema": EVENT_SCHEMA, "files_per_batch": 2,
        "targets": [{"bigquery_stream": {"target_table": f"{path}/out"}}],
        "audit": {"required": True, "job_audit_table": f"{path}/audit"},
    }
    lines = _event_lines(spark, sf_dir)
    for lot in (0, 1):
        write_lines(lines.where(F.col("event_id") % 2 == lot).select("value").coalesce(3), f"{path}/in")
        run_stream_task(spark, task, f"{path}/checkpoint", available_now=True).awaitTermination()
    totals = stream_totals(read_table(spark, f"{path}/audit_stream"))
    return totals.select("job_name", "task_name", "messages", "src_rec_count", "tgt_rec_count", "err_rec_count")


@query("SELECT event_id, CAST(NULL AS VARCHAR) AS comment FROM events WHERE event_id % 11 <> 0")
def stream_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns the target does not know are dropped, missing ones are NULL; a batch written twice counts once."""
    path = scratch(spark, "stream-table")
    tagged = messages.json_messages(_message_stream(spark, sf_dir, f"{path}/in"), "subscription", MESSAGE_LAYOUT)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("comment", T.StringType())])
    target = {"target_table": f"{path}/out", "schema": schema}

    def write_twice(batch: DataFrame, batch_id: int) -> None:
        valid = split(batch).valid
        write_stream_batch(valid, target, batch_id)
        write_stream_batch(valid, target, batch_id)

    runner.start(tagged, write_twice, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/out").select("event_id", "comment")


@query("""
    SELECT strftime(make_timestamp(CAST(epoch_us(ts) // 18000000000 * 18000000000 AS BIGINT)), '%Y_%m_%d_%H_%M') AS window_start, count(*) AS lines,
           count(*) AS well_formed, true AS small_files
    FROM events GROUP BY ALL
""")
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages with their ids, in windows of 300 minutes."""
    path = scratch(spark, "archive")
    stream = _message_stream(spark, sf_dir, f"{path}/in")
    lines = message_ids(stream.withColumn("payload", F.col("value").cast("string")))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_archive(batch, "timestamp", "RawMessageId", "payload", f"{path}/out/batch={batch_id}", mode="overwrite")

    runner.start(lines, write, f"{path}/checkpoint", available_now=True).awaitTermination()
    shape = "^[0-9a-f-]{36}_[0-9_:. -]+\\x01!?\\{.*\\}$"
    files = spark.read.text(f"{path}/out").groupBy("window_start", F.input_file_name()).agg(
        F.count("*").alias("lines"), F.count_if(F.col("value").rlike(shape)).alias("well_formed")
    )
    return files.groupBy(F.col("window_start").cast("string").alias("window_start")).agg(
        F.sum("lines").alias("lines"), F.sum("well_formed").alias("well_formed"), (F.max("lines") <= 1000).alias("small_files")
    )


@query("""
    SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y_%m_%d_%H_%M') AS window_start,
           strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, '%Y_%m_%d_%H_%M') AS window_end,
           count(*) AS lines, true AS small_files
    FROM events GROUP BY ALL
""")
def windowed_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "windowed-text")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    write_windowed_text(events, "ts", path, minutes=1440)
    files = spark.read.text(path).groupBy("window_start", "window_end", F.input_file_name()).agg(F.count("*").alias("lines"))
    return files.groupBy("window_start", "window_end").agg(F.sum("lines").alias("lines"), (F.max("lines") <= 1000).alias("small_files"))



def _middle(events: DataFrame):
    seconds = (F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2
    return events.agg(F.timestamp_micros(seconds.cast("bigint"))).first()[0]


@query("""
    SELECT strftime(time_bucket(INTERVAL 60 MINUTE, ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS messages
    FROM events
    WHERE time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM events)
    GROUP BY ALL
""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second lot repeats old events, whose windows are closed: they are dropped."""
    path = scratch(spark, "late")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    middle = F.lit(_middle(events))
    first, second = events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)
    repeated = first.where((F.col("event_id") % 3 == 0) & (F.col("ts") < middle - F.expr("INTERVAL 1 DAY")))
    for lot in (first, second.unionByName(repeated)):
        lot.write.mode("append").parquet(f"{path}/in")
        stream = runner.stream_table(spark, f"{path}/in", events.schema)
        runner.start_window_counts(stream, "ts", f"{path}/out", f"{path}/checkpoint", 60, available_now=True).awaitTermination()
    counts = spark.read.parquet(f"{path}/out")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "messages")


@query("""
    SELECT event_id, user_id, c_name || CASE WHEN event_id % 3 = 2 THEN '/2' ELSE '/0' END AS c_name
    FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def lookup_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup changes with each of three lots, of which the second comes within the period of the first one."""
    path = scratch(spark, "by-period")
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    clock = {"now": 0.0}
    lookup = PeriodicLookup(lambda s: s.read.parquet(f"{path}/lookup"), f"{path}/versions", 100, lambda: clock["now"])
    enrich = runner.enrich_by_period(lookup, {"user_id": "c_custkey"}, ["c_custkey"])

    def write(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):  # a batch that runs again
            write_stream_batch(enrich(batch, batch_id), {"target_table": f"{path}/out"}, batch_id)
            clock["now"] += 0.0 if batch_id == 0 else 500.0

    for lot, now in enumerate((0.0, 99.0, 2000.0)):
        customer.withColumn("c_name", F.concat("c_name", F.lit(f"/{lot}"))).write.mode("overwrite").parquet(f"{path}/lookup")
        clock["now"] = now
        rows = events.where(F.col("event_id") % 3 == lot).select("event_id", "user_id")
        rows.coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = runner.stream_table(spark, f"{path}/in", rows.schema)
        runner.start(stream, write, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/out").select("event_id", "user_id", "c_name")


@query("""
    SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN c_name ELSE upper(c_name) END AS c_name
    FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def lookup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup table changes between two lots; each micro-batch reads it anew."""
    path = scratch(spark, "refresh")
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    enrich = runner.enrich_batch(lambda s: s.read.parquet(f"{path}/lookup").drop("version"), {"user_id": "c_custkey"},
                                 ["c_custkey"])

    def write(batch: DataFrame, batch_id: int) -> None:
        write_stream_batch(enrich(batch), {"target_table": f"{path}/out"}, batch_id)

    for lot, lookup in ((0, customer), (1, customer.withColumn("c_name", F.upper("c_name")))):
        lookup.write.mode("overwrite").parquet(f"{path}/lookup")
        rows = events.where(F.col("event_id") % 2 == lot).select("event_id", "user_id")
        rows.write.mode("append").parquet(f"{path}/in")
        stream = runner.stream_table(spark, f"{path}/in", rows.schema)
        runner.start(stream, write, f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{path}/out").select("event_id", "user_id", "c_name")


