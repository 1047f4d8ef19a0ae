"""Scans: files of all formats, messages, queries and configuration tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.catalogue.base import millis, query, scratch, table, write_lines
from weirgate.operators.audit import count_per_source
from weirgate.operators.records import ERROR, SOURCE, split, spread
from weirgate.operators.windows import number_within
from weirgate.schema import conform, declared_schema
from weirgate.sources import api, config, database, delimited, files, messages

def _customer_line() -> Column:
    key = F.col("c_custkey").cast("string")
    segment = F.when(F.col("c_custkey") % 7 == 0, "Null").when(F.col("c_custkey") % 11 == 0, "")
    return F.concat_ws(
        ",", key,
        F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit(', ""no"" ')), F.lit('"')),
        F.when(F.col("c_nationkey") % 5 == 0, "-1").otherwise(F.col("c_nationkey").cast("string")),
        segment.otherwise(F.col("c_mktsegment")),
        F.concat("c_mktsegment", F.lit("\\,"), key),
    )


@query("""
    SELECT c_custkey, replace(c_name, '#', ', "no" ') AS c_name,
           CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment,
           c_mktsegment || ',' || c_custkey AS remark
    FROM customer
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").select(_customer_line().alias("value"))
    path = write_lines(lines, scratch(spark, "csv"),
                       ["export of customers", "", "c_custkey,c_name,c_nationkey,c_mktsegment,remark"])
    rows = delimited.delimited_scan(spark, path, skip_rows=2, extra_columns=0)
    return split(rows).valid.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment", "remark",
    )


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id,
           CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment,
           CASE WHEN c_custkey % 3 = 2 THEN c_name END AS column_3,
           CASE WHEN c_custkey % 3 = 2 THEN '' END AS column_4
    FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL FROM supplier
""")
def csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    line = (
        F.when(F.col("c_custkey") % 3 == 0, key)
        .when(F.col("c_custkey") % 3 == 1, F.concat_ws(",", key, "c_mktsegment"))
        .otherwise(F.concat_ws(",", key, "c_mktsegment", "c_name", F.lit("")))
    )
    path = scratch(spark, "ragged")
    write_lines(table(spark, sf_dir, "customer").select(line), f"{path}/a", ["id,segment"])
    supplier = table(spark, sf_dir, "supplier").select(F.concat_ws(",", "s_name", F.col("s_suppkey").cast("string")))
    write_lines(supplier, f"{path}/b", ["segment,id"])
    rows = delimited.delimited_scan(spark, [f"{path}/a", f"{path}/b"])
    return split(rows).valid.select("id", "segment", "column_3", "column_4")


@query("""
    SELECT '"open ' || o_orderkey || ',x' AS error_record, 'Invalid Record' AS error_type, 'orders' AS job_name
    FROM orders WHERE o_orderkey % 50 = 0
    UNION ALL
    SELECT o_orderkey || ',b,c,d', 'Invalid Record', 'orders' FROM orders WHERE o_orderkey % 50 = 1
""")
def csv_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    line = (
        F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit('"open '), key, F.lit(",x")))
        .when(F.col("o_orderkey") % 50 == 1, F.concat(key, F.lit(",b,c,d")))
        .otherwise(F.concat_ws(",", key, "o_orderstatus"))
    )
    path = write_lines(table(spark, sf_dir, "orders").select(line), scratch(spark, "csv-bad"), ["key,status"])
    rows = delimited.delimited_scan(spark, path, extra_columns=0)
    errors = split(rows, "orders").invalid
    return errors.select("error_record", "error_type", "job_name")


@query("""
    SELECT p_partkey, p_name || chr(10) || p_type AS note, p_size FROM part
""")
def csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = scratch(spark, "multi-line")
    part.select("p_partkey", F.concat_ws("\n", "p_name", "p_type").alias("note"), "p_size").write.csv(path, header=True)
    rows = split(delimited.delimited_scan(spark, path, multi_line=True)).valid
    return rows.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "note", F.col("p_size").cast("int").alias("p_size"))


#: Bytes of the blocks of a large file, few, so that it has many.
BLOCK = 1 << 15


@query("""
    SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '"' || o_orderstatus || '",' || chr(13) || chr(10) || 'x'
           WHEN o_orderkey % 3 = 1 THEN ' "quoted"' ELSE '' END AS note, o_orderdate::DATE AS day
    FROM orders
""")
def csv_quoted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file whose records have line breaks and cross the blocks it is read in."""
    orders = table(spark, sf_dir, "orders")
    lines = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('\n""'), "o_orderstatus", F.lit('"",\r\nx"'))).when(
        F.col("o_orderkey") % 3 == 1, F.lit(' "quoted"')
    ).otherwise("")
    opened = F.when(F.col("o_orderkey") % 3 == 0, '"').otherwise("")
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(","), opened, "o_orderpriority", lines, F.lit(","), F.to_date("o_orderdate").cast("string"))
    path = write_lines(orders.select(line).coalesce(1), scratch(spark, "quoted-blocks"), ["o_orderkey,note,day"])
    rows = split(delimited.delimited_scan(spark, path, multi_line=True, block_bytes=BLOCK)).valid
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "note", F.col("day").cast("date").alias("day"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def json_root_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Documents of at most 500 records whatever the keys are, one per file.
    customer = table(spark, sf_dir, "customer").withColumn("all", F.lit(1))
    numbered = number_within(customer, ["all"], "number")
    record = F.struct("c_custkey", "c_name", "c_nationkey")
    documents = numbered.groupBy(F.floor(F.col("number") / 500).alias("block")).agg(F.collect_list(record).alias("data"))
    path = scratch(spark, "json-root")
    documents.select("block", F.to_json(F.struct("data")).alias("value")).write.partitionBy("block").text(path)
    rows = split(files.json_scan(spark, path, root="data")).valid
    return rows.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query("SELECT event_id, event_type, props, value FROM events")
def json_large_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document, whose list is cut into elements by many tasks."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props", "value")
    elements = events.select(F.concat(F.lit(","), F.to_json(F.struct("*"))).alias("value")).coalesce(1)
    first, last = '{"about": {"list": [1, "],"]}, "rows": [null', '], "more": {}}'
    path = write_lines(elements, scratch(spark, "json-large"), [first], [last])
    rows = split(files.json_scan(spark, path, root="rows", block_bytes=BLOCK)).valid
    return rows.select("event_id", "event_type", "props", "value")


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return spread(table(spark, sf_dir, "events")).select(cut.alias("value"))


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 7 <> 0")
def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_event_lines(spark, sf_dir), scratch(spark, "ndjson"))
    return split(files.ndjson_scan(spark, path)).valid.select("event_id", "user_id", "event_type", "value")


@query("""
    SELECT 'load' AS job_name, 'j1' AS job_id, 'Invalid Record' AS error_type, 'events_table' AS target_table,
           '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"' AS error_record,
           true AS has_source, true AS has_time
    FROM events WHERE event_id % 7 = 0
""")
def invalid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct("event_id", "user_id", "event_type"))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    path = write_lines(table(spark, sf_dir, "events").select(cut), scratch(spark, "ndjson-bad"))
    layout = T.StructType([T.StructField("event_id", T.LongType())])
    errors = split(files.ndjson_scan(spark, path, layout=layout), "load", "j1", "events_table").invalid
    return errors.select(
        "job_name", "job_id", "error_type", "target_table", "error_record",
        F.col("source_name").contains("/").alias("has_source"), F.col("insert_ts").isNotNull().alias("has_time"),
    )


@query("""
    SELECT lang, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS line_count
    FROM (SELECT lang, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents)
    GROUP BY lang
""")
def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "lines")
    table(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    counts = count_per_source(files.line_scan(spark, path))
    lang = F.regexp_extract(SOURCE, "lang=([^/]+)", 1).alias("lang")
    return counts.groupBy(lang).agg(F.sum("rows").alias("line_count"))


@query("""
    SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'n' ELSE s_name END AS s_name,
           CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END AS s_nationkey,
           'sales.stock.supplier' AS source_name
    FROM supplier
""")
def unload_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(
        ",", F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 4 == 0, "n").otherwise(F.col("s_name")),
        F.when(F.col("s_suppkey") % 6 == 0, "N").when(F.col("s_suppkey") % 3 == 0, "n")
        .otherwise(F.col("s_nationkey").cast("string")),
    )
    path = write_lines(table(spark, sf_dir, "supplier").select(line), scratch(spark, "unload"))
    schema = declared_schema({"fields": [
        {"name": "s_suppkey", "type": "INTEGER"}, {"name": "s_name", "type": "STRING"},
        {"name": "s_nationkey", "type": "INTEGER"},
    ]})
    rows = split(delimited.unload_scan(spark, path, schema, "sales.stock.supplier")).valid
    return rows.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name",
                       F.col("s_nationkey").cast("int").alias("s_nationkey"), SOURCE)


@query("""
    SELECT doc_id, CASE WHEN doc_id % 10 <> 0 AND doc_id % 10 <> 1 THEN n_chars END AS n_chars,
           CASE WHEN doc_id % 10 <> 0 AND doc_id % 10 <> 1 THEN lang END AS lang,
           CASE WHEN doc_id % 10 = 0 THEN 'n_chars is not of type bigint'
                WHEN doc_id % 10 = 1 THEN 'lang column cannot be Null' END AS problem
    FROM documents
""")
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("about "), F.col("n_chars").cast("string")))
        .otherwise(F.col("n_chars").cast("string")).alias("n_chars"),
        F.when(F.col("doc_id") % 10 != 1, F.col("lang")).alias("lang"),
    )
    schema = declared_schema([
        {"name": "doc_id", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "n_chars", "type": "integer"},
        {"name": "lang", "type": "String", "mode": "REQUIRED"},
    ])
    rows = conform(texts, schema)
    good = F.col(ERROR).isNull()
    return rows.select("doc_id", F.when(good, F.col("n_chars")).alias("n_chars"), F.when(good, F.col("lang")).alias("lang"),
                       F.col(f"{ERROR}.desc").alias("problem"))


PART_XML = T.StructType([
    T.StructField("@key", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("tag", T.ArrayType(T.StringType())),
])


def _part_xml() -> Column:
    return F.format_string(
        '<part key="%s"><name>%s</name><tag>%s</tag><tag>%s</tag></part>', F.col("p_partkey").cast("string"), "p_name",
        "p_brand", "p_type",
    )


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS part_key, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS name,
           CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS tag_1, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS tag_2,
           CASE WHEN p_partkey % 9 = 0 THEN 'Invalid Xml' END AS problem
    FROM part
""")
def xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _part_xml()
    broken = F.when(F.col("p_partkey") % 9 == 0, F.replace(text, F.lit("</name>"), F.lit(""))).otherwise(text)
    texts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part_key"), broken.alias("value"))
    rows = files.xml_rows(texts, PART_XML)
    good = F.col(ERROR).isNull()
    return rows.select(
        "part_key", F.when(good, F.col("name")).alias("name"), F.when(good, F.col("tag")[0]).alias("tag_1"),
        F.when(good, F.col("tag")[1]).alias("tag_2"), F.col(f"{ERROR}.type").alias("problem"),
    )


@query("SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS name, p_brand AS tag_1, p_type AS tag_2 FROM part")
def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(table(spark, sf_dir, "part").select(_part_xml()), scratch(spark, "xml"), ["<parts>"], ["</parts>"])
    rows = split(files.xml_scan(spark, path, "part", PART_XML)).valid
    return rows.select(F.col("`@key`").alias("part_key"), "name", F.col("tag")[0].alias("tag_1"), F.col("tag")[1].alias("tag_2"))


@query("""
    SELECT o_orderkey, o_custkey AS buyer_key, o_orderstatus AS buyer_status, CAST(o_orderkey % 3 AS BIGINT) AS part_count,
           true AS has_source
    FROM orders
""")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = scratch(spark, "nested")
    orders.select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("key"), F.struct("o_orderstatus").alias("state")).alias("buyer"),
        F.sequence(F.lit(0), F.col("o_orderkey") % 3).alias("parts"),
    ).write.parquet(path)
    rows = split(files.parquet_scan(spark, path)).valid
    return rows.select(
        "o_orderkey", F.col("buyer.key").alias("buyer_key"), F.col("buyer.state.o_orderstatus").alias("buyer_status"),
        (F.size("parts") - 1).cast("bigint").alias("part_count"), F.col(SOURCE).contains(".parquet").alias("has_source"),
    )


def _nested_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.transform(
        F.sequence(F.lit(1), F.col("o_orderkey") % 3 + 1), lambda i: F.struct(i.alias("no"), (F.col("o_custkey") * i).alias("qty"))
    )
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderpriority").alias("priority")).alias("info")).alias("buyer"),
        items.alias("items"), F.array("o_orderstatus").alias("marks"),
        millis("o_orderdate").alias("placed"),
    )
    return spread(table(spark, sf_dir, "orders")).select(F.to_json(record).alias("value"))


ORDER_MAP = {
    "constants": {"version": "1"},
    "flat_table_mapping": {
        "order_id": "id|not_null", "priority": "buyer_info_priority", "item_no": "items_no", "qty": "items_qty",
        "mark": "marks", "placed_at": "placed|not_null,long_to_timestamp", "absent": "nowhere",
    },
}

ORDER_ROWS = """
    SELECT o_orderkey AS order_id, o_orderpriority AS priority, i.no AS item_no, CAST(o_custkey * i.no AS BIGINT) AS qty,
           o_orderstatus AS mark, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS placed_at, CAST(NULL AS VARCHAR) AS absent
    FROM orders JOIN (SELECT unnest([1, 2, 3]) AS no) i ON i.no <= o_orderkey % 3 + 1
"""


@query(f"SELECT *, true AS same_name, true AS has_id FROM ({ORDER_ROWS})")
def flatten_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_nested_order_lines(spark, sf_dir), scratch(spark, "flatten"))
    rows = split(files.flatten_json_scan(spark, path, ORDER_MAP)).valid
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}_\\d{4}-\\d\\d-\\d\\d_\\d\\d:\\d\\d:\\d\\d\\.\\d{6}$"
    return rows.select(
        "order_id", "priority", "item_no", "qty", "mark", "placed_at", "absent",
        (F.col("FileName") == F.col(SOURCE)).alias("same_name"), F.col("RawMessageId").rlike(shape).alias("has_id"),
    )


@query("""
    SELECT 'https://api.example.org/v1/suppliers?nation=' || s_nationkey || '&id=' || s_suppkey AS source_name,
           s_suppkey AS id, s_name AS profile_name, t.x AS tags
    FROM supplier, (SELECT unnest(['a', 'b']) AS x) t WHERE s_suppkey % 5 <> 0
""")
def api_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(api.response_rows(_responses(spark, sf_dir), root="data")).valid.select(SOURCE, "id", "profile_name", "tags")


@query("""
    SELECT 'https://api.example.org/v1/suppliers?nation=' || s_nationkey || '&id=' || s_suppkey AS source_name,
           'Invalid Record' AS error_type
    FROM supplier WHERE s_suppkey % 5 = 0
""")
def api_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(api.response_rows(_responses(spark, sf_dir), root="data")).invalid.select(SOURCE, "error_type")


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses about suppliers; every fifth payload is a list."""
    record = F.struct(
        F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("name")).alias("profile"),
        F.array(F.lit("a"), F.lit("b")).alias("tags"),
    )
    payload = F.when(F.col("s_suppkey") % 5 == 0, F.to_json(F.array(record))).otherwise(F.to_json(record))
    params = F.array(
        F.concat(F.lit("nation="), F.col("s_nationkey").cast("string")), F.concat(F.lit("id="), F.col("s_suppkey").cast("string"))
    )
    return table(spark, sf_dir, "supplier").select(
        api.resolved_url("https://api.example.org/v1/suppliers", params).alias("url"),
        F.concat(F.lit('{"status":"ok","data":'), payload, F.lit("}")).alias("body"),
    )


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value, timestamp); every eleventh value is no JSON."""
    text = F.to_json(F.struct("event_id", "event_type", F.col("props")))
    bad = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("!"), text)).otherwise(text)
    return spread(table(spark, sf_dir, "events")).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), bad.cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )


@query("""
    SELECT event_id, event_type, props, 'events-topic' AS source_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS sent
    FROM events WHERE event_id % 11 <> 0
""")
def message_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split(messages.json_messages(_event_messages(spark, sf_dir), "events-topic")).valid
    sent = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("sent")
    return rows.select("event_id", "event_type", "props", SOURCE, sent)


@query("""
    SELECT 'Invalid Json' AS error_type, 'events-topic' AS source_name, props
    FROM events WHERE event_id % 11 = 0
""")
def message_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = split(messages.json_messages(_event_messages(spark, sf_dir), "events-topic")).invalid
    text = F.regexp_extract("error_record", '"props":"(.*)"}$', 1)
    props = F.replace(text, F.lit('\\"'), F.lit('"'))
    return errors.select("error_type", SOURCE, props.alias("props"))


@query("SELECT event_id AS id, event_type AS kind, 'events-topic' AS source_name FROM events WHERE event_id % 11 <> 0")
def message_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"flat_table_mapping": {"id": "event_id|not_null", "kind": "event_type"}}
    return split(messages.flatten_messages(_event_messages(spark, sf_dir), "events-topic", mapping)).valid.select("id", "kind", SOURCE)


@query("""
    SELECT o_orderstatus, count(*) AS orders, CAST(max(o_orderkey) AS BIGINT) AS last_key, 'warehouse.orders' AS source_name
    FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderstatus
""")
def warehouse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("weirgate_orders")
    rows = database.query_scan(
        spark,
        "SELECT o_orderstatus, count(*) AS orders, max(o_orderkey) AS last_key FROM IDENTIFIER(:name) "
        "WHERE o_orderpriority = '##level##' AND o_orderdate >= :since GROUP BY o_orderstatus",
        "warehouse.orders", {"name": "weirgate_orders", "since": "1996-01-01"}, {"level": "5-LOW"},
    )
    return split(rows).valid


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'override' ELSE p_brand END AS brand,
           CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS size
    FROM part WHERE p_type || '_' || p_name LIKE 'ECONOMY%ring'
""")
def config_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(F.col("p_partkey") % 2 == 0, F.format_string('{"brand":"override","size":%d}', "p_size"))
    tasks = table(spark, sf_dir, "part").select(
        F.concat_ws("_", "p_type", "p_name").alias("task_id"), "p_partkey", F.col("p_brand").alias("brand"),
        more.alias("additional_input"),
    )
    rows = config.merged_properties(config.matching_config(tasks, "task_id", "ECONOMY%ring"))
    found = F.col("properties")
    return rows.select(found["p_partkey"].cast("bigint").alias("p_partkey"), found["brand"].alias("brand"), found["size"].alias("size"))
