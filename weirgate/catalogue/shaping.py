"""Explode, flatten, column maps, null rules, ids and text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.catalogue.base import millis, query, table
from weirgate.catalogue.readers import ORDER_MAP, ORDER_ROWS, _nested_order_lines
from weirgate.functions.procedures import register
from weirgate.operators import documents as D
from weirgate.operators import shape
from weirgate.operators.layout import infer
from weirgate.operators.mapping import map_columns, parse_column_map, substitute_tokens
from weirgate.operators.records import (
    ERROR,
    SOURCE,
    archive_line,
    base64_binary,
    drop_source_name,
    message_ids,
    normalise_database_rows,
    null_markers,
    record_json,
    rewrite_source,
    select_required,
    split,
    spread,
    stringify,
    timestamp_text,
    typed_nulls,
    utf8_text,
)
from weirgate.sources.files import flatten_lines


def _items(count: Column) -> Column:
    """An array of ``count`` structs, empty for 0."""
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda i: F.struct(i.alias("no"), F.struct((i * 10).alias("size")).alias("box")))


FLAT_LINES = """
    SELECT l_orderkey AS id, l_linenumber AS line, o_custkey AS buyer_key, o_orderstatus AS buyer_state_code,
           i.no AS items_no, i.no * 10 AS items_box_size, t.mark AS marks
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN (SELECT unnest([1, 2, NULL]) AS no) i ON i.no <= l_linenumber % 3 OR (i.no IS NULL AND l_linenumber % 3 = 0)
    CROSS JOIN (SELECT unnest([1, 2]) AS k) u
    CROSS JOIN LATERAL (SELECT CASE u.k WHEN 1 THEN l_returnflag ELSE l_linestatus END AS mark) t
"""


@query(FLAT_LINES)
def flatsplode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = spread(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "orders")
    buyer = F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("state"))
    nested = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), buyer.alias("buyer"),
        _items(F.col("l_linenumber") % 3).alias("items"), F.array("l_returnflag", "l_linestatus").alias("marks"),
    )
    return shape.flatsplode(nested)


@query("""
    SELECT o_orderkey AS id, o_custkey AS "buyer.key", o_orderstatus AS "buyer.state.code", o_orderpriority AS plain
    FROM orders
""")
def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyer = F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("state"))
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), buyer.alias("buyer"), F.col("o_orderpriority").alias("plain")
    )
    return shape.flatten(nested)


@query("""
    SELECT event_id, CASE event_id % 5 WHEN 2 THEN CAST(n.x AS BIGINT) WHEN 3 THEN event_id END AS numbers, w.y AS words
    FROM events
    JOIN (SELECT unnest([0, 1]) AS x) n ON event_id % 5 = 2 OR n.x = 0
    JOIN (SELECT unnest(['', 'a', 'b']) AS y UNION ALL SELECT NULL) w
      ON (event_id % 2 = 0 AND w.y IN ('', 'a', 'b')) OR (event_id % 2 = 1 AND w.y IS NULL)
""")
def explode_falsy(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.array(F.col("event_id"))
    numbers = (
        F.when(F.col("event_id") % 5 == 0, F.array().cast("array<bigint>"))
        .when(F.col("event_id") % 5 == 1, F.array(F.lit(0), F.lit(0)).cast("array<bigint>"))
        .when(F.col("event_id") % 5 == 2, F.array(F.lit(0), F.lit(1)).cast("array<bigint>"))
        .when(F.col("event_id") % 5 == 3, one)
    )
    words = F.when(F.col("event_id") % 2 == 0, F.array(F.lit(""), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit(""), F.lit("")))
    return shape.explode_lists(table(spark, sf_dir, "events").select("event_id", numbers.alias("numbers"), words.alias("words")))


@query("SELECT c_custkey AS cust_key, c_name AS cust_name, c_nationkey AS place_nation FROM customer")
def flatten_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").select(
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).alias("cust"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("place"), "c_mktsegment",
    )
    return shape.flatten_one_level(nested)


@query("""
    SELECT o_orderkey AS id, i.no AS items_sku, CASE WHEN i.no IS NOT NULL THEN o_custkey END AS items_owner_key,
           CASE WHEN o_orderkey % 4 = 3 THEN o_orderstatus END AS note, CASE WHEN o_orderkey % 4 = 2 THEN o_orderstatus END AS note_code
    FROM orders
    JOIN (SELECT unnest([1, 2, NULL]) AS no) i
      ON (o_orderkey % 4 = 0 AND i.no = 1) OR (o_orderkey % 4 = 1 AND i.no IN (1, 2)) OR (o_orderkey % 4 >= 2 AND i.no IS NULL)
""")
def flatsplode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that disagree: an object, a list of objects, a list of empty objects, nothing."""
    item = '{"sku":%s,"owner":{"key":%s}}'
    key, owner, status = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    first, second = F.format_string(item, F.lit("1"), owner), F.format_string(item, F.lit("2"), owner)
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.format_string('{"id":%s,"items":%s}', key, first))
        .when(F.col("o_orderkey") % 4 == 1, F.format_string('{"id":%s,"items":[%s,%s],"note":{}}', key, first, second))
        .when(F.col("o_orderkey") % 4 == 2, F.format_string('{"id":%s,"items":[{},{}],"note":{"code":"%s"}}', key, status))
        .otherwise(F.format_string('{"id":%s,"note":"%s"}', key, status))
    )
    tagged = D.read_documents(spread(table(spark, sf_dir, "orders")).select(text.alias("value")), "value")
    rows = D.flat_rows(tagged.drop("value"), "_document", infer(tagged, "_document"))
    return rows.select("id", F.col("items_sku").cast("int").alias("items_sku"), "items_owner_key", "note", "note_code")


EVENT_MAP = {
    "flat_table_mapping": {
        "event_time": "millis|not_null,long_to_timestamp", "person": "user_id|not_null", "person_again": "user_id",
        "nothing": "no_such_column",
    }
}


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time, user_id AS person, user_id AS person_again,
           CAST(NULL AS VARCHAR) AS nothing, CAST(NULL AS VARCHAR) AS problem
    FROM events WHERE event_id % 5 <> 0
    UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, 'person column cannot be Null' FROM events WHERE event_id % 5 = 0
""")
def column_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "events").select(
        "event_id", millis("ts").alias("millis"), F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id")
    )
    rows = map_columns(flat, parse_column_map(EVENT_MAP), keep=["event_id"])
    return rows.select("event_id", "event_time", "person", "person_again", "nothing", F.col(f"{ERROR}.desc").alias("problem"))


@query("SELECT c_custkey AS key, upper(c_name) AS shout, c_nationkey * 2 AS twice FROM customer WHERE c_nationkey < 20")
def custom_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    register("shout", lambda v, _: F.upper(v))
    register("double", lambda v, _: v * 2, lambda v, t: F.when(v >= 20, F.lit(f"{t} is too large")))
    mapping = {"flat_table_mapping": {"key": "c_custkey", "shout": "c_name|shout", "twice": "c_nationkey|not_null,double"}}
    return split(map_columns(table(spark, sf_dir, "customer"), parse_column_map(mapping))).valid


@query("""
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'my-topic' ELSE event_type END AS event_type,
           CASE WHEN event_id % 3 = 0 THEN 'time' WHEN event_id % 3 = 1 THEN 'topic and time' ELSE props END AS props
    FROM events
""")
def token_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "click", "KAFKA_TOPIC_NAME").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 3 == 0, "CURRENT_TIMESTAMP").when(F.col("event_id") % 3 == 1, "ALTERNATE_KAFKA_TOPIC_ID")
        .otherwise(F.col("props")).alias("props"),
    )
    rows = substitute_tokens(tokens, "my-topic")
    time = "\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d\\.\\d{6}-0[67]:00$"
    kind = F.when(F.col("props").rlike(f"^{time}"), "time").when(F.col("props").rlike(f"^my-topic_{time}"), "topic and time")
    return rows.select("event_id", "event_type", kind.otherwise(F.col("props")).alias("props"))


@query("""
    SELECT o_orderkey AS id, i.no AS item_no, CAST(i.no * 5 AS BIGINT) AS item_qty, CAST(NULL AS VARCHAR) AS problem
    FROM orders CROSS JOIN (SELECT unnest([1, 2, 3]) AS no) i WHERE o_orderkey % 4 <> 0
    UNION ALL
    SELECT NULL, NULL, NULL, 'item_qty column cannot be Null' FROM orders WHERE o_orderkey % 4 = 0
""")
def line_atomicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = '{"no":1,"qty":5},{"no":2,"qty":%s},{"no":3,"qty":15}'
    qty = F.when(F.col("o_orderkey") % 4 == 0, "null").otherwise("10")
    text = F.format_string('{"id":%s,"lists":{"items":[' + item + "]}}", F.col("o_orderkey").cast("string"), qty)
    mapping = {"flat_table_mapping": {"id": "id", "item_no": "lists_items_no", "item_qty": "lists_items_qty|not_null"}}
    rows = flatten_lines(spread(table(spark, sf_dir, "orders")).select(text.alias("value"), F.lit("orders").alias(SOURCE)), mapping)
    return rows.select("id", F.col("item_no").cast("int").alias("item_no"), "item_qty", F.col(f"{ERROR}.desc").alias("problem"))


@query(ORDER_ROWS)
def flatten_lines_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _nested_order_lines(spark, sf_dir).withColumn(SOURCE, F.lit("orders"))
    return split(flatten_lines(lines, ORDER_MAP)).valid.drop("FileName", SOURCE)


@query("SELECT c_custkey, c_name AS C_Name, 'here' AS source_name FROM customer")
def select_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "C_Name").withColumn(SOURCE, F.lit("here"))
    return select_required(named, ["C_CUSTKEY", "c_name", "not_there"])


@query("SELECT c_custkey, c_name FROM customer")
def drop_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("here").alias("Source_Name"))
    return drop_source_name(named)


@query("""
    SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
           CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name END AS s_name
    FROM supplier
""")
def null_marker_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("string").alias("nation"),
        F.when(F.col("s_suppkey") % 4 == 0, "Null").otherwise(F.col("s_name")).alias("s_name"),
    )
    return null_markers(rows, ["3", "Null"], ["nation", "s_name"])


@query("""
    SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'N' ELSE s_name END AS s_name,
           CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS nation
    FROM supplier
""")
def typed_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, "N").otherwise(F.col("s_name")).alias("s_name"),
        F.when(F.col("s_suppkey") % 3 == 0, "N").otherwise(F.col("s_nationkey").cast("string")).alias("nation"),
    )
    declared = T.StructType([T.StructField("s_name", T.StringType()), T.StructField("nation", T.LongType())])
    return typed_nulls(rows, declared)


@query("""
    SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate
    FROM orders
""")
def jdbc_row_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "None").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return normalise_database_rows(table(spark, sf_dir, "orders").select("o_orderkey", status, "o_orderdate"))


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS p_brand,
           '' AS comment, '' AS source_name, CASE WHEN p_size > 25 THEN '' ELSE CAST(p_size AS VARCHAR) END AS p_size
    FROM part
""")
def stringify_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, "None").otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") <= 25, F.col("p_size")).alias("p_size"),
    )
    return stringify(rows, ["p_partkey", "p_brand", "comment", SOURCE])


@query("SELECT p_partkey, to_base64(encode(p_name)) AS p_name FROM part")
def base64_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base64_binary(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").cast("binary").alias("p_name")))


@query("SELECT count(*) AS rows, count(*) AS ids, count(*) AS well_formed FROM events")
def message_ids_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = message_ids(table(spark, sf_dir, "events").select("event_id"))
    shape_of_id = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}_\\d{4}-\\d\\d-\\d\\d_\\d\\d:\\d\\d:\\d\\d\\.\\d{6}$"
    return ids.agg(
        F.count("*").alias("rows"), F.countDistinct("RawMessageId").alias("ids"),
        F.count_if(F.col("RawMessageId").rlike(shape_of_id)).alias("well_formed"),
    )


@query("""
    SELECT event_id, 'id-' || event_id || chr(1) || props AS line, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS sent FROM events
""")
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = archive_line(F.concat(F.lit("id-"), F.col("event_id").cast("string")), F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"), timestamp_text(F.col("ts")).alias("sent"))


@query("SELECT page_id, replace(url, 'http://', 'original/place') AS url FROM pages")
def source_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", rewrite_source(F.col("url"), "http://*", "/original/place/").alias("url"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text ELSE chr(65533) || text END AS text FROM documents
""")
def utf8_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.when(F.col("doc_id") % 2 == 0, F.col("text").cast("binary")).otherwise(
        F.concat(F.unhex(F.lit("FF")), F.col("text").cast("binary"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", utf8_text(data).alias("text"))


@query("""
    SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' ||
           CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END || '}' AS value
    FROM customer
""")
def record_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 1, F.col("c_nationkey")).alias("c_nationkey")
    )
    return rows.select("c_custkey", record_json(rows).alias("value"))
