"""What earlier versions lost, refused or made depend on chance."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.incremental import Bounds, column_maximum
from weirgate.operators.lookup import lookup_join
from weirgate.operators.records import MESSAGE_ID, message_ids, split, spread
from weirgate.schema import conform, declared_schema
from weirgate.session import ship
from weirgate.sinks.tables import read_table, write_stream_batch, write_table
from weirgate.sources import delimited, files
from weirgate.sources.database import jdbc_options, whole_bounds

LAYOUT = "id bigint, n string, s struct<a: bigint, l: array<double>>, d decimal(10,2), b boolean"


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


FITTING = ['{"id":1,"n":"a","s":{"a":1,"l":[1.5,2]}}', '{"id":"8","n":[1]}', '{"id":null,"zz":3}', '{"s":{"l":[]}}', '{"d":"1.25","b":true}', '{"n":5}']
MISFITS = ['{"id":"x7"}', '{"id":[1,2]}', '{"id":1.5}', '{"s":5}', '{"s":{"a":"q"}}', '{"s":{"a":2,"l":["z"]}}', '{"s":{"l":{}}}', '{"b":"maybe"}', '{"id":{}}']


def test_values_that_do_not_fit_a_declared_layout(spark, tmp_path):
    path = write(tmp_path, "a.json", "\n".join(FITTING + MISFITS))
    parts = split(files.ndjson_scan(spark, path, layout=T._parse_datatype_string(LAYOUT)))
    assert parts.valid.count() == len(FITTING)
    assert sorted(r.error_record for r in parts.invalid.collect()) == sorted(MISFITS)


def test_lists_that_a_declared_layout_does_not_know(spark, tmp_path):
    good = ['{"id":1,"n":"a"}', '{"id":2,"o":{"p":"["}}']
    bad = ['{"id":3,"more":[1,2]}', '{"id":4,"o":{"p":{"q":[1]}}}', '{"id":5,"n":{"q":1}}', '{"id":6,"n":["x"]}']
    path = write(tmp_path, "a.json", "\n".join(good + bad))
    layout = T._parse_datatype_string("id bigint, n string")
    parts = split(files.flatten_json_scan(spark, path, {"flat_table_mapping": {"i": "id", "n": "n"}}, layout))
    assert sorted(r.i for r in parts.valid.collect()) == [1, 2]
    assert sorted(r.error_record for r in parts.invalid.collect()) == sorted(bad)


def test_elements_of_lists(spark, tmp_path):
    texts = ['[{"a":1}, [{"a":9}], 5]', '[ ]', ' {"a": 2} ', '[{"a":3},]', '[{"a":4}] x', '[{"a":5} {"a":6}]', '[{"a":7}', '"x"', '[{"a":NaN},{"a":8}]']
    for i, text in enumerate(texts):
        write(tmp_path, f"in/{i}.json", text)
    parts = split(files.json_scan(spark, str(tmp_path / "in")))
    assert sorted(r.a for r in parts.valid.collect()) == [1, 2, 8]
    bad = ['[{"a":9}]', "5", '[{"a":3},]', '[{"a":4}] x', '[{"a":5} {"a":6}]', '[{"a":7}', '"x"', '[{"a":NaN}]']
    assert sorted(r.error_record for r in parts.invalid.collect()) == sorted(bad)


def test_elements_under_a_root(spark, tmp_path):
    texts = ['{"x":[1,{"r":[]}],"r":[{"a":1},{"a":2}]}', '{"r":{"a":3}}', '{"r":[{"a":4}],"r":[{"a":5}]}', '{"r":[],"b":1}', '{"q":1}', '[{"r":[{"a":6}]}]', '{"r":[{"a":7}]', '{"r" [1]}', '{"r":[{"a":8}],}']
    for i, text in enumerate(texts):
        write(tmp_path, f"in/{i}.json", text)
    parts = split(files.json_scan(spark, str(tmp_path / "in"), root="r"))
    assert sorted(r.a for r in parts.valid.collect()) == [1, 2, 3, 5]
    assert sorted(r.error_record for r in parts.invalid.collect()) == sorted(['{"q":1}', *texts[5:]])


def test_list_above_the_limit_of_a_variant(spark, tmp_path):
    filler, n = "x" * 1000, 140_000
    with open(tmp_path / "a.json", "w") as f:
        f.write("[" + ",".join(f'{{"id":{i},"filler":"{filler}"}}' for i in range(n)) + "]")
    layout = T._parse_datatype_string("id bigint, filler string")
    rows = split(files.json_scan(spark, str(tmp_path / "a.json"), layout=layout)).valid
    assert rows.agg(F.count("*"), F.sum("id"), F.min(F.length("filler"))).first() == (n, n * (n - 1) // 2, 1000)


def test_nested_fields_go_by_name(spark, tmp_path):
    rows = [{"k": [{"afloat": True, "n": "1", "hull": "oak"}]}, {"k": [{"afloat": False, "n": "many", "hull": "elm"}]}, {"k": None}, {"k": [None]}]
    path = write(tmp_path, "a.json", "\n".join(json.dumps(r) for r in rows))
    schema = declared_schema([{"name": "k", "type": "RECORD", "mode": "REPEATED", "fields": [
        {"name": "hull", "type": "STRING"}, {"name": "n", "type": "INTEGER"}, {"name": "absent", "type": "DATE"}, {"name": "afloat", "type": "BOOLEAN"}]}])
    parts = split(conform(files.ndjson_scan(spark, path), schema))
    assert [r.k for r in parts.valid.collect() if r.k and r.k[0]] == [[("oak", 1, None, True)]]
    assert parts.valid.count() == 3 and "many" in parts.invalid.first().error_record


def test_required_field_inside_a_record(spark):
    schema = declared_schema([{"name": "r", "type": "RECORD", "fields": [{"name": "x", "type": "INTEGER", "mode": "REQUIRED"}]}])
    rows = spark.createDataFrame([((1,),), ((None,),), (None,)], "r struct<x: int>")
    parts = split(conform(rows, schema))
    assert (parts.valid.count(), parts.invalid.count()) == (2, 1)


def test_files_of_many_columns(spark, tmp_path):
    n = 700
    write(tmp_path, "a.csv", ",".join(f"c{i}" for i in range(n)) + "\n" + ",".join(map(str, range(n))) + "\n1,2\n")
    rows = split(delimited.delimited_scan(spark, str(tmp_path), extra_columns=0)).valid.select("c1", f"c{n - 1}").collect()
    assert sorted(rows) == [("1", str(n - 1)), ("2", None)]


@pytest.mark.parametrize("skip, text", [(0, "\n \nid,n\n1,x\n2,y"), (1, "lead\n\nid,n\n1,x\n2,y"), (2, "\nlead\nid,n\n1,x\n\n2,y\n")])
def test_blank_lines_before_the_header(spark, tmp_path, skip, text):
    write(tmp_path, "a.csv", text)
    rows = split(delimited.delimited_scan(spark, str(tmp_path), skip_rows=skip)).valid
    assert sorted(rows.select("id", "n").collect()) == [("1", "x"), ("2", "y")]


def test_several_headers_in_odd_paths(spark, tmp_path):
    write(tmp_path, "in/a 1.csv", "a\n1\n")
    write(tmp_path, "in/b%202.csv", "b\n2\n")
    write(tmp_path, "in/c[3] {x}.csv", "c\n3\n")
    rows = split(delimited.delimited_scan(spark, str(tmp_path / "in"))).valid.select("a", "b", "c").collect()
    assert {tuple(r) for r in rows} == {("1", None, None), (None, "2", None), (None, None, "3")}


def test_bounds_never_go_back(spark):
    rows = spark.range(10)
    assert column_maximum(rows, "id") == "9"
    assert column_maximum(rows.limit(0), "id", "9") == "9"
    assert column_maximum(rows.where("id < 3"), "id", "9") == "9"
    assert column_maximum(rows, "id", "10") == "10"
    assert column_maximum(rows.limit(0), "id") is None
    assert Bounds(None, None).high_text is None


def test_database_bounds_and_options():
    decimal = T.DecimalType(20, 10)
    assert whole_bounds(decimal, "1.0000000000", "7.2500000000") == (1, 8)
    assert whole_bounds(decimal, "-1.5", "-0.5") == (-2, 0)
    assert whole_bounds(T.TimestampType(), "2024-01-01 00:00:00", "2024-01-02 00:00:00") == ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert jdbc_options({"url": "u", "options": {"queryTimeout": 5}}) == {"url": "u", "queryTimeout": "5"}


def test_lookup_keys_that_repeat_need_an_order(spark):
    records = spark.createDataFrame([(1,), (2,)], "k int")
    lookup = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (2, "c", 1)], "k int, v string, t int")
    with pytest.raises(ValueError):
        lookup_join(records, lookup, {"k": "k"})
    assert sorted(lookup_join(records, lookup.where("v <> 'a'"), {"k": "k"}).select("k", "v").collect()) == [(1, "b"), (2, "c")]
    for parts in (1, 2, 5):
        found = lookup_join(records, lookup.repartition(parts), {"k": "k"}, ["t"]).select("k", "v").collect()
        assert sorted(found) == [(1, "b"), (2, "c")]


def test_message_ids_do_not_depend_on_the_order_of_a_shuffle(spark, tmp_path):
    spark.range(500).select(F.col("id").cast("string").alias("value")).repartition(2).write.text(str(tmp_path / "in"))
    rows = spread(message_ids(files.line_scan(spark, str(tmp_path / "in"))))
    first = {r.value: r[MESSAGE_ID] for r in rows.collect()}
    assert {r.value: r[MESSAGE_ID] for r in rows.repartition(7, "value").sort("value").collect()} == first
    assert len(set(first.values())) == 500


def test_batches_beside_streams(spark, tmp_path):
    target = {"target_table": str(tmp_path / "out")}
    one, two = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(2,)], "id int")
    write_table(one, target)
    write_stream_batch(two, target, 0)
    write_stream_batch(two, target, 0)
    assert sorted(r.id for r in read_table(spark, target["target_table"]).collect()) == [1, 2]
    write_table(one, target)
    write_table(one, target)
    assert sorted(r.id for r in read_table(spark, target["target_table"]).select("id").collect()) == [1, 1, 1, 2]


def test_catalog_table_of_streams_takes_batches(spark):
    spark.sql("DROP TABLE IF EXISTS weirgate_shared")
    one = spark.createDataFrame([(1,)], "id int")
    write_stream_batch(one, {"target_table": "weirgate_shared"}, 0)
    write_table(one, {"target_table": "weirgate_shared"})
    write_table(one, {"target_table": "weirgate_shared"})
    assert spark.table("weirgate_shared").count() == 3
    spark.sql("DROP TABLE weirgate_shared")


def test_package_is_sent_to_workers(spark):
    ship(spark)
    assert any("weirgate" in f for f in spark.sparkContext.listFiles)


def test_lists_that_a_layout_does_not_know_are_found_without_a_map_for_every_document(spark):
    from weirgate.operators import documents
    from weirgate.operators.layout import Layout

    layout = Layout.of(T.StructType([T.StructField("id", T.LongType())]))
    wrong = documents.misfit(F.col("v"), layout, flat=True)
    assert "CASE WHEN contains(schema_of_variant(v), 'ARRAY<') THEN" in str(wrong)
    texts = ['{"id":1}', '{"id":1,"a":[1]}', '{"id":1,"a":{"b":[]}}', '{"id":1,"ARRAY<":2}', '{"id":1,"a":"ARRAY<"}', "null", '{"id":[1]}', None]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", F.parse_json("t").alias("v"))
    found = {r.n: r.wrong for r in rows.select("n", wrong.alias("wrong")).collect()}
    # A key that reads like a list's type is still told from one.
    assert [found[n] for n in range(8)] == [False, True, True, False, False, False, True, False]
