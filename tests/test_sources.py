import json
import os
import random

import pytest
from pyspark.sql import types as T

from weirgate.operators.records import split
from weirgate.schema import conform, declared_schema
from weirgate.sources import api, config, delimited, files, messages
from weirgate.sources.database import jdbc_options, query_scan


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("width", [1, 2, 5])
def test_lines_of_any_length(spark, tmp_path, width):
    """Lines with fewer fields than names lack the last ones, those with more give numbered columns."""
    rng = random.Random(width)
    names = [f"n{i}" for i in range(width)]
    lines = [[f"v{k}x{i}" for i in range(rng.randint(1, width + 2))] for k in range(50)]
    write(tmp_path, "ragged.csv", "\n".join(",".join(line) for line in [names, *lines]) + "\n")
    rows = split(delimited.delimited_scan(spark, str(tmp_path))).valid
    columns = [*names, *(f"column_{i + 1}" for i in range(width, max(map(len, lines))))]
    assert sorted(map(tuple, rows.select(columns).collect()), key=str) == sorted((tuple(line + [None] * (len(columns) - len(line))) for line in lines), key=str)
    assert {os.path.basename(r.source_name) for r in rows.select("source_name").collect()} == {"ragged.csv"}


def test_quotes_escapes_markers_and_extra_fields(spark, tmp_path):
    write(tmp_path, "a.csv", 'x,y\n"a ""b"", c",d\\,e\n\n-1,\nNull,\\"v\\"\n1,2,3\n"open,1\n')
    parts = split(delimited.delimited_scan(spark, str(tmp_path)))
    rows = {tuple(r[:3]) for r in parts.valid.select("x", "y", "column_3").collect()}
    assert rows == {('a "b", c', "d,e", None), (None, "", None), (None, '"v"', None), ("1", "2", "3")}
    assert [r.error_record for r in parts.invalid.collect()] == ['"open,1']


def test_each_file_has_its_own_header(spark, tmp_path):
    write(tmp_path, "a.csv", "a,b\n1,2\n")
    write(tmp_path, "b.csv", "b,c\n3,4\n")
    write(tmp_path, "c.csv", "b,c\n")
    rows = split(delimited.delimited_scan(spark, str(tmp_path))).valid
    assert {tuple(r) for r in rows.select("a", "b", "c").collect()} == {("1", "2", None), (None, "3", "4")}


@pytest.mark.parametrize("skip", [0, 1, 3])
def test_skipped_rows_of_a_file_in_many_splits(spark, tmp_path, skip):
    lead = "".join(f"lead {i}\n" for i in range(skip))
    body = "".join(f"{i},value {i}\n" for i in range(300_000))
    write(tmp_path, "big.csv", lead + "k,v\n" + body)
    write(tmp_path, "small.csv", lead + "k,v\n-5,x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100000")
    try:
        rows = split(delimited.delimited_scan(spark, str(tmp_path), skip_rows=skip, extra_columns=0)).valid
        assert rows.rdd.getNumPartitions() > 4
        assert rows.count() == 300_001 and rows.select("k").distinct().count() == 300_001
        assert rows.where("k = 'k' OR k LIKE 'lead%'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_declared_names_without_header(spark, tmp_path):
    write(tmp_path, "a.csv", "1,2\n3,4,5\n")
    schema = declared_schema([{"name": "a", "type": "STRING"}, {"name": "b", "type": "STRING"}])
    rows = split(delimited.delimited_scan(spark, str(tmp_path), header=False, schema=schema)).valid
    assert {tuple(r) for r in rows.select("a", "b", "column_3").collect()} == {("1", "2", None), ("3", "4", "5")}
    with pytest.raises(ValueError):
        delimited.delimited_scan(spark, str(tmp_path), header=False)


def test_line_breaks_in_quotes(spark, tmp_path):
    write(tmp_path, "a.csv", 'a,b\n"x\ny",\n1\n2,3,4\n')
    parts = split(delimited.delimited_scan(spark, str(tmp_path), multi_line=True))
    assert {tuple(r) for r in parts.valid.select("a", "b").collect()} == {("x\ny", ""), ("1", None)}
    assert parts.invalid.count() == 1


def test_semicolon_and_tab(spark, tmp_path):
    write(tmp_path, "a.csv", 'a;b\n"1;2";3\n')
    rows = split(delimited.delimited_scan(spark, str(tmp_path), delimiter=";")).valid
    assert rows.select("a", "b").collect() == [("1;2", "3")]


def test_text_that_is_not_utf8(spark, tmp_path):
    with open(tmp_path / "a.csv", "wb") as f:
        f.write(b"1,ok\n2,\xff\n")
    schema = declared_schema([{"name": "a", "type": "STRING"}, {"name": "b", "type": "STRING"}])
    parts = split(delimited.delimited_scan(spark, str(tmp_path), header=False, schema=schema))
    assert parts.valid.select("a").collect() == [("1",)]
    assert parts.invalid.first().error_desc == "not UTF-8 text"


@pytest.mark.parametrize("indent", [None, 3])
def test_records_under_a_key(spark, tmp_path, indent):
    """Every record of the list under the key, whatever stands beside it."""
    rng = random.Random(7)
    records = [{"no": k, "label": f"l{rng.randint(0, 99)}", "share": rng.random()} for k in range(40)]
    for part in range(4):
        document = {"before": [part], "found": records[part * 10 : part * 10 + 10], "behind": {"found": [{"no": -1}]}}
        write(tmp_path, f"{part}.json", json.dumps(document, indent=indent))
    rows = split(files.json_scan(spark, str(tmp_path), root="found")).valid
    assert sorted((r.no, r.label, r.share) for r in rows.collect()) == [(r["no"], r["label"], r["share"]) for r in records]


def test_json_elements_that_are_no_objects(spark, tmp_path):
    write(tmp_path, "a.json", '[{"a":1}, 5, {"a":2}]')
    write(tmp_path, "b.json", "{broken")
    write(tmp_path, "c.json", "[]")
    parts = split(files.json_scan(spark, str(tmp_path)))
    assert sorted(r.a for r in parts.valid.collect()) == [1, 2]
    assert sorted(r.error_record for r in parts.invalid.collect()) == ["5", "{broken"]


def test_ndjson_lists_and_blank_lines(spark, tmp_path):
    write(tmp_path, "a.json", '[{"pier": 1, "owner": "c"}]\n\n{"pier": 2}\n{"pier": "three"}\n')
    parts = split(files.ndjson_scan(spark, str(tmp_path)))
    assert {r.pier for r in parts.valid.collect()} == {"1", "2", "three"}
    assert parts.invalid.count() == 1


def test_nested_values_stay_nested(spark, tmp_path):
    write(tmp_path, "a.json", '{"a":{"b":{"c":1}},"l":[{"x":1.5}]}\n{"a":{"b":{}}}\n')
    rows = split(files.ndjson_scan(spark, str(tmp_path))).valid
    assert rows.select("a.b.c", "l.x").where("c = 1").collect() == [(1, [1.5])]


def test_flattened_file_against_the_rule(spark, tmp_path):
    """Random nested objects come with their joined names, and with the rewritten name of their file."""
    rng = random.Random(11)
    shape = {f"a{i}": {f"b{j}": {f"c{k}": 0 for k in range(rng.randint(1, 2))} for j in range(rng.randint(1, 3))} for i in range(3)}
    documents = [{a: {b: {c: rng.randint(0, 999) for c in inner} for b, inner in outer.items()} for a, outer in shape.items()} for _ in range(20)]
    names = [f"{a}_{b}_{c}" for a, outer in shape.items() for b, inner in outer.items() for c in inner]
    write(tmp_path, "lines.json", "\n".join(map(json.dumps, documents)))
    mapping = {"flat_table_mapping": {name.upper(): name for name in names}}
    rows = split(files.flatten_json_scan(spark, str(tmp_path), mapping, staging=(str(tmp_path), "/kept"))).valid.collect()
    want = [tuple(d[a][b][c] for a, b, c in (n.split("_") for n in names)) for d in documents]
    assert sorted(tuple(r[n.upper()] for n in names) for r in rows) == sorted(want)
    assert all(r.source_name == r.FileName and "kept/lines.json" in r.source_name for r in rows)


def test_xml_elements_with_attributes(spark):
    """Random numbers of elements come as a list of records, attributes and values as text."""
    rng = random.Random(13)
    texts, want = [], []
    for _ in range(15):
        items = [(f"k{rng.randint(0, 9)}", f"{rng.random():.3f}", f"w {rng.randint(0, 9)}") for _ in range(rng.randint(1, 5))]
        texts.append("<all>" + "".join(f'<one key="{k}"><num>{n}</num><word>{w}</word></one>' for k, n, w in items) + "</all>")
        want.append(items)
    bad = ["no markup at all", "<all><one></all>"]
    schema = T._parse_datatype_string("one array<struct<`@key`:string,num:string,word:string>>")
    parts = split(files.xml_rows(spark.createDataFrame([(t,) for t in texts + bad], "value string"), schema))
    assert sorted([tuple(e) for e in r.one] for r in parts.valid.collect()) == sorted(want)
    assert sorted((r.error_type, r.error_record) for r in parts.invalid.collect()) == sorted(("Invalid Xml", t) for t in bad)


def test_file_lines(spark, tmp_path):
    path = write(tmp_path, "a.txt", "r1\nr2\n")
    assert {(os.path.basename(r.source_name), r.value) for r in files.line_scan(spark, path).collect()} == {("a.txt", "r1"), ("a.txt", "r2")}


def test_messages_good_and_bad(spark):
    """Messages that are JSON objects become records, all others error records with their text."""
    rng = random.Random(17)
    good = [{"no": k, "text": "".join(rng.choice('ab"é,') for _ in range(5))} for k in range(30)]
    bad = [json.dumps(m)[rng.randint(1, 4) :] for m in good[:10]]
    texts = [json.dumps(m) for m in good] + bad
    rng.shuffle(texts)
    rows = spark.createDataFrame([(None if rng.random() < 0.5 else bytearray(b"k"), bytearray(t.encode())) for t in texts], "key binary, value binary")
    parts = split(messages.json_messages(rows, "subject"))
    assert sorted((r.no, r.text) for r in parts.valid.collect()) == [(m["no"], m["text"]) for m in good]
    assert sorted((r.error_type, r.source_name, r.error_record) for r in parts.invalid.collect()) == sorted(("Invalid Json", "subject", t) for t in bad)


def test_kafka_options():
    found = messages.kafka_options("t", {"bootstrap.server": "h:1", "group.id": 2, "auto.offset.reset": "latest", "enable.auto.commit": True})
    assert found == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "kafka.group.id": "2", "startingOffsets": "latest"}
    assert messages.kafka_options("t", {})["kafka.group.id"] == "tGroup"


def test_jdbc_options():
    props = {"driver_class_name": "d", "jdbc_url": "u", "username": "me", "password": "p", "host": "ignored"}
    assert jdbc_options(props) == {"driver": "d", "url": "u", "user": "me", "password": "p"}


@pytest.mark.parametrize("params, want", [(None, "b"), ([], "b"), ("a=1", "b?a=1"), (["a=1", "c=2"], "b?a=1&c=2")])
def test_resolved_url(spark, params, want):
    assert spark.range(1).select(api.resolved_url("b", params)).first()[0] == want


def test_api_payload_must_be_an_object(spark):
    rows = spark.createDataFrame([("u1", '{"d":{"a":[1,2]}}'), ("u2", '{"d":[1]}'), ("u3", "{}"), ("u4", "x")], "url string, body string")
    parts = split(api.response_rows(rows, "d"))
    assert sorted((r.source_name, r.a) for r in parts.valid.collect()) == [("u1", 1), ("u1", 2)]
    assert sorted(r.source_name for r in parts.invalid.collect()) == ["u2", "u3", "u4"]


def test_query_with_markers_and_variables(spark):
    spark.range(5).createOrReplaceTempView("weirgate_numbers")
    rows = query_scan(spark, "SELECT id FROM ##t## WHERE id > :low", "w", {"low": 2}, {"t": "weirgate_numbers"})
    assert sorted(r.id for r in split(rows).valid.collect()) == [3, 4]


def test_config_tables(spark):
    rows = spark.createDataFrame([("t1", "a", '{"x": {"y": 1}}'), ("t2", "b", None), ("u1", "c", None)],
                                 "task_id string, input_processor string, additional_input string")
    assert config.task_properties(rows, "t1") == [{"task_id": "t1", "input_processor": "a", "x": {"y": 1}}]
    jobs = spark.createDataFrame([("j2", "v2", None), ("j1", "v1", '{"v": "over"}')], "job_name string, v string, additional_input string")
    assert config.job_properties(jobs, "j%", "job_name") == {"job_name": "j1", "v": "over"}


def test_declared_types_and_modes():
    schema = declared_schema('{"fields": [{"name": "a", "type": "String"}, {"name": "n", "type": "NUMERIC", "precision": "6", "scale": "2"},'
                             '{"name": "b", "type": "BIGNUMERIC"}, {"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": '
                             '[{"name": "x", "type": "INTEGER", "mode": "REQUIRED"}]}]}')
    assert schema.simpleString() == "struct<a:string,n:decimal(6,2),b:decimal(38,18),r:array<struct<x:bigint>>>"
    assert not schema["r"].dataType.elementType["x"].nullable
    with pytest.raises(ValueError):
        declared_schema([{"name": "a", "type": "GEOGRAPHY"}])


def test_conform_reports_misfits(spark):
    schema = declared_schema([{"name": "pier", "type": "INTEGER"}, {"name": "day", "type": "DATE"}, {"name": "new", "type": "FLOAT"},
                              {"name": "rec", "type": "RECORD", "fields": [{"name": "i", "type": "INTEGER"}]}])
    rows = spark.createDataFrame([("1", "2024-02-29", '{"i": 5}', "x"), ("none", "2024-01-01", None, "y"), ("2", "2024-02-30", None, "z")],
                                 "pier string, day string, rec string, more string")
    parts = split(conform(rows, schema))
    row = parts.valid.first()
    assert (row.pier, str(row.day), row.new, row.rec.i, row.more) == (1, "2024-02-29", None, 5, "x")
    assert sorted(r.error_desc for r in parts.invalid.collect()) == ["day is not of type date", "pier is not of type bigint"]
    assert conform(rows, schema, extra="drop").columns == ["pier", "day", "new", "rec", "_error"]
