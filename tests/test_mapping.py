import pytest
from pyspark.sql import functions as F

from weirgate.functions.procedures import long_to_timestamp, lookup
from weirgate.operators.mapping import map_columns, parse_column_map
from weirgate.operators.records import split
from weirgate.sources.files import flatten_lines


def lines(spark, *texts):
    rows = [(t, f"f{i}", f"id{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, source_name string, RawMessageId string")


def mapped(spark, mapping, *texts, **more):
    return split(flatten_lines(lines(spark, *texts), {"flat_table_mapping": mapping}, **more))


def test_unknown_procedure_is_refused_when_the_map_is_read():
    with pytest.raises(ValueError, match="unknown procedure 'nope'"):
        parse_column_map({"flat_table_mapping": {"a": "b|nope"}})


def test_map_keeps_renames_and_fills(spark):
    parts = mapped(spark, {"ID": "id", "line": "address_line1", "gone": "zzz"}, '{"id":1,"address":{"line1":"a"},"more":2}')
    assert parts.valid.collect() == [(1, "a", None, "f0", "f0", "id0")]
    assert parts.valid.columns == ["ID", "line", "gone", "FileName", "source_name", "RawMessageId"]


def test_one_flat_key_for_two_targets_starts_from_the_raw_value(spark):
    parts = mapped(spark, {"text": "t|long_to_timestamp", "number": "t"}, '{"t":1500}')
    assert parts.valid.select("text", "number").collect() == [("1970-01-01 00:00:01.500", 1500)]


def test_a_line_is_rejected_as_a_whole(spark):
    parts = mapped(spark, {"q": "items_q|not_null"}, '{"items":[{"q":1},{"q":null}]}', '{"items":[{"q":2},{"q":3}]}')
    assert sorted(r.q for r in parts.valid.collect()) == [2, 3]
    bad = parts.invalid.collect()
    assert [(b.error_record, b.error_desc, b.source_name) for b in bad] == [
        ('{"items":[{"q":1},{"q":null}]}', "q column cannot be Null", "f0")
    ]


def test_missing_key_counts_as_null(spark):
    parts = mapped(spark, {"q": "q|not_null"}, '{"a":1}', '{"q":1}')
    assert parts.valid.count() == 1 and parts.invalid.count() == 1


def test_checks_of_a_key_no_document_has(spark):
    parts = mapped(spark, {"q": "nowhere|not_null"}, '{"a":1}')
    assert parts.valid.count() == 0 and parts.invalid.count() == 1


def test_numbers_only_for_long_to_timestamp(spark):
    texts = ['{"t":1}', '{"t":"1"}', '{"t":true}', '{"t":null}', '{"t":1e30}', '{"t":-1}', '{"t":{}}', '{"t":[1,"x"]}', '{"t":1.9999}']
    parts = mapped(spark, {"t": "t|long_to_timestamp"}, *texts)
    good = {r.source_name: r.t for r in parts.valid.collect()}
    assert good == {
        "f0": "1970-01-01 00:00:00.001", "f3": None, "f5": "1969-12-31 23:59:59.999", "f6": None,
        "f8": "1970-01-01 00:00:00.002",
    }


def test_lists_and_scalars_are_no_records(spark):
    parts = mapped(spark, {"a": "a"}, "[1]", "1", "null", '"x"', '{"a":1}')
    assert parts.valid.count() == 1 and parts.invalid.count() == 4


def test_tokens_are_matched_against_values(spark):
    parts = mapped(spark, {"a": "a", "b": "b"}, '{"a":"KAFKA_TOPIC_NAME","b":"CURRENT_TIMESTAMP"}', topic="topic")
    row = parts.valid.first()
    assert row.a == "topic" and row.b[:2] == "20" and row.b[-6:] in ("-06:00", "-07:00")


def test_millis_of_all_kinds(spark):
    rows = spark.createDataFrame([(0.0,), (1.5,), (-1.0,), (253402300799999.0,)], "m double")
    found = [r[0] for r in rows.select(long_to_timestamp(F.col("m"))).collect()]
    assert found == ["1970-01-01 00:00:00.000", "1970-01-01 00:00:00.001", "1969-12-31 23:59:59.999", "9999-12-31 23:59:59.999"]


def test_typed_text_is_not_a_number(spark):
    rows = spark.createDataFrame([("12",), (None,)], "t string")
    parts = split(map_columns(rows, parse_column_map({"flat_table_mapping": {"t": "t|long_to_timestamp"}})))
    assert parts.valid.collect() == [(None,)] and parts.invalid.first().error_desc == "t is not a number"


def test_procedures_by_name():
    assert lookup("not_null").check is not None
