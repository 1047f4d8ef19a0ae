from datetime import datetime

from pyspark.sql import functions as F

from weirgate.operators import records as R


def test_split_gives_error_records_of_eight_fields(spark):
    rows = spark.createDataFrame([(1, "f"), (2, "f")], "a int, source_name string")
    tagged = rows.withColumn("_error", R.error_when(F.col("a") == 2, R.INVALID_RECORD, "two", F.col("a")))
    parts = R.split(tagged, "job", "id", "table", datetime(2024, 1, 1))
    assert parts.valid.collect() == [(1, "f")]
    assert parts.invalid.collect() == [("job", "id", "2", "Invalid Record", "two", "table", "f", datetime(2024, 1, 1))]
    assert parts.invalid.schema == R.ERROR_TABLE or parts.invalid.columns == R.ERROR_TABLE.names


def test_select_required_ignores_case_and_unknown_names(spark):
    rows = spark.createDataFrame([("a", "b", "c", "s")], "Col1 string, col2 string, col3 string, source_name string")
    assert R.select_required(rows, ["col1", "COL2", "nope"]).columns == ["Col1", "col2", "source_name"]


def test_drop_source_name_ignores_case(spark):
    rows = spark.createDataFrame([("a", "b")], "col1 string, SOURCE_NAME string")
    assert R.drop_source_name(rows).columns == ["col1"]


def test_archive_line(spark):
    row = spark.range(1).select(R.archive_line(F.lit("key"), F.lit("value"))).first()
    assert row[0] == "key\u0001value"


def test_message_ids_do_not_change_between_reads(spark):
    rows = R.message_ids(spark.range(100, numPartitions=4))
    first, second = rows.collect(), rows.collect()
    assert first == second and len({r.RawMessageId for r in first}) == 100


def test_stringify(spark):
    rows = spark.createDataFrame([(1, None, "None")], "a int, b string, c string")
    assert R.stringify(rows, ["c", "d", "a"]).collect() == [("", "", "1", "")]


def test_database_rows_become_text(spark):
    rows = spark.sql("SELECT 'None' AS a, timestamp'2024-01-02 03:04:05.000006' AS b, 1 AS c")
    assert R.normalise_database_rows(rows).collect() == [(None, "2024-01-02 03:04:05.000006", 1)]


def test_base64_only_for_binary(spark):
    rows = spark.createDataFrame([(bytearray(b"abc"), "abc")], "a binary, b string")
    assert R.base64_binary(rows).collect() == [("YWJj", "abc")]


def test_single_pass_is_evaluated_once(spark):
    rows = R.single_pass(spark.range(3), F.expr("try_parse_json('{\"a\":' || id || '}')"), "d")
    plan = rows.where("d IS NOT NULL").selectExpr("try_variant_get(d, '$.a', 'int')")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("parseJson") == 1


def test_resolve_variables():
    assert R.resolve_variables("select * from ##t## where d = '##d##'", {"t": "x", "d": "1"}) == "select * from x where d = '1'"
