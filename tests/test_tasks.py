import json
import os

import pytest

from weirgate.plans import run_stream_task, run_task, run_tasks
from weirgate.plans.registry import sink
from weirgate.session import scratch_root
from weirgate.sinks.messages import producer_options
from weirgate.sinks.tables import read_table, write_table
from weirgate.streaming import runner


def csv_task(tmp_path, **more):
    os.makedirs(tmp_path / "in", exist_ok=True)
    with open(tmp_path / "in" / "a.csv", "w") as f:
        f.write("id,name,extra\n1,a,x\n2,b,y\nthree,c,z\n")
    return {
        "job_name": "j", "task_name": "t", "input_processor": "CSVProcessor", "data_file": str(tmp_path / "in"),
        "delimited_file_props": {"header_exists": "True"},
        "schema": [{"name": "id", "type": "INTEGER"}, {"name": "name", "type": "STRING"}],
        "required_columns": ["id", "NAME"],
        "targets": [{"bigquery": {"target_table": str(tmp_path / "out")}}],
        "error": {"insert_error_rec": True, "error_table": str(tmp_path / "errors")},
        "audit": {"required": True, "job_audit_table": str(tmp_path / "audit"), "file_audit_table": str(tmp_path / "files"),
                  "enable_file_level_auditing": "true"},
    } | more


def test_csv_to_table_with_audits(spark, tmp_path):
    result = run_task(spark, csv_task(tmp_path))
    assert (result.source_rows, result.target_rows, result.error_rows) == (3, 2, 1)
    assert sorted(map(tuple, read_table(spark, str(tmp_path / "out")).select("id", "name").collect())) == [(1, "a"), (2, "b")]
    assert read_table(spark, str(tmp_path / "out")).columns == ["id", "name"]
    assert read_table(spark, str(tmp_path / "errors")).first().error_desc == "id is not of type bigint"
    files = read_table(spark, str(tmp_path / "files")).collect()
    assert [(f.src_rec_count, f.tgt_rec_count, f.err_rec_count) for f in files] == [(3, 2, 1)] and files[0].source_name.endswith("a.csv")
    assert sorted(r.status for r in read_table(spark, str(tmp_path / "audit")).collect()) == ["COMPLETED", "In-Progress"]


def test_staged_rows_are_removed(spark, tmp_path):
    run_task(spark, csv_task(tmp_path))
    folder = f"{scratch_root(spark)}/weirgate"
    assert not [d for d in (os.listdir(folder) if os.path.isdir(folder) else []) if d.startswith("staged-")]


def test_source_name_on_request(spark, tmp_path):
    run_task(spark, csv_task(tmp_path, is_filename_req_in_target="True", audit={}))
    assert read_table(spark, str(tmp_path / "out")).columns == ["id", "name", "source_name"]


def test_failed_task_is_audited_and_others_go_on(spark, tmp_path):
    good = csv_task(tmp_path)
    results = run_tasks(spark, [good | {"data_file": str(tmp_path / "nowhere")}, good])
    assert [r.status for r in results] == ["FAILED", "COMPLETED"]
    assert sorted(r.status for r in read_table(spark, str(tmp_path / "audit")).collect()) == [
        "COMPLETED", "FAILED", "In-Progress", "In-Progress"
    ]


@pytest.mark.parametrize("change", [{"targets": []}, {"input_processor": "nope"}, {"targets": [{"nope": {}}]}, {"job_name": ""}])
def test_tasks_are_checked(spark, tmp_path, change):
    with pytest.raises(ValueError):
        run_task(spark, csv_task(tmp_path) | change)


def test_input_without_rows(spark, tmp_path):
    task = csv_task(tmp_path)
    with open(tmp_path / "in" / "a.csv", "w") as f:
        f.write("id,name\n")
    result = run_task(spark, task)
    assert (result.source_rows, result.target_rows, result.error_rows) == (0, 0, 0)
    assert run_task(spark, task | {"audit": {}}).source_rows == 0


def test_empty_disposition_looks_at_rows_not_at_the_folder(spark, tmp_path):
    target = {"target_table": str(tmp_path / "t"), "write_disposition": "WRITE_EMPTY"}
    write_table(spark.range(0), target)
    write_table(spark.range(2), target)
    with pytest.raises(ValueError):
        write_table(spark.range(2), target)
    with pytest.raises(ValueError):
        write_table(spark.range(2), target | {"write_disposition": "WRITE_SOMEHOW"})


def test_producer_options():
    found = producer_options({"producer_config": {"bootstrap.servers": "h:1"}, "topic_name": "t"})
    assert found == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def stream_task(tmp_path):
    return {
        "job_name": "j", "task_name": "t", "input_processor": "JsonFlattenStreamingProcessor", "data_file": str(tmp_path / "in"),
        "column_name_map": json.dumps({"flat_table_mapping": {"id": "id|not_null", "x": "list"}}),
        "schema": [{"name": "id", "type": "INTEGER"}, {"name": "x", "type": "INTEGER"}],
        "targets": [{"bigquery_stream": {"target_table": str(tmp_path / "out")}}, {"gcs": {"path": str(tmp_path / "text")}}],
        "error": {"error_table": str(tmp_path / "errors")},
    }


def test_stream_restarts_without_repeating(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for lot in range(3):
        with open(tmp_path / "in" / f"{lot}.json", "w") as f:
            f.write(f'{{"id":{lot},"list":[1,2]}}\n{{"id":null}}\n')
        run_stream_task(spark, stream_task(tmp_path), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    rows = read_table(spark, str(tmp_path / "out")).select("id", "x").collect()
    assert sorted(map(tuple, rows)) == [(i, x) for i in range(3) for x in (1, 2)]
    assert read_table(spark, str(tmp_path / "errors")).count() == 3
    assert spark.read.text(str(tmp_path / "text")).count() == 6


def test_batch_that_runs_again_replaces_itself(spark, tmp_path):
    write = runner.fan_out({"job_name": "j", "targets": [{"bigquery": {"target_table": str(tmp_path / "out")}}]}, "id")
    batch = spark.range(5).selectExpr("id", "'s' AS source_name", "CAST(NULL AS struct<type:string,desc:string,raw:string>) AS _error")
    for batch_id in (0, 1, 1):
        write(batch, batch_id)
    assert read_table(spark, str(tmp_path / "out")).count() == 10


def test_stream_into_catalog_table(spark, tmp_path):
    name = f"weirgate_t{os.getpid()}"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, more STRING, stream_batch BIGINT) USING parquet PARTITIONED BY (stream_batch) "
              f"LOCATION '{tmp_path / 'table'}'")
    write = runner.fan_out({"job_name": "j", "targets": [{"bigquery": {"target_table": name}}]}, "id")
    batch = spark.range(5).selectExpr("id", "'u' AS unknown", "CAST(NULL AS struct<type:string,desc:string,raw:string>) AS _error")
    for batch_id in (0, 0, 1):
        write(batch, batch_id)
    assert spark.table(name).count() == 10 and spark.table(name).where("more IS NULL").count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_types_of_a_stream_do_not_depend_on_the_batch(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    task = stream_task(tmp_path)
    del task["schema"]
    for lot, value in enumerate(("1", '"one"', "1.5")):
        with open(tmp_path / "in" / f"{lot}.json", "w") as f:
            f.write(f'{{"id":{value},"list":[]}}\n')
        run_stream_task(spark, task, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert sorted(r.id for r in read_table(spark, str(tmp_path / "out")).collect()) == ["1", "1.5", "one"]


def test_appended_rows_take_the_types_of_the_table(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id bigint, name string").write.parquet(str(tmp_path / "out"))
    task = csv_task(tmp_path)
    del task["schema"]
    result = run_task(spark, task)
    assert (result.target_rows, result.error_rows) == (2, 1)
    assert sorted(r.id for r in read_table(spark, str(tmp_path / "out")).collect()) == [1, 1, 2]


def test_streams_use_registered_targets_and_keep_raw_lines(spark, tmp_path):
    seen = []

    @sink("collecting")
    def collect(df, target, task):
        seen.extend(r.id for r in df.collect())

    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.json").write_text('{"id":1,"list":[]}\nbroken\n')
    task = stream_task(tmp_path) | {"targets": [{"collecting": {}}], "gcs_triaging_path": str(tmp_path / "raw")}
    run_stream_task(spark, task, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert seen == [1]
    lines = sorted(r.value.split("\u0001")[1] for r in spark.read.text(str(tmp_path / "raw")).select("value").collect())
    assert lines == ["broken", '{"id":1,"list":[]}']
