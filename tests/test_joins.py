import random
from collections import Counter, defaultdict

import pytest

from weirgate.operators.audit import target_text
from weirgate.operators.incremental import Bounds, column_maximum, delta_literal, increment, latest_runs, with_ties, within
from weirgate.operators.lookup import fits_broadcast, hot_keys, lookup_join
from weirgate.operators.windows import number_within, window_batches, window_counts


def looked_up(records, lookup):
    """What a lookup gives: the last matching row of (key, order, value), if any."""
    last = {}
    for key, order, value in sorted(lookup, key=lambda r: r[1]):
        last[key] = (order, value)
    return Counter((i, k, last[k][1] if k in last else v, last[k][0] if k in last else None) for i, k, v in records)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_lookup_join_against_brute_force(spark, limit):
    rng = random.Random(3)
    keys = [None, *range(20)]
    records = [(i, 7 if i % 3 == 0 else rng.choice(keys), f"v{i}") for i in range(6000)]
    lookup = [(rng.choice(keys[:15]), i, rng.choice([None, f"l{i}"])) for i in range(60)]
    left = spark.createDataFrame(records, "id int, k int, v string").repartition(4)
    right = spark.createDataFrame(lookup, "key int, ord int, v string")
    rows = lookup_join(left, right, {"k": "key"}, ["ord"], limit, rows_per_task=500)
    assert rows.columns == ["id", "k", "v", "key", "ord"]
    assert Counter((r.id, r.k, r.v, r.ord) for r in rows.collect()) == looked_up(records, lookup)


def test_hot_keys_are_found_and_few(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS k")
    assert [(r.k, r._salts) for r in hot_keys(rows, ["k"], 1000).collect()] == [(-1, 10)]
    assert hot_keys(rows, ["k"], 100_000).count() == 0


def test_join_columns_must_exist(spark):
    rows = spark.range(1)
    with pytest.raises(ValueError):
        lookup_join(rows, rows, {"nope": "id"}, ["id"])
    with pytest.raises(ValueError):
        lookup_join(rows, rows, {}, ["id"])


def test_size_is_measured_not_estimated(spark):
    rows = spark.range(1000).selectExpr("id", "repeat('x', 1000) AS t")
    assert fits_broadcast(rows, 2_000_000) and not fits_broadcast(rows, 500_000)


def test_increment_bounds(spark):
    rows = spark.createDataFrame([(1,), (5,), (9,), (None,)], "c int")
    assert within(rows, "c", Bounds(None, 5)).count() == 3
    assert sorted(r.c for r in within(rows, "c", Bounds("1", 9)).collect()) == [5, 9]
    assert within(rows, "c", Bounds("9", 9)).count() == 0


@pytest.mark.parametrize("kind, low, values", [
    ("date", "2024-01-02", ["2024-01-01", "2024-01-02", "2024-01-03"]),
    ("timestamp", "2024-01-02 00:00:00", ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 00:00:00.5"]),
    ("timestamp_ntz", "2024-01-02 00:00:00", ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 00:00:01"]),
    ("bigint", "10", ["9", "10", "11"]),
])
def test_increment_of_all_column_types(spark, kind, low, values):
    rows = spark.createDataFrame([(v,) for v in values], "t string").selectExpr("t", f"CAST(t AS {kind}) AS c")
    audit = spark.createDataFrame([("j", "t", low, "COMPLETED", "2024-01-01 00:00:00"), ("j", "t", "99", "FAILED", "2025-01-01 00:00:00")],
                                  "job_name string, task_name string, delta_end_val string, status string, end string")
    audit = audit.selectExpr("job_name", "task_name", "delta_end_val", "status", "CAST(end AS timestamp) AS end_ts")
    found, bounds = increment(rows, "c", audit, "j", "t")
    assert [r.t for r in found.collect()] == [values[2]] and bounds.low == low
    assert latest_runs(audit).first().delta_end_val == low


def test_typed_bounds_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS c").write.parquet(str(tmp_path / "t"))
    plan = within(spark.read.parquet(str(tmp_path / "t")), "c", Bounds("10", 20))._jdf.queryExecution().toString()
    assert "GreaterThan(c,10)" in plan and "LessThanOrEqual(c,20)" in plan
    assert spark.range(1).select(delta_literal("2024-01-01", "DATE")).dtypes[0][1] == "date"


def test_numbers_within_groups_have_no_gaps(spark):
    rows = spark.range(5000).selectExpr("1 AS copy", "IF(id % 3 = 0, 'hot', IF(id % 11 = 0, NULL, CAST(id % 11 AS string))) AS g")
    found = defaultdict(list)
    for r in number_within(rows, ["g"], "n", rows_per_slice=300).collect():
        found[r.g].append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in found.values())


def test_batches_are_full_but_for_the_last(spark):
    rows = spark.range(2500).selectExpr("id", "TIMESTAMP'2024-01-01 00:00:00' + MAKE_INTERVAL(0,0,0,0,0,0,id % 60) AS ts")
    sizes = sorted(r["count"] for r in window_batches(rows, "ts", 1).groupBy("window_start", "batch_no").count().collect())
    assert sizes == [500, 1000, 1000]


def test_half_minute_windows(spark):
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP'2024-01-01 00:00:29'), (TIMESTAMP'2024-01-01 00:00:30') AS t(ts)")
    assert window_counts(rows, "ts", 0.5).count() == 2


def test_target_text():
    targets = [{"bigquery_stream": {"target_table": "a.b"}}, {"kafka": {"topic_name": "t"}}, {"rdbms": {"tablename": "x"}}, {"gcs": {"path": "p"}}]
    assert target_text(targets) == "{\"bigquery\": a.b},{\"kafka\": t},{\"rdbms\": x},{'gcs': {'path': 'p'}}"


def test_late_rows_at_the_edge_of_an_increment(spark):
    """Over random loads of a growing source each row comes once, ties with the bound, rows without a value and copies included."""
    rng = random.Random(3)
    rows = [(i % 90, rng.choice([None, 1, 2, 3, 3, 3]) if i < 150 else rng.choice([None, 3, 4, 4])) for i in range(240)]
    schema, seen, previous, loaded = "id int, c int", None, None, []
    for size in (0, 40, 40, 150, 170, 0, 240, 240):
        source = spark.createDataFrame(rows[:size], schema).repartition(3)
        bounds = Bounds(previous, column_maximum(source, "c", previous))
        new, bounds = with_ties(source, "c", bounds, seen)
        loaded += [tuple(r) for r in new.collect()]
        seen, previous = bounds.edge, bounds.high
    # Only what comes late with a value below the bound is out of reach of increments.
    below, reach, high = Counter(), 0, None
    for size in (40, 150, 170, 240):
        for row in rows[reach:size]:
            if row[1] is not None and high is not None and row[1] < high:
                below[row] += 1
        high, reach = max([r[1] for r in rows[:size] if r[1] is not None], default=high), size
    assert Counter(loaded) == Counter(rows) - below


def test_a_load_before_edges_were_kept(spark):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "id int, c int")
    new, bounds = with_ties(rows, "c", Bounds("5", "6"), None)
    assert [r.id for r in new.collect()] == [3] and bounds.edge.count() == 2
