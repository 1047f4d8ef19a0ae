"""Folders of micro-batches that are merged, and lookups that are read once per period."""

import random

import pytest
from pyspark.sql import functions as F

from weirgate.sinks.batches import children, folder_of, label_of, live
from weirgate.sinks.tables import BATCH_COLUMN, read_table, write_stream_batch, write_table
from weirgate.streaming.snapshots import PeriodicLookup


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"row {i}") for i in ids], "id long, text string").coalesce(1)


def ids_of(spark, path):
    return sorted(r.id for r in read_table(spark, path).select("id").collect())


def test_many_batches_lie_in_few_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    target = {"target_table": path, "merge_batches": 4}
    for batch in range(22):
        write_stream_batch(frame(spark, batch, 1000 + batch), target, batch)
        if batch in (3, 4, 5, 16):  # repeated before anything else is written
            write_stream_batch(frame(spark, batch, 1000 + batch), target, batch)
    assert ids_of(spark, path) == sorted([*range(22), *range(1000, 1022)])
    assert len(children(spark, path, f"{BATCH_COLUMN}=*")) <= 7
    write_stream_batch(frame(spark, 7, 1007), target, 7)  # one that was merged long ago
    assert ids_of(spark, path) == sorted([*range(22), *range(1000, 1022)])
    # Readers that know nothing of merging see the same rows.
    assert spark.read.parquet(path).count() == 44


def test_a_merge_that_was_cut_short(spark, tmp_path):
    """Folders that a merged one covers do not count, and go with the next batch."""
    path = str(tmp_path / "out")
    target = {"target_table": path, "merge_batches": 3}
    for batch in range(3):
        write_stream_batch(frame(spark, batch), target, batch)
    merged = f"{path}/{BATCH_COLUMN}={label_of(None, 0, 2)}"
    frame(spark, 0, 1, 2).write.parquet(merged)
    frame(spark, 0, 1).write.parquet(f"{path}/_merging/{label_of(None, 0, 1)}")
    assert ids_of(spark, path) == [0, 1, 2]
    write_stream_batch(frame(spark, 3), target, 3)
    assert ids_of(spark, path) == [0, 1, 2, 3]
    assert len(children(spark, path, f"{BATCH_COLUMN}=*")) == 2


def test_other_writers_stay_apart(spark, tmp_path):
    path = str(tmp_path / "out")
    target = {"target_table": path, "merge_batches": 2}
    write_table(frame(spark, 100), target)
    for batch in range(5):
        write_stream_batch(frame(spark, batch), target, batch)
        write_table(frame(spark, 200 + batch), target)
        frame(spark, 300 + batch).write.parquet(f"{path}/{BATCH_COLUMN}=another-{batch}")
    assert ids_of(spark, path) == sorted([100, *range(5), *range(200, 205), *range(300, 305)])


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "out")
    target = {"target_table": path, "merge_batches": 2}
    for batch in range(5):
        rows = frame(spark, batch)
        write_stream_batch(rows if batch < 2 else rows.withColumn("more", F.lit(batch)), target, batch)
    found = {r.id: r.more for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert found == {0: None, 1: None, 2: 2, 3: 3, 4: 4}


def test_live_folders_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        folders, at = [], 0
        while at < 60:
            size = rng.choice([1, 1, 4, 16])
            folders.append((at, at + size - 1))
            folders += [(i, i) for i in range(at, at + size) if rng.random() < 0.3]
            at += size
        names = {f"/t/b={label_of('3f2b-1', a, b if b > a else None)}" for a, b in folders} | {"/t/b=task_0", "/t/b=0", "/t/b=q-1_9"}
        every = [folder_of(n) for n in names]
        want = {f.path for f in every if not any(g != f and g.covers(f) for g in every)}
        assert {f.path for f in live(rng.sample(sorted(names), len(names)))} == want


class Counted:
    def __init__(self, values):
        self.values, self.reads = values, 0

    def __call__(self, spark):
        self.reads += 1
        return spark.createDataFrame([(self.values[0],)], "v int")


def test_a_lookup_is_read_once_a_period(spark, tmp_path):
    source, clock = Counted([1]), {"now": 1000.0}

    def lookup():
        return PeriodicLookup(source, str(tmp_path / "lookup"), 60, lambda: clock["now"])

    def value(found, batch):
        return found.at(spark, batch).first().v

    one = lookup()
    assert [value(one, b) for b in range(3)] == [1, 1, 1] and source.reads == 1
    source.values = [2]
    clock["now"] += 61
    assert value(one, 2) == 1  # repeated: what it had
    assert value(lookup(), 2) == 1  # after a restart, too
    assert value(one, 3) == 2 and source.reads == 2
    clock["now"] -= 500  # a clock that goes back makes no older version
    assert value(lookup(), 4) == 2 and source.reads == 2
    for batch in range(5, 20):
        clock["now"] += 700
        source.values = [batch]
        assert value(one, batch) == batch
    assert len(children(spark, str(tmp_path / "lookup"), "version=*")) <= 4
    assert len(children(spark, str(tmp_path / "lookup"), "batch=*")) <= 2
