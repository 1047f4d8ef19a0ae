import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgate.llm import neighbours
from weirgate.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow_search(rows, asked, k=10):
    """The nearest of each asked row ``(id, vector)``, by comparing it with all."""
    out = {}
    for query, vector in rows:
        if query is None or not asked(query):
            continue
        x = np.array(vector, np.float32).astype(float)
        near = sorted(
            (float(np.sqrt(((np.array(v, np.float32).astype(float) - x) ** 2).sum())), i)
            for i, v in rows
            if i is not None and i != query and len(v) == len(vector)
        )
        out[query] = near[:k]
    return out


def crowd(seed, clusters, dims=16):
    random = np.random.default_rng(seed)
    rows = []
    for size, spread in clusters:
        centre = random.normal(size=dims)
        rows += [(centre + spread * random.normal(size=dims)).astype("float32").tolist() for _ in range(size)]
    return list(enumerate(rows))


def answers(found):
    out = {}
    for row in found:
        out.setdefault(row["query"], []).append((row["rank"], row["score"], row["id"]))
    for rows in out.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    return {q: [r[1:] for r in rows] for q, rows in out.items()}


def share_found(got, want):
    total = sum(len(w) for w in want.values())
    for query, rows in got.items():
        assert len(rows) == len(want[query])
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items()) / total


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op12_neighbours"](spark, sf_dir).select(F.col("query_id").alias("query"), "rank", F.col("vec_id").alias("id"), "score").collect()
    want = slow_search(rows, lambda i: i % 100 == 0)
    got = answers(found)
    assert set(got) == set(want) and share_found(got, want) >= 0.9


def test_crowds_in_trees_below_trees(spark, monkeypatch):
    """A third of the vectors in one crowd, a bounded fit, leaves that are split again, few queries at a time."""
    for name, value in {"LEAF": 30, "LARGEST": 60, "FIT_ROWS": 200, "FIT_EACH": 8, "TOGETHER": 20, "VISITS": 4}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows = crowd(1, [(500, 0.02)] + [(40, 0.3)] * 20 + [(1, 0.0)] * 200)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    found = neighbours.search(frame, F.col("vec_id") % 10 == 0).collect()
    want = slow_search(rows, lambda i: i % 10 == 0)
    got = answers(found)
    assert set(got) == set(want) and share_found(got, want) >= 0.9
    assert found[0].recall >= 0.9
    scores = {(q, i): s for q, near in slow_search(rows, lambda i: i % 10 == 0, 10**6).items() for s, i in near}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, near in got.items() for s, i in near)


def test_equal_vectors_and_ties(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(40 + i, [1.0, 2.5]) for i in range(30)] + [(100, [1.0, 1.5]), (200, [9.0, 9.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    asked = {0, 5, 39, 40, 69, 100, 200}
    got = answers(neighbours.search(frame, F.col("vec_id").isin(*asked)).collect())
    want = slow_search(rows, lambda i: i in asked)
    assert {q: [i for _, i in near] for q, near in got.items()} == {q: [i for _, i in near] for q, near in want.items()}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]), (0, [1.0, 0.0])]
    schema = f"vec_id long, embedding array<{kind}>, id int, leaf string, rank int"
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in bad + good], schema)
    got = answers(neighbours.search(frame, F.col("vec_id").isNotNull()).collect())
    assert set(got) == {0, 7, 9, 10}  # the only vector of three components has no neighbour
    assert [i for _, i in got[0]] == [7, 7, 9, 10]
    assert got[9][0] == (0.0, 10)
    assert neighbours.search(frame.limit(0), F.lit(True)).count() == 0
    assert neighbours.search(frame, F.lit(False)).count() == 0


def test_large_numbers(spark):
    rows = [(i, [1e160 * (i + 1), 1.0]) for i in range(5)] + [(10, [1.0, 1.0]), (11, [1.0, 2.0])]
    got = answers(neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 10).collect())
    assert got[10][0] == (1.0, 11) and len(got[10]) == 6


def test_best_bins_visit_everything_in_the_end():
    x = np.random.default_rng(0).normal(size=(300, 5))
    tree = neighbours.grow(x, 10)
    leaves = set(np.flatnonzero(tree.count == 0).tolist())
    found = [node for node, _ in neighbours.best_bins(tree, x[0], 10**6)]
    assert set(found) == leaves and len(found) == len(leaves)
    assert found[0] == neighbours.descend(tree, x[:1])[0]
    assert set(neighbours.descend(tree, x).tolist()) <= leaves
