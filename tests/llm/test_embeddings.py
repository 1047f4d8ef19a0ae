import numpy as np
import pytest

from weirgate.llm import embeddings
from weirgate.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow_links(rows, cosine=0.95):
    """Links of each row and its component, by comparing all with all."""
    keys = sorted(k for k, _ in rows)
    vectors = {k: np.array(v, float) / np.linalg.norm(v) for k, v in rows}
    links = {k: [o for o in keys if o != k and len(vectors[o]) == len(vectors[k]) and vectors[o] @ vectors[k] >= cosine] for k in keys}
    names = {}
    for key in keys:
        waiting = [key]
        while waiting:
            at = waiting.pop()
            if at not in names:
                names[at] = key
                waiting += links[at]
    return {k: (len(links[k]), names[k]) for k in keys}


def crowd(seed, clusters, dims=24):
    random = np.random.default_rng(seed)
    rows = []
    for size, spread in clusters:
        centre = random.normal(size=dims)
        rows += [centre + spread * random.normal(size=dims) * np.linalg.norm(centre) / np.sqrt(dims) for _ in range(size)]
    return [(i, v.astype("float32").tolist()) for i, v in enumerate(rows)]


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op2_embeddings"](spark, sf_dir).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == slow_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_crowds_and_chains(spark, monkeypatch):
    """Groups of near copies, tight and loose, over several shards and blocks."""
    monkeypatch.setattr(embeddings, "SHARD", 60)
    monkeypatch.setattr(embeddings, "LARGEST", 90)
    rows = crowd(1, [(150, 0.05), (60, 0.2), (40, 0.3)] + [(1, 0.0)] * 250 + [(3, 0.1)] * 30)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    found = embeddings.near_duplicates(frame).collect()
    want = slow_links(rows)
    right = sum((r.n_links, r.component) == want[r.vec_id] for r in found)
    assert found[0].recall >= embeddings.RECALL
    assert right >= 0.97 * len(rows)
    assert all(r.n_links <= want[r.vec_id][0] for r in found)  # nothing below the limit is linked


def test_equal_vectors_count_each_other(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(500)] + [(500 + i, [1.0, 2.0, 3.01], 0) for i in range(100)] + [(900, [3.0, -1.0, 0.0], 0)]
    found = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert {found[i].n_links for i in range(600)} == {599}
    assert {found[i].component for i in range(600)} == {0}
    assert (found[900].n_links, found[900].component) == (0, 900)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0),
        (7, [1.0, 0.0], None), (8, [2.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.01], 0), (7, [1.0, 0.0], 0),
        (10, [1e30, 1e30], 0), (11, [1e-30, 1e-30], 0), (12, [-1.0, 0.0], 0), (13, [-0.0, 1.0], 0), (14, [0.0, 1.0], 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "id")
    found = embeddings.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    by_key = {r.vec_id: (r.n_links, r.component) for r in found}
    assert all(by_key[k] == (0, k) for k in (1, 2, 3, 4, 5, 6, 9, 12))
    assert by_key[7] == by_key[8] == by_key[None] == (3, 7)
    assert by_key[10] == by_key[11] == (1, 10)
    assert by_key[13] == by_key[14] == (1, 13)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_recall_is_unknown_without_links(spark):
    rows = [(i, [float(i == k) for k in range(12)], 0) for i in range(12)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.recall for r in found] == [None] * 12 and {r.n_links for r in found} == {0}


@pytest.mark.parametrize("n", [1, 2, 5])
def test_pruning_keeps_the_nearest(n):
    x = np.random.default_rng(n).normal(size=(n + 1, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = np.argsort(-(x @ x[0]))[None, :]
    kept = embeddings.prune(x, near, np.array([0]))
    assert kept[0].sum() >= 1 and kept[0][list(near[0]).index(near[0][1])]
