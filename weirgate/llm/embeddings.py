"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal vectors are one. The others go to overlapping shards, those of their nearest centroids. In each shard every vector
gets neighbours, pruned so that none can be reached more cheaply through another; the neighbour lists of all shards
are united. A search per vector then walks greedily from the shard's medoid to where the graph comes no closer, and
from there, and from the vector itself, expands over all neighbours in range until none is new. What it meets is verified by
its cosine in double precision.

A bounded set of vectors is compared with all others by brute force. If the search missed too many of the links
found so, all is done again with twice the overlap and twice the neighbours looked at; at the latest when every
shard holds everything, nothing can be missed.

A shard too large for a task is cut into blocks, and every two of its blocks are a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages
from weirgate.llm.components import components

COSINE = 0.95
#: Vectors of a shard on average and at most; a larger one is cut into blocks of the first size.
SHARD, LARGEST = 1024, 4096
#: Vectors the centroids are fitted to, vectors per centroid among them at least, and rounds of fitting.
FIT_ROWS, FIT_EACH, FIT_ROUNDS = 16_384, 16, 8
OVERLAP = 2
#: Nearest and random vectors looked at for each vector, neighbours kept, and how much longer a way round may be.
NEAREST, RANDOM, DEGREE, ALPHA = 48, 16, 32, 1.2
#: How far out of range the search still expands.
SLACK = 0.03
AUDITED, RECALL = 512, 0.995
CHUNK = 256


def _unit_vectors(column: pa.Array) -> list[bytes | None]:
    """Vectors of length 1 as doubles; None for those that link with nothing."""
    out: list[bytes | None] = []
    for item in column:
        values = None if not item.is_valid else item.values
        if values is None or len(values) == 0 or values.null_count:
            out.append(None)
            continue
        vector = values.to_numpy(zero_copy_only=False).astype(np.float64)
        largest = np.abs(vector).max()
        if not np.isfinite(largest) or largest == 0:
            out.append(None)
            continue
        vector = vector / largest + 0.0  # no negative zeros
        out.append((vector / np.sqrt(vector @ vector)).tobytes())
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = pa.array(_unit_vectors(batch.column(1)), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["id", "vector"])


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def fit_centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of the sample."""
    centroids = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        nearest = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def _assign(centroids: dict[int, np.ndarray], overlap: int):
    """Shards of a vector: its length, and the nearest centroids among those of that length."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out_id, out_shard, out_vector = [], [], []
            by_size: dict[int, list[int]] = {}
            for at, vector in enumerate(vectors):
                by_size.setdefault(len(vector), []).append(at)
            for size, rows in by_size.items():
                table = centroids.get(size)
                x = np.frombuffer(b"".join(vectors[at] for at in rows), np.float64).reshape(len(rows), -1)
                if table is None:
                    nearest = np.zeros((len(rows), 1), int)
                else:
                    take = min(overlap, len(table))
                    nearest = np.argpartition(-(x @ table.T), take - 1, axis=1)[:, :take]
                for at, shards in zip(rows, nearest, strict=True):
                    for shard in shards.tolist():
                        out_id.append(ids[at])
                        out_shard.append(f"{size}/{shard}")
                        out_vector.append(vectors[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_shard, pa.string()), pa.array(out_id, pa.int64()), pa.array(out_vector, pa.binary())],
                names=["shard", "id", "vector"],
            )

    return assign


def shards(stages: Stages, vectors: DataFrame, overlap: int) -> DataFrame:
    """``(shard, id, vector)``: each vector in the shards of its nearest centroids, none above ``LARGEST`` or so."""
    n = vectors.count()
    share = min(1.0, FIT_ROWS / max(1, n))
    chosen = vectors.where(F.expr(f"pmod(xxhash64(id), {2**20})") < int(share * 2**20))
    centroids = {}
    by_size: dict[int, list[bytes]] = {}
    for row in chosen.select("vector").collect():  # FIT_ROWS at most about
        by_size.setdefault(len(row.vector), []).append(bytes(row.vector))
    for size, sample in by_size.items():
        rows = np.frombuffer(b"".join(sorted(sample)), np.float64).reshape(len(sample), -1)
        k = max(1, min(int(np.ceil(len(sample) / share / SHARD)), len(sample) // FIT_EACH))
        centroids[size] = fit_centroids(rows, k)
    rows = stages.put(vectors.select("id", "vector").mapInArrow(_assign(centroids, overlap), "shard string, id bigint, vector binary"))
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > LARGEST)
    sizes = stages.put(sizes.select("shard", F.ceil(F.col("n") / SHARD).cast("int").alias("blocks")))
    if sizes.isEmpty():
        return rows
    rows = rows.join(sizes, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.expr("CAST(pmod(xxhash64(id), blocks) AS int)")
    others = F.expr("CASE WHEN blocks = 1 THEN array(0) ELSE filter(sequence(0, blocks - 1), b -> b <> block) END")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(others))
    pair = F.concat_ws("/", "shard", F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string"))
    return stages.put(rows.select(pair.alias("shard"), "id", "vector"))


def prune(x: np.ndarray, near: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which of the candidates of each row stay: robust pruning, nearest first.

    A candidate goes if a kept one is nearer to it, by ``ALPHA``, than the row itself is.
    """
    points = x[near]
    own = np.clip(2 - 2 * np.einsum("rcd,rd->rc", points, x[rows]), 0, 4)
    between = np.clip(2 - 2 * np.einsum("rcd,red->rce", points, points), 0, 4)
    alive, kept = near != rows[:, None], np.zeros(near.shape, bool)
    degree = np.zeros(len(rows), int)
    for c in range(near.shape[1]):
        take = alive[:, c] & (degree < DEGREE)
        kept[:, c] = take
        degree += take
        alive &= ~(take[:, None] & (ALPHA * ALPHA * between[:, c] <= own))
    return kept


def _build(nearest: int):
    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Neighbours of each vector of a shard, in both directions."""
        ids, x = group["id"].to_numpy(), _matrix(group["vector"])
        random = np.random.default_rng(len(ids))
        out_a, out_b = [], []
        for at in range(0, len(ids), CHUNK):
            rows = np.arange(at, min(at + CHUNK, len(ids)))
            likeness = x[rows] @ x.T
            take = min(nearest + 1, len(ids))
            near = np.argpartition(-likeness, take - 1, axis=1)[:, :take]
            far = random.integers(0, len(ids), (len(rows), RANDOM))
            near = np.concatenate([near, far], axis=1)
            order = np.argsort(-np.take_along_axis(likeness, near, axis=1), axis=1, kind="stable")
            near = np.take_along_axis(near, order, axis=1)
            kept = prune(x, near, rows)
            out_a.append(np.repeat(rows, kept.sum(axis=1)))
            out_b.append(near[kept])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        a, b = np.unique(np.stack([np.concatenate([a, b]), np.concatenate([b, a])], axis=1), axis=0).T
        lists = np.split(ids[b], np.searchsorted(a, np.arange(1, len(ids))))
        return pd.DataFrame({"id": ids, "near": [v.tolist() for v in lists]})

    return build


def _search(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Links ``(a, b)`` with ``a < b`` that the searches of a shard's vectors meet."""
    group = group.sort_values("id", ignore_index=True)
    ids, x = group["id"].to_numpy(), _matrix(group["vector"])
    graph = []
    for near in group["near"]:
        found = np.searchsorted(ids, np.asarray(near, np.int64))
        found = np.minimum(found, len(ids) - 1)
        graph.append(np.unique(found[ids[found] == np.asarray(near, np.int64)]))
    middle = x.sum(axis=0)
    medoid = int(np.argmax(x @ middle))
    out_a, out_b = [], []
    seen = np.zeros(len(ids), bool)
    for row in range(len(ids)):
        query = x[row]
        place, best = medoid, float(x[medoid] @ query)
        while len(graph[place]):
            values = x[graph[place]] @ query
            top = int(np.argmax(values))
            if values[top] <= best:
                break
            place, best = int(graph[place][top]), float(values[top])
        front = np.unique([row, place] if best >= COSINE - SLACK else [row])
        met = [front]
        seen[front] = True
        while len(front):
            steps = np.concatenate([graph[i] for i in front])
            steps = np.unique(steps[~seen[steps]])
            seen[steps] = True
            met.append(steps)
            front = steps[x[steps] @ query >= COSINE - SLACK]
        met = np.concatenate(met)
        seen[met] = False
        linked = met[(x[met] @ query >= COSINE) & (met != row)]
        out_a.append(np.full(len(linked), row))
        out_b.append(linked)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = np.unique(np.stack([low, high], axis=1), axis=0)
    return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})


def graph_links(stages: Stages, vectors: DataFrame, overlap: int, nearest: int) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, between vectors of ``(id, vector)`` that are found through the graph."""
    members = shards(stages, vectors, overlap)
    near = members.groupBy("shard").applyInPandas(_build(nearest), "id bigint, near array<bigint>")
    near = stages.put(near.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    found = members.join(near, "id").groupBy("shard").applyInPandas(_search, "a bigint, b bigint")
    return stages.put(found.distinct())


def _brute(queries: list[tuple[int, bytes]]):
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(v) for _, v in queries}:
        some = [(i, v) for i, v in queries if len(v) == size]
        x = np.frombuffer(b"".join(v for _, v in some), np.float64).reshape(len(some), -1)
        by_size[size] = np.array([i for i, _ in some]), x

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for size, (names, x) in by_size.items():
                rows = np.array([at for at, v in enumerate(vectors) if len(v) == size], int)
                for at in range(0, len(rows), CHUNK):
                    part = rows[at : at + CHUNK]
                    y = np.frombuffer(b"".join(vectors[i] for i in part), np.float64).reshape(len(part), -1)
                    i, j = np.nonzero(x @ y.T >= COSINE)
                    a, b = names[i], ids[part[j]]
                    out_a.append(np.minimum(a, b)[a != b])
                    out_b.append(np.maximum(a, b)[a != b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_a), pa.int64()), pa.array(np.concatenate(out_b), pa.int64())], names=["a", "b"]
            )

    return compare


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(key, n_links, component, recall)`` for every row.

    ``n_links`` counts the other rows whose cosine is at least ``COSINE``, ``component`` is the smallest key that can be
    reached by links, ``recall`` the share of the audited links that the search found, null if there were none. Rows whose vector is null,
    empty, zero, or holds null or non-finite components have no links; vectors of different lengths none with
    each other. Repeated rows link like others. Null keys count as links and are never a component's name. An
    empty table gives an empty one.
    """
    stages = Stages(table.sparkSession, "embeddings")
    rows = stages.put(
        table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("values")).mapInArrow(_units, "id bigint, vector binary")
    )
    valid = rows.where("vector IS NOT NULL")
    classes = valid.groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = stages.put(classes.withColumn("id", F.monotonically_increasing_id()))
    n = classes.count()
    share = min(1.0, AUDITED / max(1, n))
    chosen = classes.where(F.expr(f"pmod(xxhash64(vector), {2**20})") < int(np.ceil(share * 2**20)))
    queries = [(r.id, bytes(r.vector)) for r in chosen.select("id", "vector").collect()]  # AUDITED at most about
    truth = stages.put(classes.select("id", "vector").mapInArrow(_brute(queries), "a bigint, b bigint").distinct())
    total = truth.count()
    overlap, nearest = OVERLAP, NEAREST
    while True:
        links = graph_links(stages, classes, overlap, nearest)
        found = truth.join(links, ["a", "b"], "left_semi").count()
        recall = found / total if total else 1.0
        if recall >= RECALL or overlap * SHARD > 2 * n:
            break
        overlap, nearest = 2 * overlap, 2 * nearest
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
    copies = classes.select(F.col("id").alias("b"), "copies")
    degrees = stages.put(
        both.select(F.col("l.a").alias("a"), F.col("l.b").alias("b")).join(copies, "b")
        .groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others"))
    )
    groups = components(links).withColumnRenamed("node", "id").withColumnRenamed("component", "top")
    named = classes.drop("vector").join(degrees, "id", "left").join(groups, "id", "left")
    named = stages.put(named.withColumn("top", F.coalesce("top", "id")))
    tops = stages.put(named.groupBy("top").agg(F.min("least").alias("component")))
    named = stages.put(
        classes.select("id", "vector")
        .join(named.join(tops, "top").select("id", "copies", "others", "component"), "id")
        .select("vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component")
    )
    result = (
        valid.join(named, "vector").select("id", "n_links", "component")
        .unionByName(rows.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
        .select(F.col("id").alias(key), "n_links", "component", F.lit(recall if total else None).cast("double").alias("recall"))
    )
    stages.drop(rows, named)
    return result
