"""Nearest neighbours by a hierarchical k-means tree that is searched best bin first.

A bounded sample gives the upper tree, k-means below k-means; every vector goes down it to a leaf. A leaf that
is still too large gets a tree of its own from a bounded sample of what it holds, and so on, so that leaves stay small
however many vectors there are, and no task or driver holds more than one such tree of each dimension.

A query walks down to the nearest leaf; what it passes by waits in a priority queue, nearest centre first, from which it
goes on until it has visited so many leaves. How many, is calibrated: a bounded set of queries is compared with all vectors,
and visits widen until they cover the wanted share of the true neighbours, at the latest when they cover all leaves.
What the leaves hold is compared in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from weirgate.llm.common import Stages, returning

NEIGHBOURS = 10
#: Vectors of a leaf on average, and at most, if they can be told apart.
LEAF, LARGEST = 512, 4096
#: Children of a node, vectors a tree is fitted to and those of its smallest leaf, rounds of fitting.
BRANCH, FIT_ROWS, FIT_EACH, FIT_ROUNDS = 8, 16_384, 16, 8
#: Queries that are compared with everything, the share of their neighbours the visits have to cover, the first visits.
CALIBRATED, RECALL, VISITS = 256, 0.95, 16
#: Queries that are compared with a leaf together, and vectors that are sent down a small tree together.
TOGETHER = 4096
CHUNK = 256


class Tree(NamedTuple):
    """Nodes by number, the root first: their centres, first children and numbers of children."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _means(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """K-means from evenly spaced rows: the centres, and the one of each row."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        labels = _nearest(x, centres)
        sizes = np.bincount(labels, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, labels, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres, _nearest(x, centres)


def grow(sample: np.ndarray, most: int) -> Tree:
    """K-means below k-means until no leaf holds more than ``most`` different rows of the sample."""
    sample = np.unique(sample, axis=0)
    centres, first, count = [sample.mean(axis=0)], [0], [0]
    waiting = [(0, np.arange(len(sample)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= most:
            continue
        means, labels = _means(sample[rows], min(BRANCH, -(-len(rows) // most)))
        used = np.unique(labels)
        if len(used) < 2:
            continue
        first[node], count[node] = len(centres), len(used)
        for label in used:
            waiting.append((len(centres), rows[labels == label]))
            centres.append(means[label])
            first.append(0)
            count.append(0)
    return Tree(np.array(centres), np.array(first), np.array(count))


def descend(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: from every node to its nearest child."""
    nodes = np.zeros(len(x), int)
    open_ = np.flatnonzero(tree.count[nodes])
    while len(open_):
        for node in np.unique(nodes[open_]):
            rows = open_[nodes[open_] == node]
            children = slice(tree.first[node], tree.first[node] + tree.count[node])
            nodes[rows] = tree.first[node] + _nearest(x[rows], tree.centres[children])
        open_ = open_[tree.count[nodes[open_]] > 0]
    return nodes


def best_bins(tree: Tree, query: np.ndarray, visits: int) -> list[tuple[int, float]]:
    """The first leaves that a best-bin-first walk visits, with the squared distances of their centres."""
    queue: list[tuple[float, int]] = [(0.0, 0)]
    found = []
    while queue and len(found) < visits:
        near, node = heappop(queue)
        while tree.count[node]:
            begin = int(tree.first[node])
            apart = ((tree.centres[begin : begin + tree.count[node]] - query) ** 2).sum(axis=1)
            best = int(np.argmin(apart))
            for i, value in enumerate(apart.tolist()):
                if i != best:
                    heappush(queue, (value, begin + i))
            near, node = float(apart[best]), begin + best
        found.append((node, near))
    return found


def _pack(tree: Tree) -> dict:
    return {"centres": tree.centres.tobytes(), "first": tree.first.tolist(), "count": tree.count.tolist()}


def _unpack(row) -> Tree:
    count = np.asarray(row["count"], int)
    return Tree(np.frombuffer(row["centres"], np.float64).reshape(len(count), -1), np.asarray(row["first"], int), count)


TREE = "leaf string, centres binary, first array<int>, count array<int>"


def _vectors(kind: str):
    """Vectors as bytes of their own type; rows whose vector takes no part are left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for row, item in enumerate(batch.column(1)):
                values = item.values if item.is_valid else None
                if values is None or len(values) == 0 or values.null_count:
                    continue
                vector = values.to_numpy(zero_copy_only=False)
                if np.isfinite(vector).all() and vector.any():
                    at.append(row)
                    out.append((vector + 0.0).astype(kind).tobytes())  # no negative zeros
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(out, pa.binary())], names=["id", "vector"])

    return read


def _matrix(vectors, kind: str) -> np.ndarray:
    vectors = list(vectors)
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)


def _by_size(vectors: list[bytes]) -> dict[int, list[int]]:
    rows: dict[int, list[int]] = {}
    for at, vector in enumerate(vectors):
        rows.setdefault(len(vector), []).append(at)
    return rows


def _share(chosen: Column, share: Column) -> Column:
    """Whether a row belongs to a sample of that share, by hash."""
    return F.pmod(F.xxhash64(chosen, F.lit("sample")), F.lit(1 << 20)) < F.ceil(share * (1 << 20))


def nearest(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of each query but those with its id: numbers of queries, of rows, distances."""
    squares = (x * x).sum(axis=1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queries), CHUNK):
        part = queries[at : at + CHUNK]
        ours = (part * part).sum(axis=1)
        rough = squares[None, :] + ours[:, None] - 2 * (part @ x.T)
        same = own[at : at + CHUNK, None] == ids[None, :]
        rough[same] = np.inf
        # What rounding may have put in the wrong order, or has lost, is looked at again.
        limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(part), np.inf)
        limit = limit + 1e-12 * (limit + ours + squares.max(initial=0.0))
        for i in range(len(part)):
            rows = np.flatnonzero(~(rough[i] > limit[i]) & ~same[i])
            apart = np.sqrt(((x[rows] - part[i]) ** 2).sum(axis=1))
            order = np.lexsort((ids[rows], apart))[:k]
            out.append((np.full(len(order), at + i), rows[order], apart[order]))
    if not out:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


class Index:
    """Vectors ``(id, vector, leaf)`` in the leaves of trees: ``top`` by length of vector, ``lower`` trees by leaf."""

    def __init__(self, stages: Stages, points: DataFrame, kind: str) -> None:
        self.stages, self.kind, self.lower = stages, kind, []
        n = points.count()
        share = min(1.0, FIT_ROWS / max(1, n))
        sample = [bytes(r.vector) for r in points.where(_share(F.col("id"), F.lit(share))).select("vector").collect()]  # FIT_ROWS about
        self.top = {
            size: grow(_matrix([sample[at] for at in rows], kind), self._most(share)) for size, rows in _by_size(sample).items()
        }
        points = stages.put(points.mapInArrow(self._assign(), "id bigint, vector binary, leaf string"))
        while True:
            leaves = stages.put(points.groupBy("leaf").agg(F.count("*").alias("n")))
            large = leaves.where(F.col("n") > LARGEST)
            if large.isEmpty():
                break
            points = self._split(points, large)
        self.points, self.leaves = points, leaves.count()

    def _most(self, share: float) -> int:
        return max(FIT_EACH, int(LEAF * share))

    def _assign(self):
        top, kind = self.top, self.kind

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = batch.column(1).to_pylist()
                leaves = [""] * len(vectors)
                for size, rows in _by_size(vectors).items():
                    tree = top.get(size)
                    nodes = descend(tree, _matrix([vectors[at] for at in rows], kind)) if tree else np.zeros(len(rows), int)
                    for at, node in zip(rows, nodes.tolist(), strict=True):
                        leaves[at] = f"{size}/{node}"
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.string())], names=["id", "vector", "leaf"])

        return lambda batches: returning(assign(batches))

    def _split(self, points: DataFrame, large: DataFrame) -> DataFrame:
        """Points whose large leaves are leaves of lower trees instead."""
        kind, each, leaf_rows, fit_rows = self.kind, FIT_EACH, LEAF, FIT_ROWS

        def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            share = min(1.0, fit_rows / int(group["n"].iloc[0]))
            tree = grow(_matrix(group.sort_values("id")["vector"], kind), max(each, int(leaf_rows * share)))
            return pd.DataFrame([{"leaf": key[0], **_pack(tree)}])

        def place(key: tuple, group: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            if not len(group):
                return pd.DataFrame({"id": [], "vector": [], "leaf": []})
            nodes = descend(_unpack(trees.iloc[0]), _matrix(group["vector"], kind))
            return pd.DataFrame({"id": group["id"], "vector": group["vector"], "leaf": [f"{key[0]}/{node}" for node in nodes.tolist()]})

        rows = points.join(large, "leaf", "left")
        few = rows.where("n IS NULL").select("id", "vector", "leaf")
        many = self.stages.put(rows.where("n IS NOT NULL"))
        sample = many.where(_share(F.col("id"), F.least(F.lit(1.0), FIT_ROWS / F.col("n"))))
        trees = self.stages.put(sample.groupBy("leaf").applyInPandas(fit, TREE))
        self.lower.append(trees)
        blocks = large.select("leaf", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / TOGETHER).cast("int") - 1)).alias("block"))
        block = F.pmod(F.xxhash64("id", F.lit("block")), F.ceil(F.col("n") / TOGETHER)).cast("int")
        placed = (
            many.select("leaf", block.alias("block"), "id", "vector").groupBy("leaf", "block")
            .cogroup(trees.join(blocks, "leaf").select("leaf", "block", "centres", "first", "count").groupBy("leaf", "block"))
            .applyInPandas(place, "id bigint, vector binary, leaf string")
        )
        split = self.stages.put(few.unionByName(placed))
        self.stages.forget(points, many)
        return split

    def visits(self, queries: DataFrame, visits: int) -> DataFrame:
        """``(query, vector, leaf, rank)``: for each ``(query, vector)`` the leaves to visit, nearest centre first."""
        top, kind = self.top, self.kind

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                out = []
                for name, vector in zip(names, vectors, strict=True):
                    tree = top.get(len(vector))
                    bins = best_bins(tree, _matrix([vector], kind)[0], visits) if tree else [(0, 0.0)]
                    out += [(name, vector, f"{len(vector)}/{node}", near) for node, near in bins]
                columns = zip(*out, strict=True) if out else ((), (), (), ())
                types = (pa.int64(), pa.binary(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query", "vector", "leaf", "near"])

        def walk_on(key: tuple, group: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(group):
                tree = _unpack(trees.iloc[0])
                for name, vector in zip(group["query"], group["vector"], strict=True):
                    for node, near in best_bins(tree, _matrix([vector], kind)[0], visits):
                        out.append((name, vector, f"{key[0]}/{node}", near))
            return pd.DataFrame(out, columns=["query", "vector", "leaf", "near"])

        order = Window.partitionBy("query", "vector").orderBy("near", "leaf")
        shape = "query bigint, vector binary, leaf string, near double"
        ways = self.stages.put(queries.select("query", "vector").mapInArrow(walk, shape))
        for trees in self.lower:
            inside = self.stages.put(ways.join(trees.select("leaf"), "leaf", "left_semi").select("query", "vector", "leaf"))
            crowds = inside.groupBy("leaf").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("blocks"))
            crowds = self.stages.put(crowds)
            block = F.pmod(F.xxhash64("query", "vector"), F.col("blocks").cast("long")).cast("int")
            parts = crowds.select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
            parts = trees.join(parts, "leaf").select("leaf", "block", "centres", "first", "count")
            asked = inside.join(crowds, "leaf").select("leaf", block.alias("block"), "query", "vector")
            deeper = asked.groupBy("leaf", "block").cogroup(parts.groupBy("leaf", "block")).applyInPandas(walk_on, shape)
            ways = ways.join(trees.select("leaf"), "leaf", "left_anti").select("query", "vector", "leaf", "near").unionByName(deeper)
            ways = ways.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= visits).drop("rank")
            ways = self.stages.put(ways)
        return ways.withColumn("rank", F.row_number().over(order)).drop("near")

    def scan(self, visits: DataFrame, k: int) -> DataFrame:
        """The ``k`` nearest of each visit ``(query, vector, leaf)``: ``(query, vector, id, score)``."""
        kind = self.kind

        def compare(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(queries) or not len(rows):
                return pd.DataFrame({"query": [], "vector": [], "id": [], "score": []})
            ids, own = rows["id"].to_numpy(), queries["query"].to_numpy()
            q, i, score = nearest(_matrix(rows["vector"], kind), ids, _matrix(queries["vector"], kind), own, k)
            return pd.DataFrame({"query": own[q], "vector": queries["vector"].to_numpy()[q], "id": ids[i], "score": score})

        crowds = self.stages.put(visits.groupBy("leaf").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("blocks")))
        block = F.pmod(F.xxhash64("query", "vector"), F.col("blocks").cast("long")).cast("int")
        asked = visits.join(crowds, "leaf").select("leaf", block.alias("block"), "query", "vector")
        parts = crowds.select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        held = self.points.join(parts, "leaf").select("leaf", "block", "id", "vector")
        groups = asked.groupBy("leaf", "block").cogroup(held.groupBy("leaf", "block"))
        return groups.applyInPandas(compare, "query bigint, vector binary, id bigint, score double")


def brute_force(points: DataFrame, queries: list[tuple[int, bytes]], kind: str, k: int) -> DataFrame:
    """``(query, vector, id, leaf, score, rank)``: the ``k`` nearest of a bounded list of queries among all points."""
    tables = {size: [queries[at] for at in rows] for size, rows in _by_size([v for _, v in queries]).items()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, leaves = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2)
            rows_of = _by_size(vectors)
            for size, asked in tables.items():
                at = np.array(rows_of.get(size, []), int)
                if not len(at):
                    continue
                own = np.array([name for name, _ in asked])
                x, y = _matrix([vectors[i] for i in at], kind), _matrix([v for _, v in asked], kind)
                q, i, score = nearest(x, ids[at], y, own, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[q]), pa.array([asked[j][1] for j in q], pa.binary()), pa.array(ids[at[i]]), leaves.take(pa.array(at[i])), pa.array(score)],
                    names=["query", "vector", "id", "leaf", "score"],
                )

    found = points.select("id", "vector", "leaf").mapInArrow(compare, "query bigint, vector binary, id bigint, leaf string, score double")
    order = Window.partitionBy("query", "vector").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """``(query, rank, id, score, recall)``: the nearest rows found for each row that ``is_query`` holds for.

    Nearness is the Euclidean distance in double precision, ``score``; ties go to the smaller id. ``recall`` is the share
    of the calibrated queries' true neighbours that lie in the leaves they visit, null if there are none. Rows whose vector is null,
    empty, zero, or holds null or non-finite components, and rows without a key take no part. Vectors of different lengths are
    not near each other. A row is no candidate for queries with its own key; other repeated rows are candidates each,
    repeated queries are asked once, and a key with several vectors asks for each of them, in ranks of its own. A query with
    fewer candidates gets them all. An empty table, or one without queries, gives no rows. Other columns are not looked at.
    """
    stages = Stages(table.sparkSession, "neighbours")
    element = table.schema[vector].dataType
    kind = "<f4" if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else "<f8"
    asked = F.coalesce(is_query, F.lit(False)).alias("asked")
    rows = table.where(F.col(key).isNotNull()).select(F.struct(F.col(key).cast("long").alias("id"), asked).alias("row"), F.col(vector).alias("vector"))
    rows = stages.put(rows.mapInArrow(_vectors(kind), "id struct<id: bigint, asked: boolean>, vector binary").select("id.id", "id.asked", "vector"))
    queries = stages.put(rows.where("asked").select(F.col("id").alias("query"), "vector").distinct())
    # Of equal vectors no query can get more than the k with the smallest ids, besides its own.
    points = rows.withColumn("again", F.row_number().over(Window.partitionBy("vector", "id").orderBy("id"))).where(F.col("again") <= k)
    points = points.withColumn("among", F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("among") <= k + 1)
    index = Index(stages, stages.put(points.select("id", "vector")), kind)
    share = min(1.0, CALIBRATED / max(1, queries.count()))
    chosen = queries.where(_share(F.col("query"), F.lit(share)))
    some = [(r.query, bytes(r.vector)) for r in chosen.collect()]  # CALIBRATED about
    truth = stages.put(brute_force(index.points, some, kind, k).select("query", "vector", "leaf"))
    total = truth.count()
    visits, recall = VISITS, None
    while True:
        covered = index.visits(chosen, visits).join(truth, ["query", "vector", "leaf"]).groupBy("rank").count().collect()  # visits rows at most
        covered = dict(sorted((r["rank"], r["count"]) for r in covered))
        if not total or sum(covered.values()) >= RECALL * total or visits >= index.leaves:
            break
        visits = 2 * visits
    wanted, found = visits, 0
    for rank, count in covered.items():
        found, recall = found + count, (found + count) / total
        if recall >= RECALL:
            wanted = rank
            break
    ways = stages.put(index.visits(queries, visits).where(F.col("rank") <= wanted).drop("rank"))
    order = Window.partitionBy("query", "vector").orderBy("score", "id")
    found = index.scan(ways, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    result = stages.put(found.select("query", "rank", "id", "score", F.lit(recall).cast("double").alias("recall")))
    stages.drop(result)
    return result
