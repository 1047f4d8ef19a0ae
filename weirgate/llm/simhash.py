"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``radius`` bits also differ by at most
that much in how many bits are set, in all and, added up, in the four quarters of 16 bits. Fingerprints
are put into tiles by the population counts of their quarters. Only tiles whose counts are that close are
compared, by exclusive-or and bit counts over whole arrays; the others are skipped, and so are blocks inside
large tiles, by the counts of their bytes. No pair within the radius is lost.

Equal fingerprints are one row here. A pair of tiles answers with as few links as connect what it found,
so a crowd of near copies does not become all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages, free_name, returning
from weirgate.llm.components import Forest, components

SHINGLE = 4
SEED = 42
RADIUS = 4
QUARTERS = 4
QUARTER_BITS = 16
#: Fingerprints in a tile, at most about; a key of population counts that has more is cut into several tiles.
TILE = 8192
#: Fingerprints in a block of a tile, and shingles hashed at once.
BLOCK = 128
CHUNK = 1 << 16


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8, as a signed number; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII white-space characters
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < SHINGLE:
        return int(np.uint64(xxhash.xxh64_intdigest(line, SEED)).astype(np.int64))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - SHINGLE + 1]
    ends = ends[SHINGLE - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in returning(batches):
        texts = batch.column(batch.num_columns - 1)
        values = [fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in texts]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], names=[*names, "fingerprint"])


def fingerprints(docs: DataFrame, text: Column, *keys: Column) -> DataFrame:
    """The key columns and ``fingerprint`` (a signed number) of every row; a null text counts as empty."""
    rows = docs.select(*keys, text.alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_fingerprints, f"{schema}, fingerprint bigint")


def _close(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs within the radius, block by block."""
    if len(left) * len(right) <= 16 * BLOCK * BLOCK:
        yield np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
        return

    def blocks(values: np.ndarray):
        counts = np.bitwise_count(values.view(np.uint8).reshape(-1, 8)).astype(np.int16)
        order = np.lexsort(counts.T)
        cuts = np.arange(0, len(values), BLOCK)
        low, high = np.minimum.reduceat(counts[order], cuts), np.maximum.reduceat(counts[order], cuts)
        return [order[a : a + BLOCK] for a in cuts], low, high

    left_blocks, left_low, left_high = blocks(left)
    right_blocks, right_low, right_high = blocks(right)
    for at, rows in enumerate(left_blocks):
        gaps = np.maximum(0, np.maximum(left_low[at] - right_high, right_low - left_high[at])).sum(axis=1)
        near = np.flatnonzero(gaps <= radius)
        if not len(near):
            continue
        columns = np.concatenate([right_blocks[i] for i in near])
        i, j = np.nonzero(np.bitwise_count(left[rows][:, None] ^ right[columns][None, :]) <= radius)
        yield rows[i], columns[j]


def _tile_links(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts, rights = batch.column("left"), batch.column("right")
            out_a, out_b = [], []
            for row in range(batch.num_rows):
                left = lefts[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                right = rights[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                forest = None
                for i, j in _close(left, right, radius):
                    if len(i):
                        forest = forest or Forest(len(left) + len(right))
                        forest.link(i, j + len(left))
                if forest is not None:
                    both = np.concatenate([left, right]).view(np.int64)
                    a, b = forest.links()
                    apart = both[a] != both[b]
                    out_a.append(both[a][apart])
                    out_b.append(both[b][apart])
            a = np.concatenate(out_a) if out_a else np.empty(0, np.int64)
            b = np.concatenate(out_b) if out_b else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return link


def tile_links(stages: Stages, values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect all ``fingerprint`` values (no two equal) within the radius."""
    sides = range(QUARTERS)
    counts = [F.bit_count(F.expr(f"(fingerprint >> {QUARTER_BITS * q}) & {2**QUARTER_BITS - 1}")) for q in sides]
    keyed = values.select("fingerprint", *[c.cast("int").alias(f"n{q}") for q, c in enumerate(counts)])
    key = [f"n{q}" for q in sides]
    tiles = keyed.groupBy(*key).agg(F.ceil(F.count("*") / TILE).alias("tiles"))  # (bits + 1)^quarters rows at most
    tiled = keyed.join(tiles, key).withColumn("tile", F.expr("pmod(xxhash64(fingerprint), tiles)"))
    tiled = stages.put(tiled.groupBy(*key, "tile").agg(F.collect_list("fingerprint").alias("values")))
    steps = [s for s in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    steps = [s for s in steps if s >= (0,) * QUARTERS]  # one of each two directions
    offsets = F.array(*[F.struct(*[F.lit(d).alias(f"d{q}") for q, d in enumerate(s)]) for s in steps])
    left = tiled.select("*", F.explode(offsets).alias("by"))
    moved = [(F.col(f"n{q}") + F.col(f"by.d{q}")).alias(f"n{q}") for q in sides]
    same = F.expr(" AND ".join(f"by.d{q} = 0" for q in sides))
    left = left.select(*moved, F.when(same, F.col("tile")).alias("least"), F.col("values").alias("left"))
    left = left.where(" AND ".join(f"n{q} BETWEEN 0 AND {QUARTER_BITS}" for q in sides))
    right = tiled.withColumnRenamed("values", "right")
    pairs = left.join(right, key).where("least IS NULL OR least <= tile").select("left", "right")
    return pairs.mapInArrow(_tile_links(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``(key, content, fingerprint, component, group)`` for every row of ``docs``.

    ``content`` is a hash of the text, ``group`` a number of the component. ``component`` is the smallest key that can be reached by links between
    fingerprints that differ in at most ``radius`` bits. Null, empty and blank texts have fingerprint 0 and
    are linked like any other; null keys belong to a component but never name one, so a component of nothing else has
    a null name. Repeated rows are rows of the result each. An empty table gives an empty one.
    """
    stages = Stages(docs.sparkSession, "simhash")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stages.put(fingerprints(docs, body, F.col(key).alias("key"), F.xxhash64(body).alias("content")))
    classes = stages.put(rows.groupBy("fingerprint").agg(F.min("key").alias("least")))
    links = stages.put(tile_links(stages, classes.select("fingerprint"), radius))
    found = components(links)
    named = stages.put(
        classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("top"))
    )
    tops = stages.put(named.groupBy("top").agg(F.min("least").alias("component")))
    named = stages.put(named.join(tops, "top").select("fingerprint", "component", F.col("top").alias("group")))
    result = rows.join(named, "fingerprint").select(
        F.col("key").alias(key), "content", "fingerprint", "component", "group"
    )
    stages.drop(rows, named)
    return result


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest key; all columns as they are.

    Of equal rows with that key one stays, of different texts with that key the one whose hash is smallest.
    Groups without any key that is not null keep one row likewise.
    """
    stages = Stages(docs.sparkSession, "keepers")
    name = free_name(docs, "content")
    found = near_duplicates(docs, text, key, radius).select(F.col(key).alias("id"), "content", "group")
    first = F.min(F.struct(F.col("id").isNull(), "id", "content")).alias("first")
    best = stages.put(found.groupBy("group").agg(first).select("first.id", "first.content"))
    same = found["id"].eqNullSafe(best["id"]) & (found["content"] == best["content"])
    repeated = found.join(best.hint("merge"), same, "left_semi").groupBy("id", "content").agg(F.count("*").alias("n"))
    repeated = stages.put(repeated.where("n > 1").select("id", "content"))

    def among(rows: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
        chosen = chosen.hint("merge")  # as many rows as there are groups: never to be broadcast
        return rows.join(chosen, rows[f"`{key}`"].eqNullSafe(chosen["id"]) & (rows[name] == chosen["content"]), how)

    rows = docs.withColumn(name, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = among(rows, best, "left_semi")
    if not repeated.isEmpty():
        kept = among(kept, repeated, "left_anti").unionByName(
            among(rows, repeated, "left_semi").dropDuplicates([key, name])
        )
    stages.drop(best, repeated)
    return kept.drop(name)
