import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm.helpers import documents, odd_documents, words
from weirgate.llm import merkle
from weirgate.llm.queries import ORACLE, QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_proofs(rows):
    """(doc_id, leaf, subroot, root, path) of rows, one tree after the other."""

    def build(nodes):
        """A list of (digest, items below): the root's digest; paths of the items get what is beside them."""
        while len(nodes) > 1:
            above = []
            for at in range(0, len(nodes), 3):
                run = nodes[at : at + 3]
                for k, (_, items) in enumerate(run):
                    for item in items:
                        item["path"].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
                above.append((sha("".join(d for d, _ in run)), [i for _, items in run for i in items]))
            nodes = above
        return nodes[0]

    groups = {}
    for row in rows:
        leaf = sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))
        groups.setdefault(row["source"], []).append({"id": row["doc_id"], "leaf": leaf, "path": []})
    tops = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        items = sorted(groups[source], key=lambda i: (i["id"] is not None, i["id"] or 0, i["leaf"]))
        subroot, items = build([(i["leaf"], [i]) for i in items])
        tops.append((subroot, [{**i, "subroot": subroot} for i in items]))
    root, items = build(tops)
    return sorted(((i["id"], i["leaf"], i["subroot"], root, tuple(i["path"])) for i in items), key=str)


def found_proofs(frame):
    found = merkle.manifest(frame, FIELDS, "source", "doc_id")
    text = F.transform("path", lambda p: F.struct(merkle.hexed(p["left"]).alias("left"), merkle.hexed(p["right"]).alias("right")))
    rows = found.select("doc_id", *(merkle.hexed(F.col(c)) for c in ("leaf", "subroot", "root")), text).collect()
    return sorted(((r[0], r[1], r[2], r[3], tuple(map(tuple, r[4]))) for r in rows), key=str)


def test_query_against_sql(spark, sf_dir):
    assert oracle.compare(QUERIES["op13_merkle"](spark, sf_dir), oracle.connect(sf_dir), ORACLE["op13_merkle"]) is None


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    frame = documents(spark, odd_documents(), clashing)
    assert found_proofs(frame) == slow_proofs([r.asDict() for r in frame.collect()])


@pytest.mark.parametrize("sizes", [[1], [2], [4], [1, 1], [1, 1, 1, 1], [28, 1, 3], [5] * 11])
def test_shapes_of_trees(spark, sizes):
    """Lone leaves, lone nodes at the ends of levels, sources of very different heights."""
    rows = [(100 * s + i, f"t{s} {i}", f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    frame = documents(spark, rows)
    assert found_proofs(frame) == slow_proofs([r.asDict() for r in frame.collect()])


def test_a_hot_source_with_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CROWD", 4)
    monkeypatch.setattr(merkle, "RANGE", 50)
    rows = [(7, words(1, 5), "hot")] * 150 + [(i, words(i, 5), "hot") for i in range(200)] + [(i, words(i, 3), f"s{i % 9}") for i in range(60)]
    frame = documents(spark, rows)
    assert found_proofs(frame) == slow_proofs([r.asDict() for r in frame.collect()])


def test_no_rows(spark):
    assert merkle.manifest(documents(spark, [(1, "a", "b")]).limit(0), FIELDS, "source", "doc_id").count() == 0


def test_tampering_shows(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in QUERIES["op13_merkle"](spark, sf_dir).collect():
        changed = zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and "\n" in (docs[row.doc_id] or "")
        assert row.verified == (not changed)
