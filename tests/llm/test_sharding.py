import hashlib

from pyspark.sql import functions as F

from tests import oracle
from tests.llm.helpers import documents, odd_documents
from weirgate.llm import sharding
from weirgate.llm.queries import ORACLE, QUERIES


def bits(text):
    data = b"\x00null" if text is None else text.encode()
    return f"{int(hashlib.md5(data).hexdigest()[:15], 16):060b}"


def slow_shards(rows, limit):
    """Buckets split one by one, the root first."""
    done, waiting = {}, [("", rows)]
    while waiting:
        prefix, members = waiting.pop()
        if sum(n for _, n in members) <= limit or len(members) == 1 or len(prefix) == 120:
            done[prefix] = members
            continue
        for bit in "01":
            part = [m for m in members if m[0].startswith(prefix + bit)]
            if part:
                waiting.append((prefix + bit, part))
    return {prefix: (sum(n for _, n in m), len(m)) for prefix, m in done.items() if m}


def place(docs, limit):
    text = F.col("text")
    return sharding.extendible_shards(docs, F.col("doc_id").cast("string"), text, F.octet_length(text), limit)


def test_query_against_sql(spark, sf_dir):
    name = "op4_extendible_shards"
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLE[name]) is None


def test_directory_against_splitting_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(bits(str(r.doc_id)) + bits(r.text), len(r.text.encode())) for r in docs.collect()]
    for limit in (500, 20_000, 10**9):
        placed = place(docs, limit).collect()
        assert len(placed) == len(rows)
        assert {r.shard: (r.shard_bytes, r.shard_rows) for r in placed} == slow_shards(rows, limit)


def test_copies_fill_pages(spark):
    docs = documents(spark, [(1, "x" * 10, "a")] * 25 + [(2, "y", "a"), (3, "z" * 100, "b")])
    placed = place(docs, 35).collect()
    pages = {}
    for r in placed:
        pages.setdefault(r.shard, []).append(len(r.text))
    assert all(sum(p) <= 35 or len(p) == 1 for p in pages.values())
    assert sorted(len(p) for s, p in pages.items() if "/" in s) == [1] + [3] * 8
    assert all(r.shard_bytes == sum(pages[r.shard]) and r.shard_rows == len(pages[r.shard]) for r in placed)


def test_odd_documents_and_names(spark):
    docs = documents(spark, odd_documents(), clashing=True).withColumn("shard", F.lit("mine"))
    placed = place(docs, 1000)
    assert placed.columns[: len(docs.columns)] == docs.columns
    assert placed.columns[-4:] == ["shard_", "shard__depth", "shard__bytes", "shard__rows"]
    assert placed.drop("shard_", "shard__depth", "shard__bytes", "shard__rows").exceptAll(docs).count() == 0
    assert placed.count() == docs.count()
    assert place(documents(spark, []), 10).count() == 0
