import hashlib
import random

import pytest

from tests.llm.helpers import documents, odd_documents, words
from weirgate.llm import sketches
from weirgate.llm.queries import QUERIES


def slow_likeness(one, other):
    a, b = set(sketches.paragraph_digests(one)), set(sketches.paragraph_digests(other))
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    """Every row against its text and the text behind it."""
    order = sorted(docs)
    assert sorted(r.doc_id for r in rows) == [k for k, _ in order]
    found = {r.doc_id: r for r in rows}
    for at, (key, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(slow_likeness(text, edited))
        assert r.near_next == pytest.approx(slow_likeness(text, following))
        assert r.fingerprint == sketches.Sketch(sketches.paragraph_digests(text)).text()
        assert r.edited_fingerprint == sketches.Sketch(sketches.paragraph_digests(edited)).text()


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op6_sketches"](spark, sf_dir).collect(), docs)


def test_peeling_recovers_what_differs():
    dice = random.Random(2)
    for n in (0, 1, 5, 30, 400, 5000):
        shared = [dice.getrandbits(64) for _ in range(n)]
        one = shared + [dice.getrandbits(64) for _ in range(dice.randint(0, n + 2))]
        other = shared + [dice.getrandbits(64) for _ in range(dice.randint(0, n + 2))]
        only_one, only_other = sketches.differing(one, other)
        assert (sorted(only_one), sorted(only_other)) == (sorted(set(one) - set(other)), sorted(set(other) - set(one)))


def test_paragraphs():
    text = words(3, 900).replace("7 ", "7. ") + "\n\n \nsame\nsame\n" + "é" * 2000
    parts = sketches.PARAGRAPH.findall(text)
    assert "".join(parts) == text.replace("\n", "")
    assert len(set(sketches.paragraph_digests(text))) == len(sketches.paragraph_digests(text))
    assert sketches.paragraph_digests("") == sketches.paragraph_digests("\n \n") == []
    assert sketches.likeness([], []) == 1.0 and sketches.likeness([1], []) == 0.0


def test_many_ranges_and_gaps_between_keys(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        docs = [(i * i * 37 - 1000, words(i, i % 90)) for i in range(200)]
        check(sketches.fingerprint_versions(documents(spark, [(i, t, "a") for i, t in docs])).collect(), docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_odd_documents(spark):
    rows = sketches.fingerprint_versions(documents(spark, odd_documents(), clashing=True)).collect()
    assert len(rows) == len(odd_documents())
    same = [r for r in rows if r.doc_id == 6]
    assert same[0].fingerprint == same[1].fingerprint and sorted(r.near_next for r in same) == [1.0, 1.0]
    assert all(r.n_chars == 0 and r.near_edited == 1.0 for r in rows if r.doc_id in (1, 2))
    assert sketches.fingerprint_versions(documents(spark, [])).count() == 0
    alone = sketches.fingerprint_versions(documents(spark, [(4, "one\ntwo", "a")])).first()
    assert (alone.near_next, alone.edited_sha256) == (1.0, hashlib.sha256(b"one\none").hexdigest())
