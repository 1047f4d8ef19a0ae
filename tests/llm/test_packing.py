import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents
from weirgate.llm import packing, tokens
from weirgate.llm.queries import QUERIES

ODD = [
    None, "", " ", "a", "  lead", "trail  ", "it's we'll 'sun ''s '' ' don't", "İstanbul ẞ straße", "日本語 text", "😀 ok",
    "<|endoftext|> x <|startoftext|>", "é é x\xa0y", "a\x1cb", "A​B", "1234 ½ ²x ª µ", "ſ Ÿ ŉ Σας", "x" * 5000,
    "tab\tnew\nline\x0bv\x0cf\rr", "foo_bar-baz...qux!!!", "\x00 nul", "a\x85b", "¡hola! «oui» 5€ ÀÉÎ ĀŽ × ÷",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def slow_best_fit(lengths, sequence):
    """Room left in each sequence, by placing one piece after the other."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else sequence) - length)
    return sorted(gaps)


def check_packing(rows, sequence):
    """Sequences without holes, of the size that best fit gives."""
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    for places in found.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    assert sorted(sequence - sum(n for _, n in p) for p in found.values()) == slow_best_fit([r.length for r in rows], sequence)


def test_ids_are_those_of_the_tokenizer(tokenizer, sf_dir):
    import duckdb

    texts = ODD + [t for (t,) in duckdb.sql(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    flat, bounds = tokens.Ids(packing.VOCABULARY).encode(pa.array(texts, pa.string()))
    for at, text in enumerate(texts):
        assert flat[bounds[at] : bounds[at + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_survive_forgetting(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    ids = tokens.Ids(packing.VOCABULARY)
    for _ in range(3):
        for text in ("one two three four", "five six", "one two", None):
            flat, _ = ids.encode(pa.array([text], pa.string()))
            assert flat.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("sequence", [8, 64])
def test_runs_are_best_fit(sequence):
    dice = random.Random(sequence)
    for _ in range(100):
        lengths = [dice.randint(1, sequence) for _ in range(dice.randint(0, 120))]
        used = Counter()
        ranks = defaultdict(list)
        for length, rank, n, first, offset in packing.best_fit(Counter(lengths), sequence):
            for i in range(n):
                assert used[first + i] == offset
                used[first + i] += length
                ranks[length].append(rank + i)
        assert all(sorted(r) == list(range(lengths.count(length))) for length, r in ranks.items())
        assert sorted(sequence - n for n in used.values()) == slow_best_fit(lengths, sequence)


def test_query(spark, sf_dir, tokenizer):
    rows = QUERIES["op9_packing"](spark, sf_dir).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(doc.text, add_special_tokens=False).ids, 0], "<u4")
        parts = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        want = [(k, 2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
        assert sorted(pieces.pop(doc.doc_id)) == want
    assert not pieces
    check_packing(rows, 2048)


def test_odd_documents(spark, tokenizer):
    docs = documents(spark, odd_documents(), clashing=True)
    cut = packing.pieces(docs, sequence=16, with_ids=True)
    rows = packing.pack(cut, sequence=16).collect()
    assert sum(r.piece == 0 for r in rows) == len(odd_documents())
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    check_packing(rows, 16)
    assert packing.pack(packing.pieces(documents(spark, []))).count() == 0


def test_one_length_holds_most(spark):
    docs = documents(spark, [(i, "same words here", "a") for i in range(3000)] + [(9000 + i, "w " * i, "b") for i in range(60)])
    check_packing(packing.pack(packing.pieces(docs, sequence=32), sequence=32).collect(), 32)
