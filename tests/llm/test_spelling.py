import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests import oracle
from tests.llm.helpers import documents, odd_documents
from weirgate.llm import spelling
from weirgate.llm.queries import ORACLE, QUERIES

LETTERS = "abcdefgéüÀßÿ"


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(counts):
    out = {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[word] = [form, None, n, len(others), counts[form] if form else None]
    for word in out:
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        out[word][1] = root
    return {word: tuple(row) for word, row in out.items()}


def found_variants(spark, counts):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame).collect()}


def vocabulary(seed, roots, copies, longest=9):
    """Words with misspellings of misspellings."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(LETTERS) for _ in range(rng.randint(5, longest))): rng.randint(3, 400) for _ in range(roots)}
    for _ in range(copies):
        word = rng.choice(sorted(words))
        at, letter = rng.randrange(len(word)), rng.choice(LETTERS)
        made = rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])
        words.setdefault(made, rng.choice([3, words[word] // 2 + 1, words[word], 2 * words[word]]))
    return words


def test_query_against_sql(spark, sf_dir):
    assert oracle.compare(QUERIES["op11_spelling"](spark, sf_dir), oracle.connect(sf_dir), ORACLE["op11_spelling"]) is None


def test_query_against_the_rule(spark, tmp_path):
    """Runs, lower case of A to Z only, planted deletions, and documents that are null, empty or repeated."""
    rng = random.Random(5)
    base = [w for w in vocabulary(2, 40, 60) if w]
    rows = [(i, " ".join(rng.choice([w, w.upper(), w.title()]) + rng.choice(["", "-", "1"]) for w in rng.choices(base, k=60)), "s") for i in range(80)]
    documents(spark, odd_documents() + rows, clashing=True).write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    for key, text, _ in odd_documents() + rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode()) if key is not None else 1
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = slow_variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op11_spelling"](spark, str(tmp_path)).collect()}
    assert found == want and any(row[0] for row in want.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    counts = vocabulary(seed, 150, 400)
    assert found_variants(spark, counts) == slow_variants(counts)


def test_long_words_and_short_ones(spark, monkeypatch):
    """Words around the length up to which they are carried along, and one edited piece by piece."""
    counts = {}
    for size in (1, 2, 63, 64, 65, 700):
        word = "".join(LETTERS[(i * i + size) % len(LETTERS)] for i in range(size))
        for k, made in enumerate([word, word + "x", word[1:], word[: size // 2] + "y" + word[size // 2 + 1 :], "zz" + word]):
            if made:
                counts.setdefault(made, 3 + 10 * k)
    assert found_variants(spark, counts) == slow_variants(counts)


def test_crowded_words(spark):
    """Words that all look alike in the reduced alphabet."""
    symbol = {c: int(spelling.symbols_of(np.array([[ord(c)]]), 4)[0, 0]) for c in map(chr, range(97, 123))}
    group = max(([c for c in symbol if symbol[c] == s] for s in set(symbol.values())), key=len)
    rng = random.Random(3)
    counts = {"".join(rng.choice(group) for _ in range(6)): rng.randint(3, 90) for _ in range(400)}
    assert found_variants(spark, counts) == slow_variants(counts)


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.variants(spark.createDataFrame([(None, 5)], "word string, n long")).count() == 0


@pytest.mark.parametrize("pieces", [1 << 18, 30])
def test_neighbourhoods_hold_what_is_one_edit_away(monkeypatch, pieces):
    monkeypatch.setattr(spelling, "KEYS", pieces)
    rng = np.random.default_rng(0)
    for length in (1, 2, 7, 40):
        rows = rng.integers(1, 4, (5, length)).astype(np.uint64)
        keys = [set() for _ in rows]
        for some, at in spelling.neighbourhood(rows, 3):
            for key, row in zip(some.tolist(), at.tolist(), strict=True):
                keys[row].add(key)
        for row, found in zip(rows, keys, strict=True):
            edits = [np.delete(row, i) for i in range(length)] + [np.insert(row, i, s) for i in range(length + 1) for s in (1, 2, 3)]
            for i in range(length):
                for s in (1, 2, 3):
                    edits.append(np.array([*row[:i], s, *row[i + 1 :]], np.uint64))
            assert found == {int(spelling.keys_of(e.astype(np.uint64)[None])[0]) for e in edits}
