"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols. The full one-edit neighbourhood of a reduced word (all deletions, replacements and
insertions of symbols) is small, as there are few symbols, and holds the reduced form of every word that is one edit
from it. So neighbourhoods are joined with the reduced vocabulary, and what meets is verified on the original
strings. A reduced word is known by a 64-bit polynomial of its symbols; words that merely share it fall to the
verification, too.

The number of symbols follows the number of words, so that few unrelated words meet however large the vocabulary is:
``symbols ** TYPICAL`` reduced words for as many words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages, returning

#: Maximal runs of letters.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, RAREST = 5, 3
#: How many times more often than a word its form has to be.
RATIO = 2
#: Symbols at least, and the length of word at which there are as many reduced words as words.
SYMBOLS, TYPICAL = 4, 8
#: Words up to this length go along with their neighbourhoods; of longer ones only their number does.
CARRIED = 64
#: Keys that are made together.
KEYS = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_words(words: DataFrame, word: str = "word") -> DataFrame:
    """``(word, n)``: the words of at least ``SHORTEST`` code points that occur ``RAREST`` times or more."""
    long_enough = words.where(F.char_length(word) >= SHORTEST).select(F.col(word).alias("word"))
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= RAREST)


def symbols_of(words: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols, from 1, of words of one length, given as rows of code points."""
    hashed = words.astype(np.uint64) * np.uint64(0x9E3779B1) % np.uint64(1 << 32) >> np.uint64(8)
    return hashed % np.uint64(symbols) + np.uint64(1)


def keys_of(reduced: np.ndarray) -> np.ndarray:
    """One number for each reduced word."""
    powers = _powers(reduced.shape[1])
    return (reduced * powers).sum(axis=1, dtype=np.uint64) + np.uint64(reduced.shape[1]) * _LENGTH


def _powers(length: int) -> np.ndarray:
    steps = np.full(length, _BASE)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def neighbourhood(reduced: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all reduced words at most one edit away, and the row each belongs to.

    Places are edited some at a time. What comes of those has each key once for a row.
    """
    rows, length = reduced.shape
    powers = _powers(length + 1)
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(reduced * powers[:length], axis=1, dtype=np.uint64, out=before[:, 1:])
    whole = before[:, -1:]
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    size, one = np.uint64(length), np.uint64(1)
    step = max(1, KEYS // (2 * symbols * rows))
    for begin in range(0, length + 1, step):
        at, gap = slice(begin, min(begin + step, length)), slice(begin, begin + step)
        deleted = before[:, at] + (whole - before[:, 1:][:, at]) * _BACK + (size - one) * _LENGTH
        replaced = whole[:, :, None] + (every - reduced[:, at, None]) * powers[at, None] + size * _LENGTH
        inserted = (before[:, gap] + (whole - before[:, gap]) * _BASE)[:, :, None] + every * powers[gap, None] + (size + one) * _LENGTH
        keys = np.sort(np.concatenate([deleted, replaced.reshape(rows, -1), inserted.reshape(rows, -1)], axis=1), axis=1)
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        yield keys[new], np.repeat(np.arange(rows), new.sum(axis=1))


def _code_points(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time, as many as make ``KEYS`` or so: their places, their code points."""
    by_length: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        by_length.setdefault(len(word), []).append(at)
    for length, places in by_length.items():
        together = max(1, KEYS // (3 * symbols * (length + 1)))
        for begin in range(0, len(places), together):
            some = places[begin : begin + together]
            text = "".join(words[at] for at in some).encode("utf-32-le")
            yield np.array(some), np.frombuffer(text, "<u4").reshape(len(some), length)


def _reduce(symbols: int, spread: bool):
    """``(key, id, word)`` for each word, or for each reduced word in its neighbourhood."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = batch.column(0), batch.column(1).to_pylist()
            short = pa.array([w if len(w) <= CARRIED else None for w in words], pa.string())
            for places, points in _code_points(words, symbols):
                reduced = symbols_of(points, symbols)
                around = neighbourhood(reduced, symbols) if spread else [(keys_of(reduced), np.arange(len(places)))]
                for keys, rows in around:
                    at = pa.array(places[rows])
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids.take(at), short.take(at)], names=["key", "id", "word"])

    return lambda batches: returning(keyed(batches))


def near_words(stages: Stages, words: DataFrame, symbols: int) -> DataFrame:
    """``(id, near_id, near, near_n)`` for ``(id, word, n)``: each word with each word that is one edit away."""
    shape = "key bigint, id bigint, word string"
    around = words.select("id", "word").mapInArrow(_reduce(symbols, True), shape)
    reduced = words.select("id", "word").mapInArrow(_reduce(symbols, False), shape)
    reduced = reduced.select("key", F.col("id").alias("near_id"), F.col("word").alias("near"))
    met = around.join(reduced.hint("shuffle_hash"), "key").where("id <> near_id").drop("key")
    carried = F.col("word").isNotNull() & F.col("near").isNotNull()
    one = F.levenshtein("word", "near", 1) == 1
    # Both kinds are told apart while they are written, so that neighbourhoods are made and joined once.
    met = stages.put(met.where(~carried | (carried & one)))
    sure = met.where(carried).select("id", "near_id", "near")
    names = words.select("id", F.col("word").alias("name"))
    others = words.select(F.col("id").alias("near_id"), F.col("word").alias("near"))
    # Long words are edited piece by piece, so that they may meet more than once.
    open_ = met.where(~carried).select("id", "near_id").distinct().join(names, "id").join(others, "near_id")
    open_ = open_.where(F.levenshtein("name", "near", 1) == 1).select("id", "near_id", "near")
    return sure.unionByName(open_)


def variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for different words ``(word, n)``.

    Words are near if one inserted, deleted or replaced code point turns one into the other. The form of a
    word is its most frequent near word, of equally frequent ones the first by code points, if it is at least
    ``RATIO`` times as frequent as the word; otherwise null. ``root`` is what following forms ends at, the word itself
    if it has none. Null words are left out; an empty vocabulary gives no rows. Words may be of any length.
    """
    stages = Stages(words.sparkSession, "spelling")
    words = stages.put(words.where(F.col("word").isNotNull()).select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    symbols = max(SYMBOLS, int(np.ceil(words.count() ** (1 / TYPICAL))))
    near = near_words(stages, words, symbols).join(words.select(F.col("id").alias("near_id"), F.col("n").alias("near_n")), "near_id")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near", "near_id")).alias("first")
    chosen = near.groupBy("id").agg(F.count("*").alias("n_near"), first)
    has = -F.col("first.less") >= RATIO * F.col("n")
    words = words.join(chosen, "id", "left")
    words = stages.put(words.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("first.near")).alias("form"),
        F.when(has, F.col("first.near_id")).alias("form_id"), F.when(has, -F.col("first.less")).cast("long").alias("form_n"),
    ))
    # Chains of forms double their counts at each step, so they are short; each round halves them.
    ways = stages.put(words.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("up")))
    while True:
        above = ways.select(F.col("id").alias("up"), F.col("up").alias("top"))
        higher = stages.put(ways.join(above, "up", "left").select("id", F.coalesce("top", "up").alias("up"), "top"))
        done = higher.where("top IS NOT NULL").isEmpty()
        stages.forget(ways)
        ways = higher.select("id", "up")
        if done:
            break
    roots = ways.join(words.select(F.col("id").alias("up"), F.col("word").alias("root")), "up").select("id", "root")
    result = stages.put(words.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    stages.drop(result)
    return result
