"""Token ids of texts: strings between white space are told apart and looked up once per batch."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: A vocabulary of byte pairs in which no token crosses white space.
VOCABULARY = "word_bpe_49k.json"
#: Strings whose ids a task remembers, in each of two generations.
REMEMBERED = 80_000
#: Bytes of text that are cut into words together, at least one text.
TOGETHER = 4 << 20

# Texts of these characters alone are cut at white space and looked up string by string. In them the
# tokenizer's normal form changes nothing but the case, and it splits words as WORDS does.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffĀ-ſ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: Bytes that are not printable in Latin-1 stand for themselves moved behind it; the others are unchanged.
_MOVED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTES = [chr(256 + _MOVED.index(b)) if b in _MOVED else chr(b) for b in range(256)]
#: Any other character, or what may be the name of a special token.
OTHERS = r"[^\t\n\x0b\x0c\r\x20-\x7e\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{17f}]|<\|"


class Ids:
    """Ids of texts, the same as the tokenizer gives for each text alone."""

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, strings: list[str]) -> None:
        """Ids of strings of ordinary characters in lower case, word by word by the tokenizer's model alone."""
        split, known, letter = self.tokenizer.model.tokenize, self.new, BYTES.__getitem__
        for string in strings:
            if string.isascii() and string.isalpha():
                known[string] = array("I", [token.id for token in split(string)]).tobytes()
                continue
            ids = array("I")
            for word in WORDS.findall(string):
                if not word.isascii():
                    word = "".join(map(letter, word.encode()))
                ids.extend([token.id for token in split(word)])
            known[string] = ids.tobytes()

    def look_up(self, strings: list[str]) -> list[bytes]:
        """Ids of different strings. What was not asked for in a generation is forgotten after the next."""
        if len(self.new) > REMEMBERED:
            self.new, self.old = {}, self.new
        missing = [s for s in strings if s not in self.new]
        known = {s: self.old[s] for s in missing if s in self.old}
        self.new.update(known)
        unknown = [s for s in missing if s not in known]
        self.learn(unknown)
        return list(map(self.new.__getitem__, strings))

    def task(self, batches: Iterable) -> Iterator:
        """The batches of a task, behind which everything is forgotten."""
        yield from batches
        self.new, self.old = {}, {}

    def batches(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order; a null text has none."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + TOGETHER, "right")))
            flat, bounds = self.encode(texts.slice(at, end - at))
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                yield flat[a:b]
            at = end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin, with the end behind; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, OTHERS)
        words = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(odd, "", texts)))
        coded = pc.dictionary_encode(words.values)
        found = self.look_up(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(found), "<u4")))
        flat = lists.take(coded.indices).flatten().to_numpy(zero_copy_only=False)
        at = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        bounds = ends[words.offsets.to_numpy()]
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(rows):
            return flat, bounds
        parts = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        for row in rows:
            parts[row] = self.plain(texts[row].as_py())
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_loaded: dict[str, Ids] = {}


def ids_of(vocabulary: str = VOCABULARY) -> Ids:
    """The worker's tokenizer, loaded once."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = Ids(vocabulary)
    return _loaded[vocabulary]
