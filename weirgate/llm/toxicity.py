"""Toxicity of documents by a weighted finite-state grammar over clauses.

Which words insult is learned: stems, the first letters of words, that far more toxic documents have than others.
The grammar (see ``grammar``) composes transducers for negation, reported speech, insults with and without a
target and threats with and without an intention; it weighs every insult and threat by the clause around it.
The weights of a document's clauses are added up, and a logistic curve fitted to labelled documents turns the sum into
a score.

Learning looks at a bounded sample of labelled documents (``LEARN_ROWS``), near copies once. Scoring looks at
every text whole: an Aho-Corasick automaton finds the stems, and only clauses with one are read word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weirgate.llm import grammar
from weirgate.llm.common import Stages, free_name, returning

#: Labelled documents that are learned from, at most about.
LEARN_ROWS = 20_000
#: Stems looked at, and kept, at most; by support.
CANDIDATES, STEMS = 50_000, 3_000
#: Lengths of stems; whole words end in WHOLE.
SHORT, LONG, WHOLE = 3, 8, "$"
#: Toxic documents a stem must be in, log odds and log-likelihood ratio it must reach.
SUPPORT, ODDS, EVIDENCE = 3, 2.5, 20.0
#: Share of a stem's documents that a longer one must have to replace it.
COVERS = 0.9
HELD_OUT = 5
BIN, BINS = 0.5, 200
SHINGLE = 5

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»]")
_CLAUSE = re.compile(r"[^.!?;\n]+")
_QUOTES = frozenset("\"“”„«»")


def held_out(key: Column) -> Column:
    """Rows no label is learned from: a fifth, by the CRC-32 of the key as text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


@dataclass(frozen=True)
class Model:
    stems: dict[str, float]
    #: Score of a document is ``1 / (1 + exp(-(base + slope * sum)))``.
    base: float
    slope: float

    def probability(self, total: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.base + self.slope * total, -30, 30))))


class Scorer:
    """Clauses of texts that the grammar gives weight."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.machine = grammar.grammar()
        self.automaton = ahocorasick.Automaton()
        for stem, weight in stems.items():
            self.automaton.add_word(stem.removesuffix(WHOLE), (stem, weight))
        for word, symbol in grammar.LEXICON.items():
            if symbol == grammar.THREAT and word not in self.automaton:
                self.automaton.add_word(word, (word + WHOLE, 0.0))
        self.automaton.make_automaton()
        self.threat_weight = float(np.median(list(stems.values()))) if stems else 1.0

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """``(start, end, weight)`` of each clause with an insult or threat, in code points of the lower-case text."""
        low = text.lower()
        starts: dict[int, float] = {}
        for last, (stem, weight) in self.automaton.iter(low):
            whole = stem.endswith(WHOLE)
            start, end = last + 1 - len(stem) + whole, last + 1
            if (start == 0 or not low[start - 1].isalpha()) and not (whole and end < len(low) and low[end].isalpha()):
                starts[start] = max(weight, starts.get(start, 0.0))
        if not starts:
            return []
        places, found = sorted(starts), []
        for clause in _CLAUSE.finditer(low):
            at = bisect_left(places, clause.start())
            if at < len(places) and places[at] < clause.end():
                weight = self.weigh(low, clause.start(), clause.end(), starts)
                if weight > 0:
                    found.append((clause.start(), clause.end(), weight))
        return found

    def weigh(self, low: str, start: int, end: int, starts: dict[int, float]) -> float:
        total, state = 0.0, 0
        for token in _TOKEN.finditer(low, start, end):
            symbol = grammar.LEXICON.get(token[0], grammar.WORD)
            weight = starts.get(token.start(), 0.0)
            if token[0] in _QUOTES:
                symbol = grammar.QUOTE
            elif weight > 0:
                symbol = grammar.INSULT
            elif symbol == grammar.THREAT:
                weight = self.threat_weight
            state, out, factor = self.machine.step(state, symbol)
            if out in (grammar.INSULT, grammar.THREAT):
                total += weight * factor
        return total

    def total(self, text: str | None) -> float:
        return sum(weight for _, _, weight in self.clauses(text)) if text else 0.0


def _stems(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= SHORT:
            found.update(word[:n] for n in range(SHORT, min(LONG, len(word)) + 1))
            found.add(word + WHOLE)
    return found


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest and the largest digest of a text's shingles: near copies mostly agree in one of them."""
    for batch in returning(batches):
        low, high = [], []
        for text in batch.column("text").to_pylist():
            words = (text or "").split()
            last = max(1, len(words) - SHINGLE + 1)
            digests = [xxh64_intdigest(" ".join(words[i : i + SHINGLE])) >> 1 for i in range(last)]
            low.append(min(digests))
            high.append(max(digests))
        columns = [batch.column("at"), batch.column("toxic"), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "toxic", "low", "high"])


def _counts(among: frozenset[str] | None = None):
    """Documents with each stem; all stems, or those among some."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in returning(batches):
            found: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                stems = _stems(text or "")
                found.update(stems if among is None else stems & among)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["stem", "n"]
            )

    return count


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, other: int) -> dict[str, float]:
    """Stems with their log odds, from how many toxic and other documents have each."""
    weights: dict[str, float] = {}
    for stem, (pos, neg) in counts.items():
        odds = np.log((pos + 0.5) / (toxic + 1.0)) - np.log((neg + 0.5) / (other + 1.0))
        every = toxic + other
        expected = ((pos + neg) * toxic / every, (pos + neg) * other / every)
        evidence = 2 * sum(n * np.log(n / e) for n, e in zip((pos, neg), expected, strict=True) if n)
        if pos >= SUPPORT and odds >= ODDS and evidence >= EVIDENCE:
            weights[stem] = float(odds)
    longer: dict[str, list[str]] = {}
    for stem in weights:
        if stem.endswith(WHOLE):
            for n in range(SHORT, min(LONG, len(stem) - 1) + 1):
                longer.setdefault(stem[:n], []).append(stem) if n == min(LONG, len(stem) - 1) else None
        elif len(stem) > SHORT:
            longer.setdefault(stem[:-1], []).append(stem)

    def settle(stem: str) -> Iterable[str]:
        """The longest stems that have nearly all documents of this one; a very short one is always taken apart."""
        while True:
            nexts = longer.get(stem, [])
            full = [s for s in nexts if counts[s][0] >= COVERS * counts[stem][0]]
            if full:
                stem = max(full, key=lambda s: (counts[s][0], s))
            elif len(stem) == SHORT and sum(counts[s][0] for s in nexts) >= COVERS * counts[stem][0]:
                return [one for s in nexts for one in settle(s)]
            else:
                return [stem]

    chosen: dict[str, float] = {}
    for stem in sorted(weights, key=lambda s: (len(s), s)):
        bare = stem.removesuffix(WHOLE)
        if any(bare[:n] in chosen for n in range(SHORT, len(bare) + 1)) or any(c.startswith(bare) for c in chosen):
            continue
        chosen.update((s, weights[s]) for s in settle(stem))
    return chosen


def _fit(bins: list[tuple[int, int, int]]) -> tuple[float, float]:
    """Logistic curve through ``(bin, documents, toxic ones)``, by Newton steps with a little shrinkage."""
    if not bins:
        return -30.0, 0.0
    x = np.array([b * BIN for b, _, _ in bins])
    n = np.array([c for _, c, _ in bins], float)
    y = np.array([t for _, _, t in bins], float)
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    prior = np.array([[1e-3, 0.0], [0.0, 1e-2]])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - n * p) - prior @ beta
        bend = (design * (n * p * (1 - p))[:, None]).T @ design + prior
        step = np.linalg.solve(bend, slope)
        beta = beta + step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Stems and curve from labelled documents that are not held out.

    Null labels don't count; of several labels of a document the highest does. Without toxic documents nothing is
    toxic: every score is then near 0.
    """
    stages = Stages(docs.sparkSession, "toxicity")
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    n = known.count()
    if n > LEARN_ROWS:
        share = int(LEARN_ROWS / n * 2**20)
        known = known.where(F.expr(f"pmod(xxhash64(id), {2**20}) < {share}"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(known), "id")  # LEARN_ROWS rows at most about
    rows = stages.put(rows.select(F.monotonically_increasing_id().alias("at"), "toxic", "text"))
    marks = rows.mapInArrow(_marks, "at bigint, toxic int, low bigint, high bigint")
    marks = marks.dropDuplicates(["toxic", "low"]).dropDuplicates(["toxic", "high"])
    once = stages.put(rows.join(F.broadcast(marks.select("at")), "at", "left_semi"))
    sizes = {r.toxic: r.n for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def counted(of: DataFrame, among: frozenset[str] | None = None) -> DataFrame:
        return of.select("text").mapInArrow(_counts(among), "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))

    often = counted(once.where("toxic = 1")).where(F.col("n") >= SUPPORT)
    toxic = {r.stem: r.n for r in often.orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()}
    others = {r.stem: r.n for r in counted(once.where("toxic = 0"), frozenset(toxic)).collect()}
    counts = {s: (n, others.get(s, 0)) for s, n in toxic.items()}
    stems = choose_stems(counts, sizes.get(1, 0), sizes.get(0, 0)) if toxic else {}
    stems = dict(sorted(stems.items(), key=lambda s: -counts[s[0]][0])[:STEMS])
    totals = rows.select("toxic", _totals(stems)("text").alias("total"))
    bins = F.least(F.floor(F.col("total") / BIN), F.lit(BINS)).alias("bin")
    table = totals.groupBy(bins).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()
    stages.drop()
    return Model(stems, *_fit([(r.bin, r.n, r.toxic) for r in table]))


def _totals(stems: dict[str, float]):
    def totals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(stems)
        for texts in returning(batches):
            yield pa.array([scorer.total(t) for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(totals, "double")


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "toxicity") -> DataFrame:
    """Add the score, 0 to 1; null and empty texts have that of a text without any insult.

    All other columns stay; if one has the added name, the added column gets an underscore more.
    """

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model.stems)
        for texts in returning(batches):
            yield pa.array([model.probability(scorer.total(t)) for t in texts.to_pylist()], pa.float64())

    return docs.withColumn(free_name(docs, column), F.arrow_udf(scores, "double")(F.col(text)))


def clauses(docs: DataFrame, model: Model, text: str = "text", column: str = "clauses") -> DataFrame:
    """Add the clauses that have weight: ``array<struct<start, end, weight>>``, in code points of the lower-case text."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model.stems)
        for texts in returning(batches):
            found = [scorer.clauses(t) if t else [] for t in texts.to_pylist()]
            yield pa.array([[dict(zip(("start", "end", "weight"), c, strict=True)) for c in f] for f in found], kind)

    returned = "array<struct<start: int, end: int, weight: double>>"
    return docs.withColumn(free_name(docs, column), F.arrow_udf(find, returned)(F.col(text)))
