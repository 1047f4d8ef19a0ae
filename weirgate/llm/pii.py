"""Personal data in texts by weak supervision.

Fixed patterns find base spans, which always stay. Wider patterns find further candidates: obfuscated addresses,
telephone numbers without a country code, national and account numbers, names behind titles. Three labelers vote
on every span, base or not, for, against, or not at all: a validator of its form, a gazetteer of known parts, and
the words around it. How reliable each of them is for a kind of span is estimated by expectation
maximisation from how often they agree, with no labelled data. The probabilities that come out train a
logistic classifier over features of a span and its surroundings; candidates it finds likely are added.

All texts vote: spans are counted by votes and features, of which there is a bounded number, and only those
counts reach the driver.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages, free_name, returning

#: Kinds in the order in which spans with the same start are listed; the first are those of the base patterns.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national_id", "account", "name")
LABELERS = 3
ROUNDS = 50
LIKELY = 0.5
#: Code points of context on each side of a span.
CONTEXT = 40

# fixed values: the patterns that results are held against, written so that a run is read once
_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_HERE = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_CANDIDATES: dict[str, re.Pattern] = {
    "email": re.compile(r"(?<!\w)[\w.+-]{1,64}\x20?[(\[{]\x20?at\x20?[)\]}]\x20?[\w-]{1,64}(?:(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\.)[\w-]{1,24}){1,4}", re.I),
    "phone": re.compile(r"(?<![\w+.(-])(?:\([0-9]{2,5}\)|0[0-9]{1,4})[\x20./-]+[0-9]{2,4}(?:[\x20./-]?[0-9]{2,4}){1,3}(?![\w-])"),
    "national_id": re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "account": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
    "name": re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra)\.?\x20[A-ZÀ-Þ][\w'-]{1,30}(?:\x20[A-ZÀ-Þ][\w'-]{1,30}){0,2}"),
}
_GAZETTEER = {
    "email": frozenset("com org net edu gov info io co de fr es uk us eu biz example".split()),
    "account": frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()),
    "name": frozenset("john james mary robert anna maria peter paul thomas michael marie jean pierre hans jose juan carmen luis laura david".split()),
}
_CUES = {
    "email": "mail e-mail email contact kontakt correo courriel write schreib",
    "ip": "ip address host server login adresse dirección",
    "card": "card credit visa mastercard amex karte carte tarjeta payment",
    "phone": "phone tel call fax mobile telephone telefon handy anruf téléphone appel teléfono llama whatsapp",
    "national_id": "ssn social security id passport ausweis sécurité identidad dni",
    "account": "iban account konto compte cuenta bank transfer",
    "name": "name signed dear sincerely called heiße nom appelle nombre llamo regards",
}
_CUE_SETS = {kind: frozenset(words.split()) for kind, words in _CUES.items()}
#: Words that speak against personal data behind them.
_COUNTER = frozenset("version release section chapter figure isbn issn order invoice article seite page página total".split())


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if at % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order; kinds are places in ``KINDS``."""
    found = []
    if "@" in text:
        at = 0
        while at < len(text):
            match = at and _LOCAL_HERE.match(text, at) or _LOCAL.search(text, at)
            if not match:
                break
            at = match.end()
            found.append((match.start(), 0, at))
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                found.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            if match.end() - match.start() >= 14:
                digits = match[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((match.start(), 2, match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
                    found.append((match.start(), 3, match.end()))
    return sorted(found)


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further spans that don't touch the base ones or each other; earlier kinds go first."""
    spans: list[tuple[int, int, int]] = []
    busy = sorted((start, end) for start, _, end in taken)
    for start, kind, end in sorted(
        (match.start(), KINDS.index(name), match.end())
        for name, pattern in _CANDIDATES.items()
        for match in pattern.finditer(text)
    ):
        at = bisect_right(busy, (start, end))
        if (at == 0 or busy[at - 1][1] <= start) and (at == len(busy) or busy[at][0] >= end):
            busy.insert(at, (start, end))
            spans.append((start, kind, end))
    return spans


def _valid(kind: str, value: str) -> int:
    digits = "".join(c for c in value if c.isdigit())
    if kind == "ip":
        try:
            return 1 if ipaddress.ip_address(value) else -1
        except ValueError:
            return -1
    if kind == "card":
        return 1 if len(digits) in (15, 16) else 0
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 13 else -1
    if kind == "national_id":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    if kind == "account":
        bare = value.replace(" ", "")
        turned = "".join(str(int(c, 36)) for c in bare[4:] + bare[:4])
        return 1 if 15 <= len(bare) <= 34 and int(turned) % 97 == 1 else -1
    if kind == "email":
        return 1 if 6 <= len(value) <= 254 else -1
    return 0


def _known(kind: str, value: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[.\W]+", value.lower().rstrip(")]} "))[-1] in _GAZETTEER["email"] else -1
    if kind == "account":
        return 1 if value[:2] in _GAZETTEER["account"] else -1
    if kind == "name":
        return 1 if any(w in _GAZETTEER["name"] for w in value.lower().split()) else 0
    if kind == "ip":
        return -1 if value.startswith(("0.", "255.")) else 0
    if kind == "card":
        return 1 if value[0] in "3456" else -1
    return 0


def votes_and_features(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """The votes of the labelers and the features of a span, each packed into a number."""
    name, value = KINDS[kind], text[start:end]
    before = re.findall(r"[\w-]+", text[max(0, start - CONTEXT) : start].lower())
    after = re.findall(r"[\w-]+", text[end : end + CONTEXT].lower())
    near = {*before[-5:], *after[:3]}
    cue = 1 if near & _CUE_SETS[name] else -1 if set(before[-2:]) & _COUNTER else 0
    valid, known = _valid(name, value), _known(name, value)
    votes = 0
    for vote in (valid, known, cue):
        votes = votes * 3 + vote + 1
    digits = sum(c.isdigit() for c in value)
    parts = (
        kind, min(7, (end - start) // 5), min(3, digits // 4), int(digits == end - start),
        int(start == 0 or text[start - 1] in "\n:=<("), int(" " in value), int("-" in value or "." in value),
        int(bool(near & _CUE_SETS[name])), int(end == len(text) or text[end] in " \n,;)>"), valid + 1, known + 1,
    )
    features = 0
    for part, size in zip(parts, FEATURE_SIZES, strict=True):
        features = features * size + part
    return votes, features


FEATURE_SIZES = (len(KINDS), 8, 4, 2, 2, 2, 2, 2, 2, 3, 3)


def unpack(features: int) -> list[int]:
    parts = []
    for size in reversed(FEATURE_SIZES):
        features, part = divmod(features, size)
        parts.append(part)
    return parts[::-1]


def spans_of(text: str) -> list[tuple[int, int, int, bool, int, int]]:
    """``(start, kind, end, base, votes, features)`` of all base spans and candidates, in order."""
    base = base_spans(text)
    spans = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in _candidates(text, base)]
    return [(s, k, e, b, *votes_and_features(text, s, k, e)) for s, k, e, b in sorted(spans)]


_SPAN = pa.struct(
    [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.int32()), ("features", pa.int32())]
)
_SPAN_TYPE = "struct<start: bigint, kind: int, end: bigint, base: boolean, votes: int, features: int>"


def _find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    names = [f.name for f in _SPAN]
    for batch in returning(texts):
        yield pa.array(
            [[dict(zip(names, span, strict=True)) for span in spans_of(t or "")] for t in batch.to_pylist()], pa.list_(_SPAN)
        )


def candidates(docs: DataFrame, text: str = "text", column: str = "candidates") -> DataFrame:
    """Add all spans that the method judges: base ones and candidates, with votes and features."""
    return docs.withColumn(free_name(docs, column), F.arrow_udf(_find, f"array<{_SPAN_TYPE}>")(F.col(text)))


@dataclass(frozen=True)
class Model:
    """Probability by packed features of a candidate; those never seen are decided by ``weights``."""

    weights: tuple[float, ...]

    def probability(self, features: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(_design(unpack(features)) @ np.array(self.weights), -30, 30))))

    def likely(self, seen: list[int]) -> list[int]:
        return [f for f in seen if self.probability(f) >= LIKELY]


def _design(parts: list[int]) -> np.ndarray:
    row = [1.0]
    for part, size in zip(parts, FEATURE_SIZES, strict=True):
        row += [float(part == k) for k in range(size)]
    return np.array(row)


def agreement(counts: list[tuple[int, int, int, bool, int]]) -> dict[tuple[int, int], float]:
    """Probability that a span is personal data, by ``(kind, votes)``, from ``(kind, votes, features, base, n)``.

    Expectation maximisation over the votes of all kinds: how often each labeler votes for and against if the
    span is personal data and if not, and how often a kind is. It starts from labelers that are right more
    often than wrong, and a little evidence of that kind stays in, so that it can't turn around.
    """
    table: dict[tuple[int, int], float] = {}
    for kind, votes, _, _, n in counts:
        table[kind, votes] = table.get((kind, votes), 0.0) + n
    result: dict[tuple[int, int], float] = {}
    for kind in {k for k, _ in table}:
        rows = [(votes, n) for (k, votes), n in table.items() if k == kind]
        cast = np.array([[votes // 9, votes // 3 % 3, votes % 3] for votes, _ in rows])
        weight = np.array([n for _, n in rows])
        start = np.array([[[0.1, 0.3, 0.6], [0.6, 0.3, 0.1]]] * LABELERS)  # labeler, true or not, vote
        rates, share = start.copy(), 0.5
        for _ in range(ROUNDS):
            yes = np.log(share) + sum(np.log(rates[j, 0, cast[:, j]]) for j in range(LABELERS))
            no = np.log(1 - share) + sum(np.log(rates[j, 1, cast[:, j]]) for j in range(LABELERS))
            p = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
            share = float(np.clip(((p * weight).sum() + 5) / (weight.sum() + 10), 0.01, 0.99))
            for j in range(LABELERS):
                for side, part in ((0, p * weight), (1, (1 - p) * weight)):
                    seen = np.array([part[cast[:, j] == v].sum() for v in range(3)]) + 10 * start[j, side]
                    rates[j, side] = seen / seen.sum()
        result |= {(kind, votes): float(q) for (votes, _), q in zip(rows, p, strict=True)}
    return result


def train(counts: list[tuple[int, int, int, bool, int]]) -> Model:
    """The classifier over features, fitted to the probabilities that the votes give; base spans count as certain."""
    size = 1 + sum(FEATURE_SIZES)
    if not counts:
        return Model((0.0,) * size)
    believed = agreement(counts)
    grouped: dict[int, list[float]] = {}
    for kind, votes, features, base, n in counts:
        entry = grouped.setdefault(features, [0.0, 0.0])
        entry[0] += n
        entry[1] += n * (1.0 if base else believed[kind, votes])
    design = np.array([_design(unpack(f)) for f in grouped])
    n, y = np.array([v[0] for v in grouped.values()]), np.array([v[1] for v in grouped.values()])
    beta, ridge = np.zeros(size), 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - n * p) - ridge * beta
        bend = (design * (n * p * (1 - p))[:, None]).T @ design + ridge * np.eye(size)
        step = np.linalg.solve(bend, slope)
        beta = beta + step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-8:
            break
    return Model(tuple(beta.tolist()))


def learn(found: DataFrame, column: str = "candidates") -> tuple[Model, list[int]]:
    """The model, and the packed features of candidates that it finds likely, from rows with ``candidates``.

    Votes have 27 values and features at most ``prod(FEATURE_SIZES)``, so the counts are a bounded table.
    """
    spans = found.select(F.explode(column).alias("span")).select("span.*")
    counts = spans.groupBy("kind", "votes", "features", "base").agg(F.count("*").alias("n")).collect()
    rows = [(r.kind, r.votes, r.features, r.base, r.n) for r in counts]
    model = train(rows)
    return model, sorted(model.likely(list({r[2] for r in rows if not r[3]})))


def _accepted(column: Column, likely: list[int]) -> Column:
    chosen = F.array(*[F.lit(f) for f in likely]) if likely else F.expr("CAST(array() AS array<int>)")
    return F.filter(column, lambda s: s["base"] | F.array_contains(chosen, s["features"]))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id", column: str = "spans") -> DataFrame:
    """``(key, spans)`` per row, spans being ``array<struct<start, kind, end, base, votes, features>>`` in order.

    A null text has none. Texts are read once; what was found is kept for judging when all texts have voted.
    """
    stages = Stages(docs.sparkSession, "pii")
    found = stages.put(candidates(docs.select(F.col(key).alias("key"), F.col(text).alias("text"))).select("key", "candidates"))
    _, likely = learn(found)
    stages.drop(found)
    return found.select(F.col("key").alias(key), _accepted(F.col("candidates"), likely).alias(column))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows with every span of personal data replaced by its kind in brackets; null texts stay null."""
    _, likely = learn(candidates(docs.select(F.col(text).alias("text"))))
    wanted = frozenset(likely)

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in returning(batches):
            yield pa.array([None if t is None else redacted(t, wanted.__contains__) for t in batch.to_pylist()], pa.string())

    return docs.withColumn(text, F.arrow_udf(clean, "string")(F.col(text)))


def redacted(text: str, likely: Callable[[int], bool]) -> str:
    parts, at = [], 0
    for start, kind, end, base, _, features in spans_of(text):
        if (base or likely(features)) and end > at:
            parts += [text[at : max(at, start)], f"[{KINDS[kind].upper()}]"]
            at = end
    return "".join([*parts, text[at:]]) if parts else text
