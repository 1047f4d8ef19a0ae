import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_documents
from weirgate.llm import pii
from weirgate.llm.queries import QUERIES


def slow_base(text):
    """Base spans by the patterns as they are written."""
    text, spans = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def test_base_spans_of_random_texts():
    dice = random.Random(7)
    for _ in range(20000):
        text = "".join(dice.choices("a.@-_+1 2(9.é%0\n", k=dice.randint(0, 60)))
        assert pii.base_spans(text) == slow_base(text), text


def test_runs_without_an_end_are_read_once():
    for text in ("a" * 300_000, "1" * 300_000, "+1 " + " " * 300_000, "1." * 100_000, "a@" * 100_000):
        pii.spans_of(text)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_pii"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spans = slow_base(texts[r.doc_id])
        listed = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        assert set(listed.split(",")) <= set(r.spans.split(",")) | {""}


PRIVATE = ["phone (0211) 555 1234", "mail john (at) example (dot) com", "ssn 123-45-6789", "IBAN DE89 3704 0044 0532 0130 00", "Dear Mr. John Smith"]
PUBLIC = ["page 0000-12 of 7", "ssn-like 900-00-0000", "code ZZ99 0000 0000 0000", "plain words"]


def test_votes_decide_on_candidates(spark):
    docs = documents(spark, [(i, (PRIVATE + PUBLIC)[i % 9], "a") for i in range(900)])
    rows = pii.find_pii(docs).collect()
    share = {text: [bool(r.spans) for r in rows if (PRIVATE + PUBLIC)[r.doc_id % 9] == text] for text in PRIVATE + PUBLIC}
    assert all(all(share[text]) for text in PRIVATE)
    assert not any(any(share[text]) for text in PUBLIC[1:])


def test_redaction(spark):
    docs = documents(spark, [(1, "a@b.co, +1 (171) 555-2028 and 4845168114407329é", "a"), (2, None, "a"), (3, "", "b")], clashing=True)
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert {r.doc_id: r.text for r in clean.collect()} == {1: "[EMAIL], [PHONE] and [CARD]é", 2: None, 3: ""}


def test_odd_documents(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(odd_documents())
    assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3))
    assert pii.redact(docs).exceptAll(docs).count() == 0
    assert pii.find_pii(documents(spark, [])).count() == 0
    assert pii.redact(documents(spark, [])).count() == 0


def test_estimation_finds_the_unreliable_labeler():
    """Two labelers that agree outweigh one that votes at random."""
    dice, counts = random.Random(3), {}
    for _ in range(4000):
        true = dice.random() < 0.5
        votes = [2 if (dice.random() < 0.95) == true else 0, 2 if (dice.random() < 0.9) == true else 0, dice.choice([0, 2])]
        packed = votes[0] * 9 + votes[1] * 3 + votes[2]
        counts[packed] = counts.get(packed, 0) + 1
    believed = pii.agreement([(0, v, 0, False, n) for v, n in counts.items()])
    assert believed[0, 2 * 9 + 2 * 3] > 0.95 and believed[0, 2] < 0.05
    assert abs(believed[0, 2 * 9 + 2 * 3] - believed[0, 2 * 9 + 2 * 3 + 2]) < 0.05
