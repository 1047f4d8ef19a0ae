import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_documents
from weirgate.llm import secrets
from weirgate.llm.queries import QUERIES

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def slow_spans(text):
    """Base spans by the patterns as they are written, failing matches dropped afterwards."""
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def as_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def slow_entropy(text, window=secrets.WINDOW):
    parts = [Counter(text[i : i + window]) for i in range(len(text) - window + 1)]
    return max((math.log2(window) - sum(n * math.log2(n) for n in p.values()) / window for p in parts), default=0.0)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_secrets"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spans = slow_spans(texts[r.doc_id])
        counts = Counter(kind for *_, kind in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert r.base_sha256 == hashlib.sha256(as_text(spans).encode()).hexdigest()
        assert set(as_text(spans).split(",")) <= set(r.spans.split(",")) | {""}


def test_random_texts_against_plain_patterns(spark):
    dice = random.Random(4)
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", " ", "  ", "=", ":", '"', "'", "a1", "AKIA", "B7XQ", "0f3a9c", "é", "\n", ".", "z"]
    texts = ["".join(dice.choices(bits, k=dice.randint(1, 40))) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(frame).collect():
        found = [(s.start, s.rank, s.end, s.kind) for s in r.secrets if s["rank"] < 3]
        assert found == slow_spans(r.text), r.text
        assert all(r.text[s.start : s.end] == s.value for s in r.secrets)


def test_entropy_of_windows(spark):
    values = ["A8Jk2Lm9Qx7Zt4Rv1Bn6Ws3Ec5Yd", "aaaaaaaaaaaaaaaaaaaa", "abababababababababababababab", "short", "x9" * 400 + "A8Jk2Lm9Qx7Zt4Rv1Bn6Ws"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = frame.select("v", secrets.highest_entropy(F.col("v"), secrets.CLASSES[1].alphabet).alias("bits")).collect()
    for r in found:
        assert r.bits == pytest.approx(slow_entropy(r.v), abs=1e-9)


def test_what_entropy_adds_and_leaves(spark):
    texts = {
        1: "key ghp_a8Jk2Lm9Qx7Zt4Rv1Bn6Ws3Ec5Yd end", 2: "id 123e4567-e89b-12d3-a456-426614174000", 3: "a_very_long_name_made_of_words_only",
        4: "number 1234567890123456789012", 5: "sum 9F86D081884C7D659A2FEAA0C55AD015", 6: 'token = "0b96a8c8d79c4a5085c919698889f59b"',
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kinds = {r.doc_id: [s.kind for s in r.secrets] for r in secrets.find_secrets(frame).collect()}
    assert kinds == {1: ["entropy_base64"], 2: [], 3: [], 4: [], 5: ["entropy_hex"], 6: ["assign", "hex"]}


def test_odd_documents(spark):
    docs = documents(spark, odd_documents(), clashing=True).withColumn("secrets", F.lit("mine"))
    found = secrets.find_secrets(docs)
    assert found.columns == [*docs.columns, "secrets_"]
    assert found.drop("secrets_").exceptAll(docs).count() == 0
    assert all(r.secrets_ == [] for r in found.where("text IS NULL OR doc_id = 2").collect())
    assert secrets.find_secrets(documents(spark, [])).count() == 0
    long = spark.createDataFrame([("x " * 200_000 + "token=abcdef01 " * 300 + "-a" * 20_000,)], "text string")
    assert len(secrets.find_secrets(long).first().secrets) == 300


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op8_secrets"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
