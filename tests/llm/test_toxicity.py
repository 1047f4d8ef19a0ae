import random
import zlib

import pytest

from tests.llm.helpers import documents, odd_documents
from weirgate.llm import grammar, toxicity
from weirgate.llm.queries import QUERIES

STEMS = {"moron$": 5.0, "vequ": 4.0}


def weights(text, stems=STEMS):
    return [round(w, 6) for _, _, w in toxicity.Scorer(stems).clauses(text)]


def test_clauses_are_weighed_by_what_is_around():
    plain = weights("The moron left.")[0]
    assert plain == 5.0
    assert weights("You moron.")[0] == plain * grammar.AIMED
    assert weights("This is not a moron.")[0] == pytest.approx(plain * grammar.DENIED)
    assert weights("Not that it would matter to a moron.")[0] == plain  # too far behind the negation
    assert weights('A man said "moron" once.')[0] == pytest.approx(plain * grammar.REPORTED)
    assert weights("The paper wrote about a moron.")[0] == pytest.approx(plain * grammar.REPORTED)
    assert weights("You are not a moron.")[0] == pytest.approx(plain * grammar.AIMED * grammar.DENIED)
    assert weights("I will kill it.")[0] > 5 * weights("The frost may kill it.")[0]
    assert weights("Oxymoron, morons.") == []
    assert weights("vequaire! Ok. VEQUTÉ vequ") == [4.0, 8.0]
    assert weights("") == []


def test_composition_is_what_one_after_the_other_gives():
    parts = [grammar.negation(), grammar.reported_speech(), grammar.insult(), grammar.threat()]
    whole, dice = grammar.grammar(), random.Random(1)
    for _ in range(300):
        states, state = [0] * 4, 0
        for symbol in dice.choices(grammar.SYMBOLS, k=20):
            out, factor = symbol, 1.0
            for at, part in enumerate(parts):
                states[at], out, one = part.step(states[at], out)
                factor *= one
            state, whole_out, whole_factor = whole.step(state, symbol)
            assert (whole_out, pytest.approx(whole_factor)) == (out, factor)


def corpus(n=1500):
    dice = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text = ["".join(dice.choices(["ba", "lo", "ti", "re", "su", "na"], k=dice.randint(1, 4))) for _ in range(60)]
        toxic = i % 9 == 0
        for _ in range(3 * toxic):
            text.insert(dice.randrange(60), dice.choice(["gromp", "skel" + dice.choice(["a", "ti", "ren", "o"])]))
        rows.append((i, " ".join(text) + ".", "a"))
        if i % 2 == 0 or i % 9 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_stems_are_learned_and_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    assert any(s.startswith("grom") for s in model.stems) and any(s.startswith("skel") for s in model.stems)
    assert len(model.stems) < 20
    scored = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= 0.5) == (i % 9 == 0) for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0)


def test_held_out_labels_are_never_looked_at(spark):
    rows, labels = corpus(600)
    docs = documents(spark, rows)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    two = toxicity.learn(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert one == two


def test_copies_are_no_evidence(spark):
    rows, labels = corpus(600)
    copies = [(10_000 + i, "quix zarb flonk " * 3 + "ba lo ti re su na", "a") for i in range(60)]
    docs = documents(spark, rows + copies)
    model = toxicity.learn(docs, spark.createDataFrame(labels + [(i, 1) for i, *_ in copies], "doc_id long, toxic int"))
    assert not any(s.startswith(("quix", "zarb", "flonk")) for s in model.stems)


def test_query(spark, sf_dir):
    rows = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    docs = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_odd_documents(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model)
    assert found.columns == [*docs.columns, "toxicity"] and found.count() == len(odd_documents())
    assert len({r.toxicity for r in found.where("text IS NULL OR doc_id IN (2, 3)").collect()}) == 1
    assert toxicity.clauses(docs, model).count() == len(odd_documents())
    none = toxicity.learn(documents(spark, []), labels.limit(0))
    assert none.stems == {} and none.probability(0) < 0.5
    assert toxicity.score(documents(spark, []), none).count() == 0
