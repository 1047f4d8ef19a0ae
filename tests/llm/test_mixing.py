import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_documents, words
from weirgate.llm import mixing
from weirgate.llm.common import word_count
from weirgate.llm.queries import QUERIES


def slow_targets(sizes, weights=(5, 2, 1), total=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, budget = {}, set(), total * sum(sizes.values())
    while True:
        left = budget - sum(most * sizes[s] for s in stopped)
        share = sum(weight[s] for s in names if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else left * weight[s] / share for s in names}
        above = {s for s in names if s not in stopped and target[s] > most * sizes[s]}
        if not above:
            return target
        stopped |= above


def check(rows, slack):
    sizes, taken, targets, largest = {}, {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        targets[r.source] = r.target
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(r.source_size == sizes[r.source] and 0 <= r.copies <= 2 for r in rows)
    want = slow_targets(sizes)
    for source in sizes:
        assert targets[source] == pytest.approx(want[source], rel=1e-12)
        assert targets[source] - max(largest[source], slack * targets[source]) <= taken[source] <= targets[source]


def test_query(spark, sf_dir):
    first = sorted(QUERIES["op10_mix"](spark, sf_dir).collect())
    assert first == sorted(QUERIES["op10_mix"](spark, sf_dir).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r["size"] for r in first} == {i: len(t.split()) for i, t in texts.items()}
    assert all(r.taken == r.copies * r["size"] for r in first)


def test_targets_are_met(spark):
    rows = [(i, words(i, 20 + i % 37), ("b", "a", None, "é", "c")[i % 5]) for i in range(3000)]
    docs = documents(spark, rows)
    check(mixing.mix(docs, word_count(F.col("text"))).collect(), 0.003)


def test_one_source_holds_most(spark):
    rows = [(i, words(i, 30), "big" if i % 10 else "small") for i in range(4000)]
    check(mixing.mix(documents(spark, rows), word_count(F.col("text"))).collect(), 0.01)


def test_one_key_holds_most(spark):
    docs = documents(spark, [(7 if i % 3 else i, words(i, 30), "a") for i in range(3000)] + [(i, words(i, 9), "b") for i in range(400)])
    rows = mixing.mix(docs, word_count(F.col("text")), total=0.6).collect()
    assert len(rows) == 3400
    taken = sum(r.copies * r["size"] for r in rows if r.source == "a")
    target = next(r.target for r in rows if r.source == "a")
    assert target - 30 <= taken <= target
    assert {r.copies for r in rows if r.doc_id == 7 and r.source == "a"} == {0, 1}


def test_inclusion_follows_the_odds(spark):
    """Documents with three times the weight are taken about three times as often."""
    rows = [(i, "w " * 10, "a") for i in range(4000)]
    docs = documents(spark, rows).withColumn("heavy", F.col("doc_id") % 2 == 0)
    found = mixing.mix(docs, F.lit(10), total=0.2, weight=F.expr("IF(heavy, 3, 1)")).collect()
    heavy = sum(r.copies for r in found if r.doc_id % 2 == 0)
    light = sum(r.copies for r in found if r.doc_id % 2)
    assert heavy + light == 800
    assert 2.3 < heavy / light < 4


def slow_inclusion(sizes, weights, rest):
    """Shares in proportion to weights, none above 1, that give ``rest`` words on average."""
    certain = set()
    while True:
        scale = (rest - sum(sizes[i] for i in certain)) / sum(w * sizes[i] for i, w in weights.items() if i not in certain)
        more = {i for i, w in weights.items() if i not in certain and w * scale >= 1}
        if not more:
            return {i: 1.0 if i in certain else w * scale for i, w in weights.items()}
        certain |= more


def test_frequencies_follow_unequal_inclusions(spark):
    """Over many draws documents are taken as often as their inclusion says; certain ones always."""
    sizes = {i: 5 + (i * 37) % 90 for i in range(1500)} | {1500 + i: 2000 for i in range(5)}
    weights = {i: n**0.5 for i, n in sizes.items()}
    docs = spark.createDataFrame([(i, "a", n) for i, n in sizes.items()], "doc_id long, source string, n long").repartition(4)
    want = slow_inclusion(sizes, weights, 0.55 * sum(sizes.values()))
    assert sum(p == 1 for p in want.values()) == 5
    draws, taken = 8, {i: 0 for i in sizes}
    for seed in range(draws):
        for r in mixing.mix(docs, F.col("n"), total=0.55, weight=F.sqrt("n"), seed=seed).collect():
            taken[r.doc_id] += r.copies
    assert all(taken[i] == draws for i, p in want.items() if p == 1)
    order = sorted((i for i, p in want.items() if p < 1), key=want.get)
    for part in range(0, len(order), 300):
        some = order[part : part + 300]
        expected = sum(want[i] for i in some) * draws
        assert abs(sum(taken[i] for i in some) - expected) < 4 * expected**0.5 / 2 + 0.02 * expected


def test_a_document_with_a_fifth_of_a_source(spark):
    """Whatever is not taken does not fit in what is left, also if the document passed over is a very long one."""
    sizes = [100 + i % 200 for i in range(3999)] + [200_000]
    docs = spark.createDataFrame([(i, "a", n) for i, n in enumerate(sizes)], "doc_id long, source string, n long")
    for seed in range(4):
        rows = mixing.mix(docs, F.col("n"), total=0.3, seed=seed).collect()
        taken = sum(r.copies * r["size"] for r in rows)
        left = rows[0].target - taken
        assert len(rows) == 4000 and 0 <= left < min(r["size"] for r in rows if not r.copies)


def test_against_one_document_after_the_other(spark):
    sizes = [1 + (i * i) % 997 for i in range(600)] + [40_000, 0, 0]
    docs = spark.createDataFrame([(i, "ab"[i % 2], n) for i, n in enumerate(sizes)], "doc_id long, source string, n long")
    draws = {r.doc_id: r.u for r in docs.select("doc_id", mixing.uniform(F.col("doc_id"), 5).alias("u")).collect()}
    found = {r.doc_id: r for r in mixing.mix(docs, F.col("n"), total=0.4, seed=5).collect()}
    for source in (0, 1):
        left = found[source].target
        for i in sorted((i for i in found if i % 2 == source), key=draws.get):
            if sizes[i]:
                assert found[i].copies == (sizes[i] <= left)
                left -= sizes[i] * found[i].copies


def test_odd_documents(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    rows = mixing.mix(docs, word_count(F.col("text"))).collect()
    assert len(rows) == len(odd_documents())
    check(rows, 1.0)
    mixed = mixing.mixed_documents(docs, word_count(F.col("text")))
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.mix(docs.withColumn("h", F.xxhash64("doc_id", "text")), word_count(F.col("text")), key="h").collect())
    empty = documents(spark, [])
    assert mixing.mix(empty, word_count(F.col("text"))).count() == 0
    assert mixing.mixed_documents(empty, word_count(F.col("text"))).count() == 0
