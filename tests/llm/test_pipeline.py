from collections import Counter, defaultdict

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.helpers import documents, odd_documents
from weirgate.llm import pii, simhash
from weirgate.llm.queries import ORACLE, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_by_name():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mixing", "packing"]


def test_entry_points():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run


def test_each_stage_on_what_the_one_before_kept(spark, sf_dir):
    """Every stage against a plain computation on its own input."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = stages["toxicity"](spark, docs, sf_dir)
    clean = spark.createDataFrame(clean.collect(), docs.schema)
    assert clean.columns == COLUMNS
    kept = {r.doc_id for r in clean.collect()}
    gone = {r.doc_id for r in docs.collect()} - kept
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * len(labels)

    single = stages["simhash"](spark, clean, sf_dir)
    assert single.columns == COLUMNS
    groups = defaultdict(list)
    for r in simhash.near_duplicates(clean).collect():
        groups[r.component].append(r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(min(g) for g in groups.values())

    single = spark.createDataFrame(single.collect(), docs.schema)
    private = stages["pii"](spark, single, sf_dir)
    assert private.columns == COLUMNS
    before = {r.doc_id: r.text for r in single.collect()}
    for r in private.collect():
        assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not pii.spans_of(before[r.doc_id]):
            assert r.text == before[r.doc_id]

    private = spark.createDataFrame(private.collect(), docs.schema)
    mixed = stages["mixing"](spark, private, sf_dir)
    assert mixed.columns == COLUMNS
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(before) and max(copies.values()) <= 2

    mixed = spark.createDataFrame(mixed.collect(), docs.schema)
    packed = stages["packing"](spark, mixed, sf_dir)
    assert Counter(r.doc_id for r in packed.collect() if r.piece == 0) == copies


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    for places in found.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_odd_documents_go_through_all_stages(spark, sf_dir, tmp_path):
    for rows in (odd_documents(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{len(rows)}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(rows)
