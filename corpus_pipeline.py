"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads what the one before wrote. All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import mixing, packing, pii, simhash, toxicity
from weirgate.llm.common import Stages, word_count

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``; the labels are learned from what is labelled among them."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    added = scored.columns[-1]
    return scored.where(F.col(added) < TOXIC).drop(added)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix of their sources takes."""
    return mixing.mixed_documents(docs, word_count(F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("simhash", keep_one_of_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    stages, before = Stages(spark, "pipeline"), None
    for _, stage in STAGES:
        docs = stages.put(stage(spark, docs, sf_dir))
        if before is not None:
            stages.forget(before)
        before = docs
    stages.drop(docs)
    return docs
