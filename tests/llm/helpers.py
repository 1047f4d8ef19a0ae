"""Small tables with everything that data may bring."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("content", "at", "id", "key", "toxic", "row", "rank", "copies", "part", "size", "col", "repeat")


def words(start: int, n: int) -> str:
    return " ".join(f"w{(start * 7919 + i * 104729) % 9973}" for i in range(n))


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """Documents from ``(doc_id, text, source)``, in several partitions."""
    full = [(i, t, None if i is None else "en", s, None if t is None else len(t)) for i, t, s in rows]
    docs = spark.createDataFrame(full, SCHEMA).repartition(3)
    if clashing:
        for name in CLASHING:
            docs = docs.withColumn(name, docs["source"])
    return docs


def odd_documents() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, words(1, 40), "b"), (5, words(2, 60000), "b"),
        (6, words(3, 30), "a"), (6, words(3, 30), "a"), (7, words(3, 30), "b"), (8, "é" * 50, None), (None, None, None),
        (9, words(4, 200), "a"), (10, words(4, 199) + " end", "a"), (11, "one", "b"), (12, "One", "b"),
    ]
