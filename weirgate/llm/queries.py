"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import embeddings, extraction, merkle, mixing, neighbours, packing, pii, secrets, sharding, simhash, sketches, spelling, toxicity
from weirgate.llm.common import word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20

#: SQL for the CRC-32 of a list of bytes ``{}``, bit by bit.
CRC = """xor(4294967295, list_reduce(
             list_prepend(4294967295::BIGINT, flatten([[(b >> k) & 1 FOR k IN range(8)] FOR b IN {}])),
             lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1))))"""


def _leaf_sql(text: str) -> str:
    """SQL for the digest of a document's fields with ``text`` as its text."""
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f}))::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(spark, sf_dir.rstrip("/"))
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query()
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"), "recall",
    )


@query()
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.expr(f"size(filter(spans, s -> s.base AND s.kind = {at}))").cast("long").alias(f"n_{kind}")
        for at, kind in enumerate(pii.BASE)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


@query(
    f"""
    WITH rows AS (
      SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS bytes,
             lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 15))::BIGINT), 60, '0') ||
             lpad(bin(('0x' || substr(md5(coalesce(text, chr(0) || 'null')), 1, 15))::BIGINT), 60, '0') AS bits
      FROM documents
    ), buckets AS (
      SELECT substr(bits, 1, depth) AS shard, depth, sum(bytes) AS shard_bytes, count(*) AS shard_rows
      FROM rows, (SELECT unnest(range(0, 121)) AS depth) GROUP BY ALL
    ), fitting AS (
      SELECT r.doc_id, r.bytes, b.*, row_number() OVER (PARTITION BY r.doc_id, r.bits ORDER BY b.depth) AS k
      FROM rows r JOIN buckets b ON substr(r.bits, 1, b.depth) = b.shard
      WHERE b.shard_bytes <= {SHARD_BYTES} OR b.shard_rows = 1
    )
    SELECT doc_id, bytes::BIGINT AS bytes, shard, depth::INT AS shard_depth,
           shard_bytes::BIGINT AS shard_bytes, shard_rows AS shard_rows
    FROM fitting WHERE k = 1
    """
)
def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        sharding.digest(F.col("text")).alias("content"),
    )
    placed = sharding.extendible_shards(
        rows, F.col("doc_id").cast("string"), F.col("content"), F.col("bytes"), SHARD_BYTES
    )
    return placed.drop("content")


@query()
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract_main_text(pages)


@query()
def op6_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_versions(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [p.kind for p in secrets.PATTERNS]
    base = F.filter("secrets", lambda s: s["rank"] < len(kinds))
    counts = [F.expr(f"size(filter(secrets, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


@query()
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = word_count(F.col("text"))
    mixed = mixing.mix(docs, words, weight=F.sqrt(F.greatest(words, F.lit(1))))
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query(
    f"""
    WITH RECURSIVE leaves AS (
      SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY source) AS width
      FROM (
        SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE
                 WHEN doc_id IS NOT NULL AND {CRC.format("[ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]")} & 1 = 0
                 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS altered
        FROM documents
      )
    ), tree AS (
      SELECT source, 0 AS level, idx, leaf AS digest, width FROM leaves
      UNION ALL
      SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (width + 2) // 3
      FROM tree WHERE width > 1 GROUP BY source, level, idx // 3, width
    ), subroots AS (
      SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS width
      FROM tree WHERE width = 1
    ), top AS (
      SELECT 0 AS level, idx, subroot AS digest, width FROM subroots
      UNION ALL
      SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (width + 2) // 3
      FROM top WHERE width > 1 GROUP BY level, idx // 3, width
    ), members AS (
      SELECT l.rid, t.level AS step, t.digest, t.idx, l.idx // pow(3, t.level)::BIGINT AS own
      FROM leaves l JOIN tree t ON t.source IS NOT DISTINCT FROM l.source AND t.width > 1
       AND t.idx // 3 = l.idx // pow(3, t.level + 1)::BIGINT
      UNION ALL
      SELECT l.rid, s.height + t.level, t.digest, t.idx, s.idx // pow(3, t.level)::BIGINT
      FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
      JOIN top t ON t.width > 1 AND t.idx // 3 = s.idx // pow(3, t.level + 1)::BIGINT
    ), steps AS (
      SELECT rid, step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS left_of,
             coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS right_of
      FROM members GROUP BY rid, step
    ), folded AS (
      SELECT rid, 0::BIGINT AS step, coalesce(altered, leaf) AS digest FROM leaves
      UNION ALL
      SELECT f.rid, f.step + 1, sha256(s.left_of || f.digest || s.right_of)
      FROM folded f JOIN steps s ON s.rid = f.rid AND s.step = f.step
    ), ends AS (
      SELECT rid, arg_max(digest, step) AS folded_root FROM folded GROUP BY rid
    ), proofs AS (
      SELECT rid, sha256(string_agg(left_of || right_of, '' ORDER BY step)) AS proof FROM steps GROUP BY rid
    )
    SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root,
           e.folded_root = r.digest AS verified
    FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN ends e ON e.rid = l.rid
    JOIN top r ON r.width = 1 LEFT JOIN proofs p ON p.rid = l.rid
    """
)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.replace("text", F.lit("\n")) if name == "text" else F.col(name) for name in fields]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = F.when(chosen, F.unhex(merkle.leaf_digest(tampered)))
    found = merkle.manifest(docs, fields, "source", "doc_id", altered)
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", *(merkle.hexed(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), merkle.hexed(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


@query()
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score", "recall")


@query(
    f"""
    WITH RECURSIVE runs AS (
      SELECT doc_id, translate(unnest(regexp_extract_all(text, '{spelling.RUN}')), '{spelling.UPPER}', '{spelling.LOWER}') AS run
      FROM documents
    ), counted AS (
      SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
    ), hashed AS (
      SELECT run, n, {CRC.format("""flatten([
               CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 + (ord(c) >> 6))::BIGINT, (128 + (ord(c) & 63))::BIGINT] END
               FOR c IN string_split(doc_id::VARCHAR || ':' || run, '')])""")} AS h
      FROM counted
    ), words AS (
      SELECT word, sum(n)::BIGINT AS n
      FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed
      ) GROUP BY word HAVING length(word) >= {spelling.SHORTEST} AND sum(n) >= {spelling.RAREST}
    ), less AS (
      SELECT word, length(word) AS size, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), near AS (
      SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.size = b.size AND a.word <> b.word
      UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word
    ), firsts AS (
      SELECT a.word, a.n, b.word AS near, b.n AS near_n, count(*) OVER (PARTITION BY a.word) AS n_near,
             row_number() OVER (PARTITION BY a.word ORDER BY b.n DESC, b.word) AS k
      FROM near JOIN words a ON a.word = near.word JOIN words b ON b.word = near.near
    ), forms AS (
      SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.RATIO} * w.n THEN near END AS form,
             CASE WHEN near_n >= {spelling.RATIO} * w.n THEN near_n END AS form_n
      FROM words w LEFT JOIN firsts f ON f.word = w.word AND f.k = 1
    ), chains AS (
      SELECT word, word AS root, 0 AS step FROM forms
      UNION ALL
      SELECT c.word, f.form, step + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
    ), roots AS (
      SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word
    )
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """
)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(spelling.RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", spelling.lower_ascii(F.col("run")).alias("run"))
    hashed = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary"))
    at = F.col("hash") % F.char_length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.char_length("run")))
    words = runs.withColumn("hash", hashed).select(F.when(F.col("hash") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.variants(spelling.count_words(words))
