"""Extendible hashing: shards are the leaves of a directory over hash-prefix bits.

A row's hash is 60 bits of its key followed by 60 bits of its content. The directory starts as one
bucket. A bucket whose bytes exceed the limit, and only such a bucket, splits on its next bit, until
every bucket fits or holds rows that agree in all bits, which are copies of one row. Copies are told
apart by their number: a bucket of copies is cut into pages of as many copies as fit. A single row
above the limit is a shard of its own, as nothing smaller can hold it.

Sizes of buckets come from aggregates over the rows; a level of the directory only looks at what the
level before left too large, so the work falls off geometrically. Rows never meet in one task, copies
neither: they are counted by input slice, and numbered within it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import Stages

HALF_BITS = 60
BITS = 2 * HALF_BITS
#: Levels that one pass over the oversized buckets goes down.
STEP = 12


def digest(text: Column) -> Column:
    """60 bits of MD5 as 60 binary digits; null hashes like a text no value has."""
    text = F.coalesce(text, F.lit("\x00null"))
    return F.lpad(F.conv(F.substring(F.md5(text.cast("binary")), 1, HALF_BITS // 4), 16, 2), HALF_BITS, "0")


def shard_directory(hashed: DataFrame, limit: int) -> DataFrame:
    """Leaves of the directory over ``(bits, bytes)`` rows: ``(prefix, depth, shard_bytes, shard_rows)``.

    No rows give no leaves; a leaf of depth 0 has the empty prefix. Levels are built ``STEP`` at a time:
    one aggregate gives the sizes at the deepest of them, and those add up to the levels above.
    """
    stages = Stages(hashed.sparkSession, "directory")
    leaves, depth, kept = [], 0, hashed
    while True:
        last = min(depth + STEP, BITS)
        deepest = kept.groupBy(F.substring("bits", 1, last).alias("bits")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
        )
        sizes = (
            deepest.select("bits", "bytes", "rows", F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth"))
            .groupBy(F.expr("substring(bits, 1, depth)").alias("prefix"), "depth")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS)
        sizes = stages.put(sizes.withColumn("fits", fits))
        split = sizes.where("NOT fits").select(
            F.col("prefix").alias("parent"), (F.col("depth") + 1).alias("depth")
        )
        children = sizes.withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
        found = children.where("fits AND depth > 0").join(split, ["parent", "depth"], "left_semi")
        root = sizes.where("fits AND depth = 0")
        columns = ["prefix", "depth", "shard_bytes", "shard_rows"]
        leaves += [found.select(columns), root.select(columns)]
        large = sizes.where((F.col("depth") == last) & ~F.col("fits")).select(F.col("prefix").alias("large"))
        if last == BITS or large.isEmpty():
            break
        within = F.expr(f"substring(bits, 1, {last})") == F.col("large")
        kept = stages.put(kept.join(large, within, "left_semi"))
        depth = last
    result = stages.put(reduce(DataFrame.unionByName, leaves))
    stages.drop(result)
    return result


def extendible_shards(
    rows: DataFrame, key: Column, content: Column, size: Column, limit: int, prefix: str = "shard"
) -> DataFrame:
    """Add ``shard`` (its name), ``shard_depth``, ``shard_bytes`` and ``shard_rows`` to every row.

    A shard is named by the bits of its prefix, with ``/page`` after them where copies fill several. Every
    shard has at most ``limit`` bytes, or one row. Null keys and contents are values like any other, null
    sizes count 0 bytes, an empty table gives an empty one. Columns of the rows that have the names of the
    added ones are kept; the added ones then get another ``prefix``.
    """
    taken = {c.lower() for c in rows.columns}
    while any(n in taken for n in (prefix, f"{prefix}_depth", f"{prefix}_bytes", f"{prefix}_rows")):
        prefix += "_"
    sized = rows.select(
        F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"),
        F.concat(digest(key), digest(content)).alias("bits"),
        F.coalesce(size, F.lit(0)).cast("long").alias("bytes"),
    )
    leaves = shard_directory(sized.select("bits", "bytes"), limit)
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    placed = _place(sized, leaves.where(fits))
    if not leaves.where(~fits).isEmpty():
        placed = placed.unionByName(_pages(sized, leaves.where(~fits), limit))
    return placed.select(
        "row.*",
        F.col("name").alias(prefix),
        F.col("depth").alias(f"{prefix}_depth"),
        F.col("shard_bytes").alias(f"{prefix}_bytes"),
        F.col("shard_rows").alias(f"{prefix}_rows"),
    )


def _place(sized: DataFrame, leaves: DataFrame) -> DataFrame:
    """Rows with the one leaf that is a prefix of their bits.

    Entries of the directory are the first bits that all leaves have; a row looks up its entry, and the few
    leaves that share it are told apart by their own bits.
    """
    depth = leaves.agg(F.coalesce(F.min("depth"), F.lit(0))).first()[0]
    entry = F.substring("bits", 1, depth) if depth else F.lit("")
    directory = leaves.withColumn("entry", F.substring("prefix", 1, depth) if depth else F.lit(""))
    return (
        sized.withColumn("entry", entry)
        .join(directory, "entry")
        .where(F.startswith(F.col("bits"), F.col("prefix")))
        .select("row", F.col("prefix").alias("name"), "depth", "shard_bytes", "shard_rows")
    )


def _pages(sized: DataFrame, full: DataFrame, limit: int) -> DataFrame:
    """Copies of one row that no bit tells apart, cut into pages by their number."""
    stages = Stages(sized.sparkSession, "copies")
    copies = sized.join(full.withColumnRenamed("prefix", "bits").select("bits"), "bits", "left_semi")
    copies = stages.put(copies.withColumn("at", F.monotonically_increasing_id()))
    copies = copies.withColumn("slice", F.shiftright("at", 33))
    slices = copies.groupBy("bits", "slice").agg(F.count("*").alias("n"), F.max("bytes").alias("widest"))
    every = Window.partitionBy("bits")
    before = every.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "bits", "slice",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.greatest(F.lit(1), F.expr(f"{limit} DIV greatest(1, max(widest) OVER (PARTITION BY bits))")).alias("fit"),
    )
    number = F.row_number().over(Window.partitionBy("bits", "slice").orderBy("at")) - 1
    paged = copies.withColumn("number", number).join(slices, ["bits", "slice"])
    paged = paged.withColumn("page", F.expr("(before + number) DIV fit"))
    totals = paged.groupBy("bits", "page").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    result = stages.put(
        paged.join(totals, ["bits", "page"]).select(
            "row", F.concat_ws("/", "bits", F.col("page").cast("string")).alias("name"),
            F.lit(BITS).alias("depth"), "shard_bytes", "shard_rows",
        )
    )
    stages.drop(result)
    return result
