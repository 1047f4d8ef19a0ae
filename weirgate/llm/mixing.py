"""Mixing sources to target weights by Pareto order sampling.

Sources get a share of the mix by weight, at most so many times their own size; what is cut off there is
shared again among the others. A source whose target is 1.3 times its size takes every document once for
certain, and of the rest each document with an inclusion probability, here 0.3 by default, or in
proportion to a weight of its own. Documents are ranked by the odds of a random number divided by the odds of
their inclusion, smallest first, and taken in that order until the source's words are reached.

A document that does not fit in what is left is passed over, and the ones behind it are tried, until none is
left that fits. That is done without ordering a source's documents in one task: ranks fall into bins, words
are summed by bin, and only the documents of the one bin that crosses the target are looked at one by one. Then
the bins behind it are summed again, over the documents that fit in what is left by then. Bins are as many as
the square root of a source's documents, so both steps grow with the root. Random numbers are hashes of the
document's key, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import Stages, free_name

#: Random numbers have so many bits; with a half added they lie inside (0, 1).
RANDOM_BITS = 52
#: Above this inclusion the odds of a document count as this.
ALMOST = 1.0 - 2.0**-20


def uniform(key: Column, seed: int = 0) -> Column:
    """A number inside (0, 1) that only depends on the key."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"/{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, RANDOM_BITS // 4), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**RANDOM_BITS))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), total: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, source_docs)`` with ``target``: words the source should give.

    Sources in order of code points, null last, get the weights in turn. ``total`` times all words are shared
    out by weight. Sources that reach ``most`` times their size stop there; what they leave is shared among
    the others, until none is above. That is the level at which the targets add up: with sources in order of
    the level at which they stop, it follows from running sums. There is one row per source here, so ordering
    them in one place is cheap.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ceiling = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("weight", weight).withColumn("ceiling", ceiling)
    rows = rows.withColumn("stop", F.col("ceiling") / F.col("weight"))
    passed = Window.orderBy("stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(total))
    rows = rows.withColumn(
        "level",
        (budget - F.coalesce(F.sum("ceiling").over(passed), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(passed), F.lit(0.0))),
    )
    # the first source not passed sets the level; those behind it would only lower it
    reached = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    level = F.coalesce(reached, F.max("stop").over(everything))
    return rows.withColumn("target", F.least("ceiling", level * F.col("weight"))).select(
        "source", "source_size", "source_docs", "target"
    )


def pareto_rank(random: Column, inclusion: Column, usual: Column) -> Column:
    """Random odds over inclusion odds, folded into (0, 1); a certain document comes first, an impossible one last.

    The ranks of documents that have the ``usual`` inclusion are their random numbers, so bins of ranks are even.
    """

    def odds(share: Column) -> Column:
        bounded = F.least(F.greatest(share, F.lit(1.0 - ALMOST)), F.lit(ALMOST))
        return bounded / (F.lit(1.0) - bounded)

    bounded = F.least(inclusion, F.lit(ALMOST))
    over = (random / (F.lit(1.0) - random)) * ((F.lit(1.0) - bounded) / bounded) * odds(usual)
    return F.when(inclusion <= 0, F.lit(1.0)).otherwise(over / (F.lit(1.0) + over))


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    total: float = 1.5,
    most: int = 2,
    weight: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """One row per document: its key, ``size``, ``source_size``, ``target`` of its source and ``copies``.

    ``weight``, above 0, makes documents of a source more or less likely against each other; those whose share reaches
    1 are taken for certain, and the others' shares grow by what that leaves. Documents with
    no words count like others of size 0. Null sources are a source of their own; rows with equal keys, or null
    ones, are documents of their own. Empty tables give empty ones.
    """
    stages = Stages(docs.sparkSession, "mixing")
    weighed, weight = weight is not None, F.lit(1.0) if weight is None else weight.cast("double")
    rows = stages.put(
        docs.select(
            F.col(key).alias("doc"), F.col(source).alias("source"), size.cast("long").alias("size"),
            weight.alias("weight"),
        ).withColumn("at", F.monotonically_increasing_id())
    )
    # Rows with a key of their own depend on nothing but the key; repeated ones are told apart by their place,
    # so that a key which holds many rows does not fall into a single bin.
    repeated = rows.groupBy(F.col("doc").alias("again")).agg(F.count("*").alias("n")).where("n > 1")
    repeated = stages.put(repeated.select("again", F.lit(True).alias("many")))
    drawn = F.col("doc").cast("string")
    if not repeated.isEmpty():
        rows = rows.join(repeated, F.col("doc").eqNullSafe(F.col("again")), "left").drop("again")
        place = F.concat(F.coalesce(drawn, F.lit("null")), F.lit("#"), F.col("at").cast("string"))
        drawn = F.when(F.col("many"), place).otherwise(drawn)
    rows = rows.withColumn("drawn", drawn)
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_docs"),
        F.sum(F.col("size") * F.col("weight")).alias("weighted"),
    )
    found = source_targets(sizes, weights, total, most).withColumnRenamed("source", "of")
    sources = sizes.select(F.col("source").alias("named"), "weighted")
    targets = stages.put(
        found.join(sources, F.col("of").eqNullSafe(F.col("named")))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
        .withColumn("bins", F.ceil(F.sqrt("source_docs")))
        .withColumn("scale", F.col("rest") / F.greatest(F.col("weighted"), F.lit(1.0)))
        .select("of", "source_size", "target", "whole", "rest", "bins", "scale")
    )
    if weighed:
        targets = _scaled(stages, rows, targets)
    inclusion = F.least(F.lit(1.0), F.col("weight") * F.col("scale"))
    usual = F.col("rest") / F.greatest(F.col("source_size"), F.lit(1))
    ranked = (
        rows.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rank", pareto_rank(uniform(F.col("drawn"), seed), inclusion, usual))
        .withColumn("bin", F.floor(F.col("rank") * F.col("bins")))
    )
    steps, picked = _fit(stages, ranked, targets)
    through = F.exists(
        "steps",
        lambda s: (F.col("bin") > s["after"])
        & (s["full_bin"].isNull() | (F.col("bin") < s["full_bin"]))
        & F.col("size").between(s["least"], s["left"]),
    )
    result = stages.put(
        ranked.join(steps, F.col("of").eqNullSafe(F.col("stepped")), "left")
        .join(picked, "at", "left")
        .withColumn("taken", F.coalesce(F.col("picked"), through, F.lit(False)))
        .select(
            F.col("doc").alias(key), F.col("source").alias(source), "size", "source_size", "target",
            (F.col("whole") + F.col("taken").cast("long")).alias("copies"),
        )
    )
    stages.drop(result)
    return result


def _scaled(stages: Stages, rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets whose ``scale`` turns weights into inclusions that are at most 1 and give ``rest`` words on average.

    Documents that reach 1 are certain, and what they leave is shared among the others, until no more reach it.
    Rows go in as words by source and weight.
    """
    groups = stages.put(rows.groupBy("source", "weight").agg(F.sum("size").alias("words"), F.count("*").alias("n")))
    before = -1
    while True:
        certain = F.col("weight") * F.col("scale") >= 1
        met = groups.join(targets.select("of", "scale"), F.col("source").eqNullSafe(F.col("of"))).groupBy("of").agg(
            F.sum(F.when(certain, F.col("words")).otherwise(0)).alias("sure"), F.sum(F.when(certain, F.col("n")).otherwise(0)).alias("n"),
            F.sum(F.when(certain, 0.0).otherwise(F.col("words") * F.col("weight"))).alias("shared"),
        )
        met = stages.put(met.withColumnRenamed("of", "at_source"))
        reached = met.agg(F.sum("n")).first()[0]
        if not reached or reached == before:
            return targets
        scale = F.when(F.col("shared") > 0, (F.col("rest") - F.col("sure")) / F.col("shared")).otherwise(F.col("scale"))
        joined = targets.join(met, F.col("of").eqNullSafe(F.col("at_source")))
        targets = stages.put(joined.select("of", "source_size", "target", "whole", "rest", "bins", F.greatest("scale", scale).alias("scale")))
        before = reached


def _fit(stages: Stages, ranked: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is taken, if documents in order of rank are taken whenever they fit in what is left of ``rest``.

    The first table has for each source its ``steps``: behind bin ``after`` and before ``full_bin`` all documents
    are taken whose size is from ``least`` to ``left``. Without a ``full_bin`` that goes on to the last bin. The second has
    the rows taken among those in a ``full_bin``. Each step ends at a document that does not fit, and what is left
    behind it is less than its size; ranks are random, so there are few steps, whatever the sizes.
    """
    behind = targets.where("rest > 0").select(
        F.col("of").alias("at_source"), F.lit(-1).cast("long").alias("after"), F.col("rest").alias("left"),
    )
    able = ranked.select("of", "at", "doc", "rank", "bin", "size")
    least, steps, picked, staged = 0, [], [], None
    while True:
        able = able.join(behind, F.col("of").eqNullSafe(F.col("at_source")))
        able = able.where((F.col("bin") > F.col("after")) & F.col("size").between(F.lit(least), F.col("left")))
        if steps:
            able = stages.put(able)
            if staged is not None:
                stages.forget(staged)
            staged = able
            if able.isEmpty():
                break
        bins = able.groupBy("of", "after", "left", "bin").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        crossing = F.when(F.col("before") + F.col("words") > F.col("left"), F.struct("bin", "before"))
        step = stages.put(
            bins.groupBy(F.col("of").alias("stepped"), "after", "left")
            .agg(F.min(crossing).alias("last"))
            .select(
                "stepped", "after", "left", F.col("last.bin").alias("full_bin"),
                (F.col("left") - F.col("last.before")).alias("open"), F.lit(least).cast("long").alias("least"),
            )
        )
        steps.append(step)
        full = step.where("full_bin IS NOT NULL").select("stepped", "full_bin", "open")
        inside = able.drop("at_source", "after", "left").join(
            full, F.col("of").eqNullSafe(F.col("stepped")) & (F.col("bin") == F.col("full_bin"))
        )
        fitted = stages.put(
            inside.where("size > 0")
            .groupBy("of", "full_bin", "open")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "doc", "at", "size"))).alias("rows"))
            .withColumn("fit", F.aggregate("rows", F.struct(F.col("open").alias("left"), F.array().cast("array<bigint>").alias("rows")), _take))
            .select("of", "full_bin", F.col("fit.left").alias("left"), F.col("fit.rows").alias("rows"))
        )
        picked.append(fitted.select(F.explode("rows").alias("at"), F.lit(True).alias("picked")))
        behind = fitted.where("left >= 1").select(F.col("of").alias("at_source"), F.col("full_bin").alias("after"), "left")
        able, least = able.select("of", "at", "doc", "rank", "bin", "size"), 1
    every, rows = steps[0], picked[0]
    for step, more in zip(steps[1:], picked[1:], strict=True):
        every, rows = every.unionByName(step), rows.unionByName(more)
    named = F.struct("after", "full_bin", "left", "least")
    return stages.put(every.groupBy("stepped").agg(F.collect_list(named).alias("steps"))), stages.put(rows)


def _take(so_far: Column, row: Column) -> Column:
    """What is left and the rows taken, with one more row if it fits."""
    fits = row["size"] <= so_far["left"]
    left = F.when(fits, so_far["left"] - row["size"]).otherwise(so_far["left"])
    rows = F.when(fits, F.array_append(so_far["rows"], row["at"])).otherwise(so_far["rows"])
    return F.struct(left.alias("left"), rows.alias("rows"))


def mixed_documents(docs: DataFrame, size: Column, text: str = "text", source: str = "source", key: str = "doc_id", **rules) -> DataFrame:
    """The mix itself: every document as often as ``mix`` says, all columns as they are.

    Rows with equal key and text share their copies.
    """
    stages = Stages(docs.sparkSession, "mixed")
    name, count, rows = free_name(docs, "row_hash"), free_name(docs, "copies"), free_name(docs, "rows")
    named = docs.withColumn(name, F.xxhash64(F.col(key), F.col(text)))
    found = mix(named, size, source, name, **rules).groupBy(name)
    found = stages.put(found.agg(F.sum("copies").cast("int").alias(count), F.count("*").alias(rows)))
    wanted = found.where(F.col(count) > 0).hint("merge")  # a row per document: never to be broadcast
    result = named.join(wanted.where(F.col(rows) == 1), name)
    if not wanted.where(F.col(rows) > 1).isEmpty():
        repeated = named.join(wanted.where(F.col(rows) > 1), name).dropDuplicates([name])
        result = result.unionByName(repeated)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stages.drop(found)
    repeat = F.explode(F.array_repeat(F.lit(0), F.col(count))).alias(free_name(result, "repeat"))
    return result.select(*columns, repeat).select(*columns)
