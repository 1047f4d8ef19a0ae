"""Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

Rows become leaves; the leaves of a group, in order, are joined three by three until one node is left, and
those subroots, in order of their groups, are joined likewise to the root. Every level is a table of runs, one row
for three nodes at most. Then each node knows its run's parent and what stands left and right of it there. Proofs
grow by self-joins: a node takes over the path of the ancestor it points to and points to where that one points,
so that distance and path double each time, and a tree of height h needs log2(h) joins.

Nothing depends on one task holding a group: leaves are numbered range by range, and an ancestor that many
nodes point to is joined in copies, one for ``CROWD`` of them, so that the copies are few beside the nodes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages

#: Nodes of a run.
RUN = 3
#: Leaves that are numbered together.
RANGE = 1 << 18
#: Nodes that one copy of an ancestor is joined with, about.
CROWD = 128
#: The tree whose leaves are the subroots.
TOP = -1

NODE = ("tree", "level", "idx")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields as hex: of each its UTF-8 byte count, a colon and its value, or ``-`` if it is null."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(digest: Column, path: Column) -> Column:
    """The digest a path leads to, from the binary digest of the node it starts at."""

    def up(below: Column, siblings: Column) -> Column:
        joined = F.concat(hexed(siblings["left"]), hexed(below), hexed(siblings["right"]))
        return F.unhex(F.sha2(joined.cast("binary"), 256))

    return F.aggregate(path, digest, up)


def proof_digest(path: Column) -> Column:
    """SHA-256, as hex, of all siblings on a path from below, left to right."""
    siblings = F.transform(path, lambda p: F.concat(hexed(p["left"]), hexed(p["right"])))
    return F.sha2(F.concat_ws("", siblings).cast("binary"), 256)


def numbered(stages: Stages, rows: DataFrame) -> DataFrame:
    """Rows ``(group, key, leaf, tie, ...)`` with the number ``tree`` of their group, ``idx`` within it and its ``width``.

    Groups go by their order, null first; rows of a group by key, null first, then by leaf. Rows are dealt
    out to ranges and numbered there, behind as many as the ranges before hold.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE))
    dealt = rows.repartitionByRange(ranges, "group", "key", "leaf", "tie").withColumn("range", F.spark_partition_id())
    dealt = stages.put(dealt)
    sizes = stages.put(dealt.groupBy("group", "range").agg(F.count("*").alias("n")))
    begins = sizes.groupBy("group").agg(F.min("range").alias("range")).withColumn(
        "at", F.expr("row_number() OVER (PARTITION BY range ORDER BY group)")
    )
    begins = stages.put(begins)
    # One row for each range.
    before = begins.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.expr("coalesce(sum(n) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("before")
    )
    trees = begins.join(before, "range").select(F.col("group").alias("of"), (F.col("before") + F.col("at") - 1).alias("tree"))
    first = F.expr("coalesce(sum(n) OVER (PARTITION BY group ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    width = F.expr("sum(n) OVER (PARTITION BY group)")
    places = sizes.withColumn("first", first).withColumn("width", width).join(trees, F.col("group").eqNullSafe(F.col("of")))
    places = stages.put(places.select(F.col("group").alias("of"), F.col("range").alias("in_range"), "first", "width", "tree"))
    at = F.expr("row_number() OVER (PARTITION BY range, group ORDER BY key, leaf, tie)")
    here = (F.col("range") == F.col("in_range")) & F.col("group").eqNullSafe(F.col("of"))
    return (
        dealt.withColumn("at", at).join(places.hint("merge"), here)
        .withColumn("idx", (F.col("first") + F.col("at") - 1).cast("long"))
        .drop("of", "in_range", "first", "at", "range", "tie")
    )


def _runs(nodes: DataFrame) -> DataFrame:
    """The next level: one row for each run of nodes, with its nodes in order."""
    runs = nodes.groupBy("tree", F.expr(f"idx div {RUN}").alias("parent"), "width")
    runs = runs.agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "below", "height", "item"))).alias("run"))
    digests = F.concat_ws("", F.transform("run", lambda n: hexed(n["digest"])))
    return runs.select(
        "tree", F.col("parent").alias("idx"), "run", F.unhex(F.sha2(digests.cast("binary"), 256)).alias("digest"),
        F.aggregate("run", F.lit(0).cast("long"), lambda a, n: a + n["below"]).alias("below"),
        (F.array_max(F.transform("run", lambda n: n["height"])) + 1).alias("height"),
        F.ceil(F.col("width") / RUN).cast("long").alias("width"),
    )


def _members(runs: DataFrame, level: int, top: bool) -> DataFrame:
    """The nodes of runs: their names, their parents' names and the digests to their left and right.

    What is left of a group's tree is a leaf of the top tree and goes by that name.
    """
    if top:
        up = [F.lit(TOP), F.lit(level + 1), F.col("idx")]
    else:
        last = F.col("width") == 1
        up = [F.when(last, TOP).otherwise(F.col("tree")), F.when(last, 0).otherwise(level + 1), F.when(last, F.col("tree")).otherwise(F.col("idx"))]
    rows = runs.select(
        *(u.cast(kind).alias(f"up_{name}") for u, name, kind in zip(up, NODE, ("long", "int", "long"), strict=True)),
        F.col("below").alias("up_below"), "tree", F.lit(level).alias("level"), "run", F.posexplode("run").alias("at", "node"),
    )

    def sibling(i: int) -> Column:
        return F.coalesce(F.get("run", F.lit(i))["digest"], F.lit(b""))

    left = [F.when(F.col("at") > i, sibling(i)).otherwise(F.lit(b"")) for i in range(RUN - 1)]
    right = [F.when(F.col("at") < i, sibling(i)).otherwise(F.lit(b"")) for i in range(1, RUN)]
    step = F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"), F.lit(top).alias("top"))
    return rows.select(
        "tree", "level", *(F.col(f"node.{name}").alias(name) for name in ("idx", "below", "height", "item")),
        *(f"up_{name}" for name in (*NODE, "below")), F.array(step).alias("path"),
    )


def _grow(stages: Stages, nodes: DataFrame, top: bool) -> tuple[DataFrame, DataFrame, int]:
    """Nodes below the roots of trees, the roots themselves, and the number of levels below the highest."""
    found, roots, level = [], [], 0
    while True:
        roots.append(nodes.where("width = 1").select("tree", "digest", "below", "height", "item"))
        runs = stages.put(_runs(nodes.where("width > 1")))
        found.append(_members(runs, level, top))
        if runs.isEmpty():
            return reduce(DataFrame.unionByName, found), stages.put(reduce(DataFrame.unionByName, roots)), level
        # Only leaves are items.
        nodes = runs.drop("run").withColumn("item", F.lit(None).cast(nodes.schema["item"].dataType))
        level += 1


def jump(stages: Stages, nodes: DataFrame, height: int) -> DataFrame:
    """Leaves with the whole ``path`` to the root, from nodes that know no more than their parents.

    Each round joins nodes with those they point to, ``distance`` levels up. An ancestor that ``n`` nodes may point
    to, ``n`` being bounded by its leaves and by ``RUN ** distance``, is there in ``n / CROWD`` copies.
    """
    distance = 1
    while distance < height:

        def copies(below: str, most: int = min(RUN**distance, 1 << 60)) -> Column:
            return F.ceil(F.least(F.col(below), F.lit(most)) / CROWD).cast("long")

        if 2 * distance >= height:
            nodes, source = nodes.where("item IS NOT NULL"), nodes
        else:
            source = nodes
        above = source.where(F.col("height") >= distance).select(
            *(F.col(name).alias(f"a_{name}") for name in NODE),
            *(F.col(f"up_{name}").alias(f"next_{name}") for name in (*NODE, "below")),
            F.col("path").alias("rest"), F.col("at_root").alias("ends"),
            F.explode(F.sequence(F.lit(0).cast("long"), copies("below") - 1)).alias("a_copy"),
        )
        waiting = nodes.where("NOT at_root").withColumn("copy", F.pmod(F.xxhash64(*NODE), copies("up_below")))
        same = [F.col(f"up_{name}") == F.col(f"a_{name}") for name in NODE]
        met = waiting.join(above.hint("merge"), reduce(Column.__and__, same, F.col("copy") == F.col("a_copy")))
        met = met.select(
            *NODE, "below", "height", "item", *(F.col(f"next_{name}").alias(f"up_{name}") for name in (*NODE, "below")),
            F.concat("path", "rest").alias("path"), F.col("ends").alias("at_root"),
        )
        grown = stages.put(nodes.where("at_root").unionByName(met))
        stages.forget(source)
        nodes, distance = grown, 2 * distance
    return nodes.where("item IS NOT NULL")


def manifest(rows: DataFrame, fields: Sequence[str], group: str, key: str, altered: Column | None = None) -> DataFrame:
    """``(key, leaf, altered, subroot, root, path)`` for every row: binary digests, and the siblings from leaf to root.

    A leaf is the digest of ``fields``; ``altered``, another binary digest of the row, is carried along, null if not
    given. ``path`` holds, from below, what stands left and right of the node in its run, and whether that run is above
    the subroots; a node alone in its run has nothing on either side. Groups are ordered with null first, by UTF-8
    bytes if they are text; rows of a group by key, null first, equal keys by leaf; equal rows are leaves each. An
    empty table has no rows and no root. A single row is its own subroot and root, its path is empty. Other
    columns are not looked at, whatever their names.
    """
    stages = Stages(rows.sparkSession, "merkle")
    leaf = F.unhex(leaf_digest([F.col(name) for name in fields]))
    other = F.lit(None).cast("binary") if altered is None else altered
    leaves = stages.put(rows.select(
        F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("leaf"), other.alias("altered"),
        F.monotonically_increasing_id().alias("tie"),
    ))
    placed = stages.put(numbered(stages, leaves).select(
        "tree", "idx", "width", F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("below"), F.lit(0).alias("height"),
        F.struct("key", "leaf", "altered").alias("item"),
    ))
    nodes, subroots, _ = _grow(stages, placed, False)
    groups = subroots.count()
    subroots = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(groups).cast("long").alias("width"),
        "digest", "below", "height", "item",
    )
    above, roots, levels = _grow(stages, subroots, True)
    root = roots.first()  # one row, or none
    at_root = (F.col("up_tree") == TOP) & (F.col("up_level") == levels)
    nodes = stages.put(nodes.unionByName(above).withColumn("at_root", at_root))
    proven = jump(stages, nodes, root["height"] if root else 0).select("item", "path")
    single = roots.where("item IS NOT NULL").select("item", F.array().cast(proven.schema["path"].dataType).alias("path"))
    result = stages.put(proven.unionByName(single).select(
        F.col("item.key").alias(key), "item.leaf", "item.altered",
        fold(F.col("item.leaf"), F.filter("path", lambda p: ~p["top"])).alias("subroot"),
        F.lit(bytes(root["digest"]) if root else None).cast("binary").alias("root"), "path",
    ))
    stages.drop(result)
    return result
