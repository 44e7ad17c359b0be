"""Merkle manifest of a dataset by slot pivot.

Rows are leaves; each group has a tree of its own, and the trees' roots are
the leaves of one more tree.  A level is one aggregation by (tree, parent):
conditional aggregates spread the children of a parent into ``fanout``
columns, one a slot.  The columns in order, concatenated, hash to the parent;
leaving out a slot's own column gives that child's siblings.  Levels shrink by
the fanout, so the pivoted tables together are little more than the leaves.
Proofs run down the same tables: a parent's path is joined onto its one
pivoted row and exploded to its children.

Places in a tree come from a range-partitioned sort and the sizes of the
(partition, tree) runs, so no tree, however large, meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FANOUT = 16
# Parts of a path, from leaf to root: digests before and after the own slot.
_STEP = "array<struct<before:string,after:string>>"


def digest_of(*values: Column) -> Column:
    """Hash of values that tells their borders and nulls apart: each is ``-``
    if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-"))
                             .otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``pos``, a row's place among those of its ``tree`` by ``order``, and
    ``n``, the rows of that tree.

    Rows are range-partitioned and sorted; only the sizes of (partition, tree)
    runs, at most partitions plus trees many, are summed in order.  A tree
    that spans many partitions costs one of these rows for each.
    """
    placed = written(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                     .withColumn("_spot", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_spot", 33)
    runs = placed.groupBy(tree, part.alias("_part")).agg(F.min("_spot").alias("_first"), F.count(F.lit(1)).alias("_m"))
    whole = Window.partitionBy(tree)
    runs = runs.select(
        tree, "_part", F.sum("_m").over(whole).alias("n"),
        (F.sum("_m").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_m") - F.col("_first")).alias("_shift"))
    joined = placed.withColumn("_part", part).join(runs, [tree, "_part"])
    return joined.withColumn("pos", F.col("_spot") + F.col("_shift")).drop("_spot", "_part", "_shift")


@dataclass
class Levels:
    """Pivoted levels, from the leaves' parents up, and what remains on top:
    ``roots`` (tree, height, digest, node); ``node`` is the leaf's own struct
    where the leaf is all there is."""
    wide: list[DataFrame]
    roots: DataFrame
    fanout: int


def build(leaves: DataFrame, fanout: int = FANOUT) -> Levels:
    """Pivot ``leaves`` (tree, pos, n, node), ``node`` being a struct with a
    ``digest``, level by level until every tree has one node left."""
    spark = leaves.sparkSession
    leaves = written(leaves, "leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    roots = leaves.where("n = 1").select("tree", F.lit(0).alias("height"), F.col("node.digest").alias("digest"), "node")
    wide, nodes = [], leaves
    while most > 1:
        slots = [f"max(if(pos % {fanout} = {j}, node, null)) AS s{j}" for j in range(fanout)]
        digests = ", ".join(f"s{j}.digest" for j in range(fanout))
        level = (nodes.where("n > 1").withColumn("parent", F.floor(F.col("pos") / fanout).cast("long"))
                 .groupBy("tree", "parent").agg(F.max("n").alias("n"), *map(F.expr, slots))
                 .withColumn("digest", F.expr(f"sha2(concat_ws('', {digests}), 256)")))
        wide.append(written(level, "pivot"))
        most = -(-most // fanout)
        nodes = wide[-1].select("tree", F.col("parent").alias("pos"),
                                F.ceil(F.col("n") / fanout).cast("long").alias("n"),
                                F.struct("digest").alias("node"))
        roots = roots.unionByName(nodes.where("n = 1").select(
            "tree", F.lit(len(wide)).alias("height"), F.col("node.digest").alias("digest"),
            F.lit(None).cast(leaves.schema["node"].dataType).alias("node")))
    return Levels(wide, written(roots, "roots") if wide else roots, fanout)


def _children(wide: DataFrame, above: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """The children of the nodes ``above`` (tree, pos, path, carried ...), each
    with its own step before its parent's path."""
    digests = [f"s{j}.digest" for j in range(fanout)]
    joined = lambda some: f"concat_ws({', '.join([repr(''), *some])})"
    kids = ", ".join(f"if(s{j} is null, null, named_struct('slot', {j}, 'node', s{j}, "
                     f"'before', {joined(digests[:j])}, 'after', {joined(digests[j + 1:])}))" for j in range(fanout))
    both = wide.join(above.withColumnRenamed("pos", "parent"), ["tree", "parent"])
    spread = both.select("tree", "parent", "path", *carried, F.expr(f"explode(array_compact(array({kids})))").alias("kid"))
    return spread.select(
        "tree", (F.col("parent") * fanout + F.col("kid.slot")).alias("pos"),
        F.concat(F.array(F.struct("kid.before", "kid.after")), F.col("path")).alias("path"),
        *carried, F.col("kid.node").alias("node"))


def paths(levels: Levels, tops: DataFrame, *carried: str) -> DataFrame:
    """Every leaf's (tree, node, path, carried ...).

    ``tops`` gives each tree's (tree, path above its root, carried ...)."""
    starts = levels.roots.select("tree", "height", "node").join(tops, "tree")
    found = starts.where("height = 0").select("tree", "node", "path", *carried)
    above = None
    for height in range(len(levels.wide), 0, -1):
        begin = starts.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("pos"), "path", *carried)
        above = begin if above is None else begin.unionByName(above.drop("node"))
        above = _children(levels.wide[height - 1], above, levels.fanout, list(carried))
    return found if above is None else found.unionByName(above.select("tree", "node", "path", *carried))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with its siblings."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def merkle_manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    id_col: str = "doc_id", group_col: str = "source", observed: Column | None = None,
                    fanout: int = FANOUT) -> DataFrame:
    """Commit every row of ``docs`` and check each against the root.

    A leaf is :func:`digest_of` of ``columns``.  Leaves of one ``group_col``
    value ascend by ``id_col`` (nulls first; equal ids by leaf); groups ascend
    by value (null first, bytewise).  While several nodes remain, runs of
    ``fanout`` become the hash of their digests, the last run however short.

    ``observed`` is the digest found at audit time, an expression over
    ``docs``; null means the leaf itself.  Returns one row per input row:
    ``id_col, group, leaf, subroot, root, path`` (siblings before and after
    the own slot, leaf to root), ``folded_root`` (from the observed digest and
    the original siblings) and ``verified``.  Null values are committed as
    nulls; repeated rows are leaves of their own; a table without rows gives
    none; columns outside ``columns`` are not committed and do not matter.
    """
    shown = F.lit(None).cast("string") if observed is None else observed
    rows = docs.select(
        F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
        .alias("tree"), F.col(id_col).alias("id"), digest_of(*[F.col(c) for c in columns]).alias("leaf"),
        shown.alias("observed"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "digests")
    node = F.struct(F.col("leaf").alias("digest"), "id", "observed")
    trees = build(numbered(rows, "tree", "id", "leaf", "row").select("tree", "pos", "n", node.alias("node")), fanout)
    one = F.struct("digest", F.col("tree").alias("group"))
    forest = build(numbered(trees.roots.select(F.lit("").alias("forest"), "tree", "digest"), "forest", "tree")
                   .select(F.col("forest").alias("tree"), "pos", "n", one.alias("node")), fanout)
    root = forest.roots.select(F.col("tree"), F.expr(f"cast(array() as {_STEP})").alias("path"),
                               F.col("digest").alias("root"))
    tops = paths(forest, root, "root").select(F.col("node.group").alias("tree"), "path", "root",
                                              F.col("node.digest").alias("subroot"))
    leaves = paths(trees, written(tops, "subroots"), "root", "subroot")
    found = folded(F.coalesce("node.observed", "node.digest"), F.col("path"))
    out = leaves.select(F.col("node.id").alias(id_col), F.expr("nullif(tree, '')").substr(2, 2 ** 31 - 1).alias("group"),
                        F.col("node.digest").alias("leaf"), "subroot", "root", "path", found.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, left to right, leaf to root."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))), 256)
