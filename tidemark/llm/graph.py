"""Groups of linked rows from shared buckets, without all pairs of a bucket and without the driver."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import materialize

MOST_PIVOTS = 32  # rows of a bucket that are compared with all others of it in one round
BROADCAST_ROWS = 1_000_000  # most shared buckets that go to every task; more are joined by a shuffle
SMALL = 32  # a bucket of at most so many rows that the first round leaves is finished at once


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): equal roots if and only if connected.

    Each round hangs every node below the one of least random rank within two steps and contracts the edges. So a star
    shrinks to a point in one round, and since ranks change with each round no order of ids makes long
    chains. Contracted edges and the maps are written tables. Loops and nulls are ignored.
    """
    left = materialize(_tidy(edges), "edges")
    maps = []
    while not left.isEmpty():
        ranked = lambda c: F.struct(F.xxhash64(c, F.lit(len(maps))).alias("rank"), F.col(c).alias("node"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("_near"))
        near = near.select("node", F.least("_near", ranked("node")).alias("_near"))
        far = both.join(near.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        parent = far.agg(F.min("_near").alias("_far")).select("node", F.col("_far.node").alias("root"))
        parent = materialize(parent, "parents")
        maps.append(parent)
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        moved = left.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        left = materialize(_tidy(moved), "edges")
    if not maps:
        return edges.sparkSession.createDataFrame([], "node long, root long")

    def climb(found: DataFrame, step: DataFrame) -> DataFrame:
        step = step.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        return found.join(step, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))

    return materialize(reduce(climb, maps[1:], maps[0]), "roots")


def _tidy(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter(F.col("a") < F.col("b"))
        .distinct()
    )


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The groups ``roots`` after merging those that ``links`` connect."""
    if roots is None:
        return components(links)
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
    between = links.join(a, "a", "left").join(b, "b", "left")
    between = between.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    moved = components(between)
    up = moved.select(F.col("node").alias("root"), F.col("root").alias("_up"))
    old = roots.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
    return materialize(old.unionByName(moved.join(roots, "node", "left_anti")), "roots")


def linked_groups(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    dense: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, root) of all nodes with a verified link, found through ``members`` (bucket, node: long).

    ``verify`` keeps those of the candidate pairs (a, b) that are linked. Every link whose two nodes share a bucket
    counts towards the groups. In each round some pivots of a bucket are paired with its nodes of other groups and
    then leave it: they have met everyone they could still join. A bucket whose nodes are all in one group is
    finished. So a bucket of near copies costs a few pairs a node, and no pair that could join two
    groups is left out. After the first round, buckets of at most SMALL nodes are paired in full; the larger ones go to ``dense``,
    which returns links (a, b) that connect all linked nodes of a bucket, or without it have MOST_PIVOTS
    pivots a round, from the smallest groups. Copies of a (bucket, node) row are harmless.
    """
    spans = members.groupBy("bucket").agg(F.min("node").alias("_least"), F.max("node").alias("_most"))
    shared = materialize(spans.filter(F.col("_least") < F.col("_most")).select("bucket"), "shared")
    few = shared.count() <= BROADCAST_ROWS
    active = members.join(F.broadcast(shared) if few else shared, "bucket", "left_semi").distinct()
    active = materialize(active.select("bucket", "node", F.col("node").alias("root"), F.lit(1).cast("long").alias("size")), "members")
    roots, first = None, True
    while not active.isEmpty():
        pivots = 1 if first else MOST_PIVOTS
        order = [F.struct("size", F.xxhash64("node", F.lit(i)) if i else F.col("node")) for i in range(pivots)]
        sized = active.groupBy("bucket").agg(
            F.count("node").alias("_n"),
            F.array_distinct(F.array(*[F.min_by(F.struct("node", "root"), o) for o in order])).alias("_pivots"),
        )
        found = []
        large = active.join(sized if first else sized.filter(F.col("_n") > SMALL), "bucket")
        if not first:
            few = materialize(active.join(sized.filter(F.col("_n") <= SMALL).select("bucket"), "bucket", "left_semi"), "small")
            others = few.select("bucket", F.col("node").alias("_node"), F.col("root").alias("_root"))
            found.append(verify(_pairs(few.join(others, "bucket").filter("node < _node"))))
            large = materialize(large, "large")
        if dense is not None and not first:
            found.append(dense(large.select("bucket", "node", "root")))
        else:
            pivot = F.explode("_pivots").alias("_p")
            met = large.select("node", "root", pivot).select(
                "node", "root", F.col("_p.node").alias("_node"), F.col("_p.root").alias("_root")
            )
            found.append(verify(_pairs(met)))
        links = materialize(reduce(DataFrame.unionByName, [f.select("a", "b") for f in found]), "links")
        roots = merged(roots, links)
        if dense is not None and not first:
            break
        rest = large.filter(~F.array_contains(F.col("_pivots.node"), F.col("node"))).select("bucket", "node")
        sizes = roots.groupBy("root").agg(F.count("node").alias("size"))
        rest = rest.join(roots.join(sizes, "root"), "node", "left").select(
            "bucket", "node", F.coalesce("root", "node").alias("root"), F.coalesce("size", F.lit(1)).alias("size")
        )
        apart = rest.groupBy("bucket").agg(F.min("root").alias("_least"), F.max("root").alias("_most"))
        apart = apart.filter(F.col("_least") < F.col("_most")).select("bucket")
        active = materialize(rest.join(apart, "bucket", "left_semi"), "members")
        first = False
    if roots is None:
        return members.sparkSession.createDataFrame([], "node long, root long")
    return roots


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b) of rows (node, root, _node, _root) in different groups, written."""
    met = met.filter(F.col("root") != F.col("_root"))
    return materialize(met.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct(), "pairs")
