"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b), root being the least node it is joined to.

    Each round points every node's greater neighbours, and then its lesser
    ones, to the least node known around it, till nothing changes; the number
    of rounds grows with the logarithm of the longest chain. Each round is
    written, so no lineage builds up. A node with very many edges is met by
    partial minima and an adaptive join. Edges of a node to itself are
    dropped; a repeated edge counts once; without edges there are no rows.
    """
    edges = written(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before, now = None, _state(edges)
    while now != before and now[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that both sides of the join are plain exchanges, of which hot nodes can be split
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a")
        small = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(joined.select("a", F.col("m").alias("b"))).distinct())
        before, now = now, _state(edges)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def joined(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """``parts`` (node, root), as ``components`` gives them, with further ``edges`` (a, b) taken in.

    The edges join roots, or nodes of no part yet. Only they go through the
    rounds, as a root stands for its whole part and is the least node of it.
    """
    over = written(components(edges))
    to = over.select(F.col("node").alias("of"), F.col("root").alias("into"))
    moved = parts.join(to, F.col("root") == F.col("of"), "left").select("node", F.coalesce("into", "root").alias("root"))
    return moved.union(over.join(parts.select("node"), "node", "left_anti").select("node", "root"))
