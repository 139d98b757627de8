"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(a, b)`` links between ids -> ``(node, component)`` for every id in
    a link, component being the smallest id reachable.

    Large-star then small-star per round: each hooks neighbours to the
    smallest one, so the rounds grow with the logarithm of a component's
    size and the edge count never grows.  Every step is a min-aggregate
    (combined before the shuffle) and a join, so hub nodes do not gather
    their neighbours in a task.  Self-links, repeated and null links are
    ignored."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where(F.col("a") != F.col("b")).distinct()
    e = scratch.save(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(low, "a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(low, "a").where(F.col("b") != F.col("m")) \
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = hooked.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after = scratch.save(after, "stars")
        new = _mark(after)
        scratch.drop(e)
        e = after
        if new == mark:
            break
        mark = new
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
