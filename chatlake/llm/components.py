"""Connected components of a graph given as pairs of whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.session import checkpointed, gathered


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """One step of alternating stars over ``n`` edges (a, b) with a > b, or fewer: neighbours are hung on
    the least node around; in a large step those above a node, in a small one those below."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    # stored first, so that both sides of the join come from plain exchanges and a node with
    # very many neighbours can be split among tasks
    least = gathered(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).where("m < a"), n)
    if large:
        joined = around.where("b > a").join(least, "a", "left")
        moved = joined.select(F.col("b").alias("a"), F.coalesce("m", "a").alias("b"))
    else:
        joined = around.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return gathered(moved.where("a > b").distinct(), n if large else 2 * n)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of every node that has an edge to
    another. ``edges`` has the columns ``a`` and ``b``, in any order and number; edges with a
    null end or from a node to itself are left out. Steps grow with the logarithm of a
    component's size."""
    known = edges.where("a is not null and b is not null and a <> b")
    current = checkpointed(known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark, n = None, current.count()
    while True:
        current = _star(_star(current, large=True, n=n), large=False, n=n)
        hashed = F.xxhash64("a", "b").cast("decimal(20,0)")
        new = tuple(current.agg(F.count("*"), F.sum(hashed)).first())
        if new == mark or new[0] == 0:
            break
        mark, n = new, new[0]
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
