"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Attach the neighbours of every node to its smallest neighbour, or to itself if that is smaller.

    ``larger_only`` moves the larger neighbours (the rest stay as they are); otherwise the smaller ones.
    """
    both = links.union(links.select("b", "a")) if larger_only else links.select(F.greatest("a", "b"), F.least("a", "b"))
    both = both.toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = both.join(least, "u")
    if larger_only:
        return moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)``: the smallest node of each node's component.

    Nodes without a link to another node do not appear. Rounds alternate between moving larger and smaller
    neighbours to a node's smallest neighbour, which shortens chains geometrically; each round is written
    to the shared folder. The loop ends when every node hangs on one root directly.
    """
    links = staged(links.select("a", "b").where("a <> b"))
    while True:
        links = staged(_star(_star(links, True), False))
        loose = links.groupBy("a").agg(F.count_distinct("b").alias("n"), F.min("b").alias("b"))
        inner = links.select(F.col("b").alias("a")).join(links.select("a"), "a", "left_semi")
        if loose.where("n > 1").isEmpty() and inner.isEmpty():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
