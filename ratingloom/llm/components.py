"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import discard, saved


def _jump(parent: DataFrame) -> DataFrame:
    """Every node's root, by doubling the steps until all parents are roots."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        longer = saved(parent.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("next"), "parent"), "jump")
        discard(parent)
        moved = longer.where(F.col("next") != F.col("parent")).limit(1).count()
        parent = longer.select("node", F.col("next").alias("parent"))
        parent.written_to = longer.written_to
        if not moved:
            return parent


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node of ``links(a, b)``.

    Each node points to its smallest neighbour; the trees collapse to their roots, links between
    roots stay, and the rest repeats on at most half as many nodes. Nothing is collected, and a
    node with any number of links is met only in joins and minima.
    """
    links = saved(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    steps: list[DataFrame] = []
    while links.limit(1).count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        root = _jump(near.select("node", F.least("node", "near").alias("parent")))
        steps.append(root)
        left = root.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = root.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        between = links.join(left, "a").join(right, "b").where("ra <> rb")
        before, links = links, saved(between.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        discard(before)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = steps[0].withColumnRenamed("parent", "component")
    for root in steps[1:]:
        up = root.select(F.col("node").alias("component"), F.col("parent").alias("above"))
        out = out.join(up, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return out
