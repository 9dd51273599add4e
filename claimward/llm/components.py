"""Connected components of a table of links, by alternating star contractions.

Every round points the larger neighbours of a node at the smallest (large star), then the
smaller ones (small star), until the links no longer change; a chain needs about the square
of the logarithm of its length. Each round is written to the shared folder. A node with a
third of all links is a combined minimum and a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimward.llm.common import stored


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One contraction of links (a, b) with a > b."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("centre"), F.least("a", "m").alias("m")
    )
    joined = both.join(least, both["a"] == least["centre"])
    moved = joined.filter("b > a" if larger else "b < a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not larger:
        moved = moved.union(least.select(F.col("centre").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")
    ).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    ``links`` has two bigint columns a and b; order and repetition do not matter.
    """
    now = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        now = stored(_star(_star(now, True), False), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
