"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiered.llm import shared

#: Links that one task joins without a shuffle: a round of so few costs more to deal than to join.
FEW = 1 << 15


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has a link; root is the smallest node it can reach.

    `edges` has two whole-number columns a, b. Each round moves the larger neighbours of a
    node to its smallest neighbour, then the smaller ones; the rounds grow with the logarithm
    of the longest path, not with the size of a group. Smallest neighbours are aggregates
    with partial sums on the map side and join back, a join that Spark can split where one
    node has very many links. Rounds are tables in the shared folder, dropped when used.
    Rounds of at most FEW links are one task each. Links of a node with itself and repeated
    links change nothing; nulls are no links.
    """
    large, small = F.greatest("a", "b"), F.least("a", "b")
    known = edges.where("a is not null and b is not null and a <> b")
    current = shared.staged(known.select(large.alias("u"), small.alias("v")).distinct(), "links")
    mark = _mark(current)
    while mark[0]:
        few = mark[0] <= FEW

        def dealt(rows: DataFrame, few: bool = few) -> DataFrame:
            return rows.coalesce(1) if few else rows

        links = dealt(current)
        reverse = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
        low = dealt(links.union(reverse)).groupBy("u").agg(F.min("v").alias("low"))
        low = low.select(F.col("u").alias("v"), F.least("u", "low").alias("low"))
        far = links.join(low, "v").select("u", F.col("low").alias("v"))
        least = far.groupBy("u").agg(F.min("v").alias("low"))
        near = far.join(least, "u").where("v <> low").select(
            F.col("v").alias("u"), F.col("low").alias("v")
        )
        following = shared.staged(
            dealt(near.union(least.select("u", F.col("low").alias("v")))).distinct(), "links"
        )
        before, mark = mark, _mark(following)
        shared.dropped(current)
        current = following
        if mark == before:
            break
    current = current.coalesce(1) if mark[0] <= FEW else current
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select("v", F.col("v").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
        ).first()
    )
