"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a``, ``b``, of one orderable type).

    ``root`` is the smallest node of the component. Alternating large-star and
    small-star steps point every node at its smallest known neighbour until all
    components are stars: O(log^2) rounds, whatever the diameter, and never more
    links than there were. Each round is written to the shared folder; a node with
    very many links meets only its own minimum, in a join that can be split.
    Loops, repeated links and links with a null end are allowed and add nothing.
    """
    stars = written(
        links.where("a <> b").select(
            F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
        ).distinct(),
        "links",
    )
    mark = _mark(stars)
    while True:
        stars = written(_small_star(_large_star(stars)), "stars")
        last, mark = mark, _mark(stars)
        if mark == last:
            return stars.union(stars.select("root", "root").distinct())


def _mark(stars: DataFrame) -> tuple:
    """Number and checksum of the links; equal after a round that changed nothing."""
    both = F.xxhash64("node", "root")
    return tuple(stars.agg(F.count("*"), F.bit_xor(both), F.sum(F.shiftright(both, 24))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    ends = stars.select(F.col("node").alias("u"), F.col("root").alias("v")).union(
        stars.select("root", "node")
    )
    least = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return ends.where("v > u").join(least, "u").select(
        F.col("v").alias("node"), F.col("m").alias("root")
    ).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = stars.groupBy("node").agg(F.min("root").alias("m"))
    moved = stars.join(least, "node").where("root <> m").select(
        F.col("root").alias("node"), F.col("m").alias("root")
    )
    return moved.union(least.select("node", "m")).distinct()
