"""Connected components of a link table, by alternating star contraction.

Links stay distributed throughout.  Each round replaces every node's links by
links to the smallest node that it knows of (first over all its neighbours, then
over the smaller ones), which ends in stars whose centre is the smallest id of the
component, after a number of rounds that grows with the logarithm of the size.
Minima are pre-aggregated per task, and the joins are plain equi-joins on a node,
so a hub with a third of all links is split by the skew handling of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    around = _both_ways(links)
    centre = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        around.where("b > a").join(centre, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    # Here a > b in every link.
    centre = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(centre, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(centre.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (a, b).

    NULL ends and self-links are ignored; direction and repetition do not matter;
    no links give an empty result.
    """
    current = cut(
        links.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        current = cut(_small_star(_large_star(current)))
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
