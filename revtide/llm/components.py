"""Connected components of a link table by alternating large-star and small-star rounds.

A round is a few joins and aggregates, combined on the map side, so a node with very many
links is no single task's work; each round is written to the shared folder. Links with a
null end are ignored, self-links and repeated links change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.select(F.col("hi").alias("node"), F.col("lo").alias("near")).union(links.select("lo", "hi"))
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    root = F.least("node", "least")
    return both.join(least, "node").filter("near > node").select(F.col("near").alias("hi"), root.alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = links.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.filter("hi > lo").union(least.select("hi", "least")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node of its component."""
    ends = F.col(a), F.col(b)
    current = stored(
        links.select(F.greatest(*ends).alias("hi"), F.least(*ends).alias("lo"))
        .filter(ends[0].isNotNull() & ends[1].isNotNull() & (F.col("hi") > F.col("lo"))).distinct(), "links"
    )
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, current = state, stored(_small_star(_large_star(current)), "links")
    roots = current.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
