"""Connected components of a link table by alternating star contraction.

Each round rewires every node's larger neighbours to its least one (large star),
then every node's smaller ones (small star), until nothing changes: then every
node hangs on its component's least node.  Rounds are logarithmic in the longest
path; each is one aggregation and one join on the node, with the links written
to the shared checkpoint folder.  A hub with a third of all links is one row on
the aggregated side, and AQE splits the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._shared import settled


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("least"))
    out = both.join(least, both.a == least.node).where("b > a and b <> least")
    return out.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    moved = links.join(least, links.a == least.node).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) of one orderable type.  Returns (node, root), root the least node reachable, for every node
    of a link that is not its own root."""
    now = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if tuple(state) == mark or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(state)
        now = settled(_small(_large(now)))
