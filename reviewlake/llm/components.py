"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type -> (node, root): root is the component's least node.

    Each round points every node and its larger neighbours to the least neighbour, then every node's
    smaller neighbours to their least; rounds grow with the logarithm of the component size. The edge
    table is cut to the checkpoint folder per round and only a count and a hash reach the driver. Loops
    and repeated edges do no harm; an empty table gives an empty table.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = cut(small)
        new = _state(now)
        if new == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = new
