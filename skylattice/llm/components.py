"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join of edges with it, so a node of any degree is
combined before it is shuffled and a hot node in the join can be split. Every step is a
written table: a lost executor repeats one step at most. Only a count reaches the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.session import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.explode(ends).alias("e")).select("e.u", "e.v")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour goes to the smallest one around. Small: the others do."""
    if large:
        around = _both_ways(edges)
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = around.join(least, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select("v", "m")
    else:
        moved = moved.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    return moved.where(F.col("v") != F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node of an edge ``a, b`` with the smallest node reachable."""
    now = edges.select("a", "b").where("a != b")
    before = None
    while True:
        now = settle(_star(_star(now, True), False), "components")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = state
