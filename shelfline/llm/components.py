"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a join of the links with the smallest neighbour of one end; nothing
is collected.  The extra join key keeps the join's exchanges apart from the
aggregate's, so that Spark can split the links of a hub over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _with_smallest(links: DataFrame) -> DataFrame:
    """links (u, v) with m, the smallest v of each u."""
    m = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("x", F.xxhash64("u"))
    return links.withColumn("x", F.xxhash64("u")).join(m, ["u", "x"]).select("u", "v", "m")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the smallest node reachable, for every linked node.

    Self links and null ends are ignored; nodes without a link have no row.
    """
    e = staged(links.where(F.col(a) != F.col(b))
               .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while not _is_star_forest(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_smallest(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        small = _with_smallest(large).select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _is_star_forest(e: DataFrame) -> bool:
    """Every node has at most one smaller neighbour, and none that has one is a centre."""
    roles = (e.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("centre"))
             .unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("centre"))))
    bad = (roles.groupBy("node").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
           .where("child > 1 or (child = 1 and centre = 1)"))
    return bad.isEmpty()
