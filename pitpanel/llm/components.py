"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` edges that is not its component's least.

    Alternating large and small stars: every round links each node to the least of
    its neighbours, and the edges become one star per component after a number of
    rounds that grows with the logarithm of the nodes.  Each round is written to the
    checkpoint folder.  Minima are pre-aggregated before the shuffle, and the joins
    back are plain equi-joins that adaptive execution splits where a hub is hot.
    """
    stars = edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    seen = None
    while True:
        stars = materialize(stars, "stars")
        now = tuple(stars.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("lo", "hi")), F.lit(0))).first())
        if now == seen or now[0] == 0:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = now
        both = stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(stars.select("hi", "lo"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        linked = large.join(least, "hi")
        stars = (linked.select(F.col("m").alias("lo"), "hi")
                 .union(linked.where("lo <> m").select("m", F.col("lo").alias("hi")))).distinct()
