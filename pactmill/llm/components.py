"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pactmill import session


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest id reachable from every id in ``links`` (a, b): id, component. Ids without a link do not appear.

    Large-star and small-star steps in turn: every id hands the smallest id it knows to its larger neighbours, then to its smaller
    ones, until only stars are left. The rounds grow with the logarithm of the longest chain. Each step is a grouped minimum and a join, so
    that no id's links come together in one place, and is stored in the shared folder.
    """
    edges = session.stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # in ``large`` every u is the larger end
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = session.stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        # done when every id hangs on one other, and on none that hangs on another itself
        once = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        if once and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
