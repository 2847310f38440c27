"""Connected components of a link table, in rounds over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.session import hand_over


def _stored(links: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The links, written once, with their number and a sum over their hashes."""
    stored = hand_over(links, "links").read(links.sparkSession)
    hashed = F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
    rows, total = stored.agg(F.count(F.lit(1)), hashed).first()
    return stored, (rows, int(total or 0))


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) of every node with a link.

    ``links`` has long columns a and b.  Each round connects the larger
    neighbours of every node to its smallest one, then the smaller neighbours and
    the node itself; the rounds end when the table no longer changes, after about
    the logarithm of the longest path.  Only grouped minima are gathered per node,
    so a node with many links is summed up before it is shuffled.
    """
    edges = links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    stored, state = _stored(edges.distinct())
    while state[0]:
        # Larger neighbours go to the smallest neighbour (or the node itself).
        both = stored.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
            stored.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select("m", "v")
        star = large.select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        # Smaller neighbours and the node go to the smallest of them.
        small = star.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        joined = star.join(small, star["high"] == small["u"])
        next_ = (
            joined.select(F.col("m").alias("low"), F.explode(F.array("low", "u")).alias("high"))
            .filter("low <> high")
            .distinct()
        )
        stored, after = _stored(next_)
        if after == state:
            break
        state = after
    # Every node but the roots is now high in exactly one link.
    found = stored.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = stored.select(F.col("low").alias("node")).distinct().withColumn("component", F.col("node"))
    return found.unionByName(roots)
