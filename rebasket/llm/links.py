"""Near-duplicate classes from bucketed nodes, without pairs within a group.

A node is a distinct text; nodes that share a bucket are candidates.  Verifying
every pair of a bucket grows with the square of its size, so only buckets of a
few nodes are compared in full.  Larger ones are worked off in rounds: a few
pivots of every bucket are compared with its other members, and verified links
join classes.  A bucket whose members are in one class is finished, whatever its
size: further links inside a class change nothing.  The others go on with the
next pivots, more of them each round, until every member outside a bucket's
largest class has been compared with all members of other classes.  So no link
between different texts that share a bucket is lost, and a group of near copies
costs about its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.llm.components import components
from rebasket.session import hand_over

FEW = 6
"""Buckets of so many nodes are compared in full at once: at most 2.5 pairs a node."""
PIVOTS = (1, 16, 128, 1024, 8192)
"""Pivots per larger bucket of the first, second ... round; the last number goes on."""


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """The rows (bucket, node) of buckets with at least two nodes."""
    several = buckets.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    return buckets.join(several.filter("least < most").select("bucket"), "bucket").distinct()


def link_classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    more: DataFrame | None = None,
    percent: int = 0,
    differing: int | None = None,
) -> DataFrame:
    """node and component (the smallest node of its class) of every linked node.

    ``members`` are distinct rows (bucket, node, size) of stored shared buckets;
    sizes further apart than ``percent`` exclude a link and are not verified, and
    neither are nodes that differ in more than ``differing`` of the bits in
    ``bits0`` and ``bits1``, which ``members`` then has.
    ``verify`` takes distinct candidate pairs (a, b) and returns those that are
    linked.  ``more`` are links (a, b) that hold without verification.
    """
    spark = members.sparkSession
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    sized = hand_over(members.join(sizes, "bucket"), "buckets").read(spark)
    large = sized.filter(F.col("rows") > FEW).drop("rows")
    facts = ["size"] if differing is None else ["size", "bits0", "bits1"]

    def renamed(frame: DataFrame, prefix: str) -> DataFrame:
        return frame.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("node", "class", *facts)})

    def close(other: str) -> Column:
        """Whether the facts of p and of the other side allow a link."""
        sizes = 100 * F.least("p_size", f"{other}_size") >= percent * F.greatest("p_size", f"{other}_size")
        if differing is None:
            return sizes
        unlike = [F.bit_count(F.col(f"p_{b}").bitwiseXOR(F.col(f"{other}_{b}"))) for b in ("bits0", "bits1")]
        return sizes & (unlike[0] + unlike[1] <= differing)

    few = sized.filter(F.col("rows") <= FEW).drop("rows")
    links = (
        renamed(few, "p")
        .join(renamed(few, "q"), "bucket")
        .filter((F.col("p_node") < F.col("q_node")) & close("q"))
        .select(F.col("p_node").alias("a"), F.col("q_node").alias("b"))
    )
    classes, done = None, None
    for number in range(10_000):
        open_ = large.withColumn("class", F.col("node")) if classes is None else _open_members(large, classes)
        if number:
            open_ = hand_over(open_, "open").read(spark)
        chosen = hand_over(_pivots(open_, done, PIVOTS[min(number, len(PIVOTS) - 1)]), "pivots").read(spark)
        if number and chosen.isEmpty():
            break
        tried = chosen.select("bucket", "node")
        done = tried if done is None else done.unionByName(tried)
        pairs = (
            renamed(chosen, "p")
            .join(renamed(open_, "q"), "bucket")
            .filter((F.col("p_class") != F.col("q_class")) & close("q"))
            .select(F.least("p_node", "q_node").alias("a"), F.greatest("p_node", "q_node").alias("b"))
        )
        if not number:
            pairs = pairs.unionByName(links)
        found = hand_over(verify(pairs.distinct()).select("a", "b"), "verified").read(spark)
        if classes is None:
            known = found if more is None else found.unionByName(more.select("a", "b"))
            classes = hand_over(components(known), "classes").read(spark)
        elif not found.isEmpty():
            classes = hand_over(_joined_classes(classes, found), "classes").read(spark)
    return classes


def _joined_classes(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` after more links, which only concern the classes that they connect."""
    of_a = classes.select(F.col("node").alias("a"), F.col("component").alias("class_a"))
    of_b = classes.select(F.col("node").alias("b"), F.col("component").alias("class_b"))
    between = found.join(of_a, "a", "left").join(of_b, "b", "left")
    merged = hand_over(
        components(between.select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))), "merged"
    ).read(classes.sparkSession)
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = classes.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return old.unionByName(merged.join(classes, "node", "left_anti"))


def _open_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class, of the buckets that still hold several classes."""
    labelled = members.join(classes, "node", "left").select(
        *members.columns, F.coalesce("component", "node").alias("class")
    )
    several = labelled.groupBy("bucket").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    return labelled.join(several.filter("least < most").select("bucket"), "bucket")


def _pivots(open_: DataFrame, done: DataFrame | None, pivots: int) -> DataFrame:
    """The next ``pivots`` members of every bucket outside its largest class."""
    if done is None:
        return open_.groupBy("bucket").agg(F.min_by(F.struct(*open_.columns), "node").alias("of")).select("of.*")
    sizes = open_.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("rows"))
    base = sizes.groupBy("bucket").agg(F.max_by("class", F.struct("rows", "class")).alias("base"))
    rest = open_.join(base, "bucket").filter("class <> base").drop("base").join(done, ["bucket", "node"], "left_anti")
    order = Window.partitionBy("bucket").orderBy("node")
    return rest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pivots).drop("rank")
