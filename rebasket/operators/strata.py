"""Stratified splits by a label of any number of values, with exact sizes.

How many rows each class gives, and which hash its last row has, are tables that
are joined, so neither the driver nor an expression holds the classes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.functions.hashing import row_hash
from rebasket.session import hand_over

BUCKET_DIGITS = 3
HASH_DIGITS = 32
_ALL = "~"  # above every hex digit


def numbered_in_order(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``place``, 1 for the first row in order: sorted over all tasks, none ranks the whole table."""
    spark = df.sparkSession
    by_task = df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
    stored = hand_over(by_task, "in-order").read(spark)
    task, mask = F.shiftright("_row", 33), (1 << 33) - 1
    counts = stored.groupBy(task.alias("_task")).agg(F.count("*").alias("n")).collect()  # a row per task
    before, starts = 0, []
    for row in sorted(counts, key=lambda r: r["_task"]):
        starts.append((row["_task"], before))
        before += row["n"]
    offsets = F.broadcast(spark.createDataFrame(starts, "_task long, _before long"))
    place = F.col("_before") + F.col("_row").bitwiseAND(mask) + 1
    return stored.withColumn("_task", task).join(offsets, "_task").withColumn("place", place).drop(
        "_task", "_before", "_row"
    )


def apportion(classes: DataFrame, wanted: int) -> DataFrame:
    """``classes`` (label, n) with ``wanted``: its share of the rows to take, by largest remainder.

    At a tie of remainders the smaller labels are first.  Products are decimals,
    so that no size of a table overflows.
    """
    total = classes.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not total:
        return classes.withColumn("wanted", F.lit(0).cast("long"))
    product = f"(CAST({wanted} AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)))"
    shared = classes.withColumn("whole", F.expr(f"{product} DIV {total}").cast("long")).withColumn(
        "rest", F.expr(f"{product} % {total}").cast("long")
    )
    placed = numbered_in_order(shared, F.desc("rest"), F.asc("label"))
    missing = wanted - placed.agg(F.sum("whole").alias("n")).first()["n"]
    more = F.when(F.col("place") <= missing, 1).otherwise(0)
    return placed.select("label", "n", (F.col("whole") + more).alias("wanted"))


def _reached(counts: DataFrame, bucket: str) -> DataFrame:
    """Per label the bucket in which the ``rest``-th row lies, and how many rows are still to take there."""
    below = F.sum("n").over(Window.partitionBy("label").orderBy(bucket)) - F.col("n")
    found = counts.withColumn("_below", below).filter("_below < rest AND rest <= _below + n")
    return found.withColumn("rest", F.col("rest") - F.col("_below")).drop("_below")


def _limits(hashed: DataFrame, classes: DataFrame, most_ranked: int) -> DataFrame:
    """(label, bound, rest, n): the hash of each class's last row, and how many rows of that hash to take."""
    spark = hashed.sparkSession
    partly = classes.filter("wanted > 0 AND wanted < n")
    state = hand_over(
        partly.select("label", F.lit("").alias("prefix"), F.col("wanted").alias("rest"), "n"), "cuts"
    ).read(spark)

    def inside(cuts: DataFrame) -> DataFrame:
        return hashed.join(cuts.drop("n"), "label").filter(F.startswith("hash", F.col("prefix")))

    for digits in range(0, HASH_DIGITS - BUCKET_DIGITS, BUCKET_DIGITS):
        large = state.filter(F.col("n") > most_ranked)
        if not large.take(1):
            break
        bucket = F.substring("hash", digits + 1, BUCKET_DIGITS).alias("bucket")
        counts = inside(large).groupBy("label", "prefix", "rest", bucket).agg(F.count("*").alias("n"))
        divided = _reached(counts, "bucket").select(
            "label", F.concat("prefix", "bucket").alias("prefix"), "rest", "n"
        )
        state = hand_over(state.filter(F.col("n") <= most_ranked).unionByName(divided), "cuts").read(spark)
    by_hash = inside(state).groupBy("label", "rest", "hash").agg(F.count("*").alias("n"))
    cut = _reached(by_hash, "hash").select("label", F.col("hash").alias("bound"), "rest", "n")
    whole = classes.filter("wanted >= n").select(
        "label", F.lit(_ALL).alias("bound"), F.lit(0).cast("long").alias("rest"), F.lit(0).cast("long").alias("n")
    )
    return hand_over(cut.unionByName(whole), "limits").read(spark)


def split_by_strata(
    df: DataFrame, label: str, test_size: float, key: Sequence[str], seed: int = 42, most_ranked: int = 1_000_000
) -> DataFrame:
    """Add ``in_test``: ``ceil(test_size * rows)`` rows, in proportion per label, the first by hash.

    A class of more than ``most_ranked`` rows is narrowed by counts per hash
    prefix until one bucket of it is small enough to be put in order; a class that
    owns most rows is left to the run-time splitting of skewed joins.  A null
    label is an error.  Rows of equal keys at a cut go by a hash of all columns.
    """
    spark = df.sparkSession
    hashed = df.select(F.col(label).alias("label"), row_hash(seed, key).alias("hash"))
    classes = hand_over(hashed.groupBy("label").agg(F.count("*").alias("n")), "classes").read(spark)
    lost = classes.filter("label IS NULL").take(1)
    if lost:
        raise ValueError(f"{lost[0]['n']} rows have no {label}; a split by label needs one in every row")
    total = classes.agg(F.sum("n").alias("n")).first()["n"] or 0
    sized = hand_over(apportion(classes, math.ceil(test_size * total)), "strata").read(spark)
    limits = _limits(hashed, sized, most_ranked).withColumnsRenamed(
        {"label": "_label", "bound": "_bound", "rest": "_rest", "n": "_n"}
    )
    joined = df.withColumn("_hash", row_hash(seed, key)).join(limits, F.col(label) == F.col("_label"), "left")
    helpers = ("_hash", "_label", "_bound", "_rest", "_n")
    taken = F.coalesce(F.col("_hash") <= F.col("_bound"), F.lit(False))
    if not limits.filter("_rest < _n").take(1):
        return joined.withColumn("in_test", taken).drop(*helpers)
    tied = F.coalesce((F.col("_hash") == F.col("_bound")) & (F.col("_rest") < F.col("_n")), F.lit(False))
    ties = joined.filter(tied).withColumn("_row", row_hash(seed, df.columns))
    place = F.row_number().over(Window.partitionBy("_label").orderBy("_row"))
    ranked = ties.withColumn("in_test", place <= F.col("_rest")).drop("_row")
    return joined.filter(~tied).withColumn("in_test", taken).unionByName(ranked).drop(*helpers)
