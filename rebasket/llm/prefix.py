"""Running sums and gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
"""Parts of a group that are numbered side by side."""


def with_offset(
    df: DataFrame, group: str, size: Column, order: list[str], name: str, buckets: int = BUCKETS
) -> DataFrame:
    """``df`` with the sum of ``size`` over the rows before it in its group, as long.

    Rows of a group are ordered by a hash bucket of ``order`` and then by
    ``order``, so no task holds a whole group: sums per (group, bucket) are added
    up first, then the rows of each bucket.  ``order`` should tell rows apart;
    rows that it does not are exchangeable.  A null group is a group of its own.
    """
    bucketed = df.withColumns(
        {
            "_bucket": F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)).cast("int"),
            "_weight": size.cast("long"),
        }
    )
    sums = bucketed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_of")).agg(
        F.sum("_weight").alias("_sum")
    )
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = (
        Window.partitionBy(group, "_bucket")
        .orderBy(*[F.col(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.join(
            starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_of"))
        )
        .withColumn(name, F.col("_start") + F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
        .drop("_bucket", "_weight", "_group", "_of", "_start")
    )
