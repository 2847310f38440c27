"""Repeatable row caps and stratified splits with exact sizes.

Rows are put in random order by a hash of their key.  Ranking all rows would
sort a whole class in one task, so the rank is never computed.  Counts per hash
bucket tell in which bucket the wanted number of rows is reached; a large bucket
is divided in the same way.  Only the rows of the last bucket are ranked, which
gives the hash of the last row to take.  What remains is a comparison with that
hash: the table itself is not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.functions.hashing import row_hash
from rebasket.operators.strata import split_by_strata

MAX_CLASSES = 1000  # more classes are split by joined tables
BUCKET_DIGITS = 3  # 4,096 buckets per class and step
HASH_DIGITS = 32
MAX_RANKED = 1_000_000  # a bucket with more rows is divided again
_NONE, _ALL = "", "~"  # below and above every hex digit


class _ManyClasses(Exception):
    """More classes than an expression should list."""


def stratum_sizes(sizes: dict, total_wanted: int) -> dict:
    """Share ``total_wanted`` over the classes in proportion to their size.

    Each class gets the whole part of its share; what is left goes to the
    largest remainders, at a tie to the smaller label.
    """
    total = sum(sizes.values())
    shares = {label: divmod(total_wanted * n, total) for label, n in sizes.items()}
    wanted = {label: whole for label, (whole, _) in shares.items()}
    missing = total_wanted - sum(wanted.values())
    for label in sorted(shares, key=lambda c: (-shares[c][1], c))[:missing]:
        wanted[label] += 1
    return wanted


def _per_class(values: dict, default) -> Column:
    choice = None
    for label, value in values.items():
        same = F.col("_class") == F.lit(label)
        choice = F.when(same, value) if choice is None else choice.when(same, value)
    return F.lit(default) if choice is None else choice.otherwise(default)


def _bucket_reached(buckets: DataFrame, wanted: dict) -> dict:
    """Per class, the bucket that holds the ``wanted``-th row, as (bucket, rows, offset)."""
    reached = F.sum("n").over(Window.partitionBy("_class").orderBy("_bucket"))
    rows = (
        buckets.withColumn("_reached", reached)
        .withColumn("_wanted", _per_class(wanted, 0))
        .filter(F.col("_wanted").between(F.col("_reached") - F.col("n") + 1, F.col("_reached")))
        .collect()  # one row per class
    )
    return {
        row["_class"]: (row["_bucket"], row["n"], row["_wanted"] - row["_reached"] + row["n"])
        for row in rows
    }


def _last_hashes(hashed: DataFrame, buckets: DataFrame, wanted: dict) -> dict:
    """Per class, the hash of the ``wanted``-th row, and how many of its rows to take (None: all)."""
    found, prefix, digits = _bucket_reached(buckets, wanted), dict.fromkeys(wanted, ""), 0
    while True:
        digits += BUCKET_DIGITS
        prefix = {c: prefix[c] + bucket for c, (bucket, _, _) in found.items()}
        offset = {c: rest for c, (_, _, rest) in found.items()}
        inside = hashed.filter(F.substring("_hash", 1, digits) == _per_class(prefix, _NONE))
        largest = max(rows for _, rows, _ in found.values())
        if largest <= MAX_RANKED or digits >= HASH_DIGITS:
            break
        next_digits = F.substring("_hash", digits + 1, BUCKET_DIGITS).alias("_bucket")
        found = _bucket_reached(_count_buckets(inside, next_digits), offset)
    by_hash = inside.groupBy("_class", "_hash").agg(F.count("*").alias("n"))
    return {
        label: (value, rest if rest != rows else None)
        for label, (value, rows, rest) in _bucket_reached(
            by_hash.withColumnRenamed("_hash", "_bucket"), offset
        ).items()
    }


def _count_buckets(hashed: DataFrame, bucket: Column) -> DataFrame:
    return hashed.groupBy("_class", bucket).agg(F.count("*").alias("n"))


def _take_per_class(
    df: DataFrame, group: Column, key: Sequence[str], seed: int, choose
) -> DataFrame:
    """``df`` with ``_taken``: whether the row is among those ``choose`` wants per class.

    Rows of equal keys at the cut are ordered by a hash of all their columns, and
    rows alike in all columns are exchangeable: the needed number is taken.
    """
    hashed = df.select(group.alias("_class"), row_hash(seed, key).alias("_hash"))
    first_digits = F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket")
    buckets = _count_buckets(hashed, first_digits).persist()
    try:
        totals = buckets.groupBy("_class").agg(F.sum("n").alias("n")).take(MAX_CLASSES + 1)
        if len(totals) > MAX_CLASSES:
            raise _ManyClasses
        sizes = {row["_class"]: row["n"] for row in totals}
        wanted = choose(sizes)
        partly = {c: n for c, n in wanted.items() if 0 < n < sizes[c]}
        last = {c: (_ALL, None) for c, n in wanted.items() if n >= sizes[c]}
        if partly:
            last.update(_last_hashes(hashed, buckets, partly))
    finally:
        buckets.unpersist()
    bound, tied, most = F.lit(_NONE), F.lit(False), F.lit(0)
    own = row_hash(seed, key)
    for label, (value, rest) in last.items():
        same = group == F.lit(label)
        bound = F.when(same, value).otherwise(bound)
        if rest is not None:
            at_cut = same & (own == value)
            tied, most = tied | at_cut, F.when(same, rest).otherwise(most)
    taken = df.withColumn("_taken", own <= bound)
    if not any(rest is not None for _, rest in last.values()):
        return taken
    # Only rows that share the hash at the cut are ranked.
    ties = df.filter(tied).withColumns({"_group": group, "_row": row_hash(seed, df.columns)})
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_row"))
    ranked = ties.withColumn("_taken", rank <= most).drop("_group", "_row")
    return taken.filter(~tied).unionByName(ranked)


def cap_rows(df: DataFrame, max_rows: int | None, key: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``max_rows`` rows that come first in hash order; all if there are fewer."""
    if max_rows is None:
        return df

    def choose(sizes: dict) -> dict:
        return {c: min(max_rows, n) for c, n in sizes.items()}

    return _take_per_class(df, F.lit(0), key, seed, choose).filter("_taken").drop("_taken")


def stratified_split(
    df: DataFrame, label: str, test_size: float, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Add ``in_test``: ``ceil(test_size * rows)`` rows, in proportion per label."""

    def choose(sizes: dict) -> dict:
        if None in sizes:
            raise ValueError(f"{sizes[None]} rows have no {label}; a split by label needs one in every row")
        total = sum(sizes.values())
        return stratum_sizes(sizes, math.ceil(test_size * total)) if total else {}

    try:
        split = _take_per_class(df, F.col(label), key, seed, choose)
    except _ManyClasses:
        return split_by_strata(df, label, test_size, key, seed, MAX_RANKED)
    return split.withColumnRenamed("_taken", "in_test")
