"""Joins to a table of unique keys when one key may own a large share of the rows.

Spark splits a skewed join partition at run time only if the join reads both
sides straight from a shuffle.  A side that was just grouped by the join key has
no shuffle of its own there, and that is how features are joined back.  So hot
keys are found first and only they are salted: their rows are spread over
partitions in proportion to their number, and their single partner row is copied
to each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000  # rows of one key that one task copes with
MOST_HOT = 10_000  # hot keys that are told apart; each owns over HOT_ROWS rows
TRACKED_KEYS = 100_000  # counters of the sketch; its error is rows / TRACKED_KEYS at most
MOST_COPIES = 1 << 16


@dataclass(frozen=True)
class HotKeys:
    """Copies of the hot keys' partner rows by the hash of the key, per tuple of key columns."""

    copies: dict[tuple[str, ...], dict[int, int]]

    def of(self, key: Sequence[str]) -> dict[int, int]:
        return self.copies[tuple(key)]


def copies_for(rows: int, least: int) -> int:
    """A power of two, so that no copy gets many more than ``least`` rows."""
    return min(1 << max((-(-rows // max(least, 1)) - 1).bit_length(), 1), MOST_COPIES)


def find_hot_keys(df: DataFrame, *keys: Sequence[str], min_rows: int | None = None) -> HotKeys:
    """The keys of more rows than one task copes with, from one pass with a bounded sketch.

    Nulls count as a key of their own: an outer join keeps their rows, too.  The
    bound is a number of rows, whatever the size of the table; a key that the
    sketch reports needlessly costs a few copies of one row.
    """
    least = HOT_ROWS if min_rows is None else min_rows
    names = [f"_key_{i}" for i in range(len(keys))]
    hashed = df.select([F.xxhash64(*key).alias(name) for key, name in zip(keys, names)])
    sketches = [F.expr(f"approx_top_k({name}, {MOST_HOT}, {TRACKED_KEYS})").alias(name) for name in names]
    row = hashed.agg(*sketches).first()
    return HotKeys(
        {
            tuple(key): {
                top["item"]: copies_for(top["count"], least) for top in row[name] or [] if top["count"] >= least
            }
            for key, name in zip(keys, names)
        }
    )


def _copies(hashed: Column, hot: dict[int, int]) -> Column:
    """How many copies the key of this hash has; null for a key that is not hot."""
    found = F.lit(None).cast("int")
    for number in sorted(set(hot.values())):  # powers of two: a few branches
        found = F.when(hashed.isin([h for h, c in hot.items() if c == number]), number).otherwise(found)
    return found


def join_unique(
    facts: DataFrame, dimension: DataFrame, key: Sequence[str], how: str, hot: HotKeys
) -> DataFrame:
    """Join ``facts`` to a dimension with one row per key, the hot keys salted."""
    copies, key = hot.of(key), list(key)
    if not copies:
        return facts.join(dimension, key, how)
    rest = [c for c in facts.columns if c not in key] or key
    of_fact = _copies(F.xxhash64(*[F.col(c) for c in key]), copies)
    spread = F.pmod(F.xxhash64(*rest), of_fact).cast("int")
    salted = facts.withColumn("_salt", F.coalesce(spread, F.lit(0)))
    # The same key hashes alike only in the same type.
    same_type = [F.col(c).cast(facts.schema[c].dataType) for c in key]
    of_row = _copies(F.xxhash64(*same_type), copies)
    salts = F.when(of_row.isNotNull(), F.sequence(F.lit(0), of_row - 1))
    copied = dimension.withColumn(
        "_salt", F.explode(F.coalesce(salts, F.array(F.lit(0))))
    )
    return salted.join(copied, [*key, "_salt"], how).drop("_salt")
