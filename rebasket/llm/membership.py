"""A set filter of bounded size that tasks apply before anything is shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 26
"""8 MB at most; beyond, more rows pass than needed and the join sorts them out."""


class Membership:
    """May say yes for a hash outside the set, never no for one inside."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.words) * 64 - 1)
        found = np.ones(len(hashes), bool)
        for at in (hashes & mask, (hashes >> np.uint64(33)) & mask):
            word = self.words[(at >> np.uint64(6)).astype(np.int64)]
            found &= ((word >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return found


def membership(hashes: DataFrame, rows: int) -> Membership:
    """A filter for the evenly spread long column ``hash`` of about ``rows`` rows."""
    bits = 1 << 12
    while bits < min(16 * rows, MOST_BITS):
        bits *= 2
    places = F.array(
        F.col("hash").bitwiseAND(bits - 1), F.shiftrightunsigned("hash", 33).bitwiseAND(bits - 1)
    )
    one = F.expr("shiftleft(1L, cast(at & 63L as int))")
    words = (
        hashes.select(F.explode(places).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(one).alias("mask"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy().astype(np.int64)] = words["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return Membership(out)


def holds(df: DataFrame, found: Membership, hashed: Column) -> DataFrame:
    """The rows of ``df`` whose long ``hashed`` may be in the set."""
    sent = df.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf("boolean")
    def inside(hashes: pd.Series) -> pd.Series:
        return pd.Series(sent.value.holds(hashes.to_numpy(np.int64).view(np.uint64)))

    return df.filter(inside(hashed))
