"""Exact statistics over whole columns, without sorting them in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rebasket.session import hand_over

# Error bound of the sketch that brackets a median, and the bracket around it:
# twice the bound on either side, so that the true median normally lies inside.
_ACCURACY = 10_000
_MARGIN = 2 / _ACCURACY
MAX_ORDERED = 100_000  # rows of a bracket that one task puts in order


def class_count(df: DataFrame, label: str) -> DataFrame:
    """The number of distinct labels, nulls ignored."""
    return df.agg(F.countDistinct(label).alias("classes"))


def _counted(values: DataFrame) -> DataFrame:
    """(column, value, n) over all columns of a table, nulls left out."""
    long = values.unpivot([], values.columns, "column", "value")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.filter(F.col("value").isNotNull())


@dataclass
class _Bracket:
    """Where a median is sought: values from ``low`` to ``high``, ``below`` rows under them."""

    rows: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    margin: float = _MARGIN
    few: int = MAX_ORDERED

    @property
    def ranks(self) -> tuple[int, int]:
        """The middle rows, from 0; the same row twice for an odd count."""
        return (self.rows - 1) // 2, self.rows // 2

    @property
    def closed(self) -> bool:
        return self.low == self.high or self.inside <= self.few

    def shares(self) -> tuple[float, float]:
        """Where the middle rows lie inside the bracket, with the margin, as shares of it."""
        first, last = ((r - self.below) / max(self.inside - 1, 1) for r in self.ranks)
        return max(first - self.margin, 0.0), min(last + self.margin, 1.0)


def medians(df: DataFrame, columns: Sequence[str], max_ordered: int = MAX_ORDERED) -> DataFrame:
    """The exact median per numeric column: (column, median), nulls and NaN ignored.

    A mergeable sketch brackets each median; plain counts tell how many rows lie
    below and inside.  The bracket is narrowed in the same way, all columns in one
    pass, until ``max_ordered`` rows are left inside, which alone are put in order.  A
    bracket that the sketch has missed is widened.  Columns without numbers have
    no row.
    """

    def number(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    clean = df.select([number(c).alias(f"c{k}") for k, c in enumerate(columns)])
    names = clean.columns
    facts = [f(n).alias(f"{n}_{m}") for n in names for m, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    first = clean.agg(*facts).first() if names else {}
    found = {
        n: _Bracket(first[f"{n}_n"], first[f"{n}_lo"], first[f"{n}_hi"], 0, first[f"{n}_n"], few=max_ordered)
        for n in names
        if first[f"{n}_n"]
    }

    def inside(name: str, low: float, high: float) -> Column:
        return F.when(F.col(name).between(low, high), F.col(name))

    while open_ := {n: b for n, b in found.items() if not b.closed}:
        cuts = clean.agg(
            *[
                F.percentile_approx(inside(n, b.low, b.high), F.array(*map(F.lit, b.shares())), F.lit(_ACCURACY)).alias(n)
                for n, b in open_.items()
            ]
        ).first()
        counts = clean.agg(
            *[F.count(F.when(F.col(n) < cuts[n][0], 1)).alias(f"{n}_below") for n in open_],
            *[F.count(inside(n, *cuts[n])).alias(f"{n}_inside") for n in open_],
        ).first()
        for n, b in open_.items():
            below, within = counts[f"{n}_below"], counts[f"{n}_inside"]
            if below <= b.ranks[0] and b.ranks[1] < below + within and within < b.inside:
                b.low, b.high, b.below, b.inside, b.margin = *cuts[n], below, within, _MARGIN
            elif b.margin < 1:
                b.margin *= 8  # the sketch missed the middle
            else:
                break
        else:
            continue
        break  # a bracket of few distinct values does not get narrower
    kept = clean.select([inside(n, b.low, b.high).alias(n) for n, b in found.items()]) if found else clean.limit(0)
    column = Window.partitionBy("column")
    reached = F.sum("n").over(column.orderBy("value"))
    ranked = _counted(kept).withColumn("reached", reached) if found else None
    results = []
    if ranked is not None:
        bounds = df.sparkSession.createDataFrame(
            [(n, b.below, *b.ranks) for n, b in found.items()], "column string, below long, low_rank long, high_rank long"
        )
        rank = F.col("reached") + F.col("below")
        middle = ranked.join(F.broadcast(bounds), "column").filter(
            (rank > F.col("low_rank")) & (rank - F.col("n") <= F.col("high_rank"))
        )
        for r in middle.groupBy("column").agg(((F.min("value") + F.max("value")) / 2).alias("median")).collect():
            results.append((columns[int(r["column"][1:])], r["median"]))
    return df.sparkSession.createDataFrame(results, "column string, median double")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The most frequent value per numeric column: (column, mode).

    Modes are longs if all columns are whole-number columns, doubles otherwise;
    no value is rounded.  At a tie the smaller value wins; nulls and NaN are
    ignored.
    """
    whole = all(isinstance(df.schema[c].dataType, IntegralType) for c in columns)

    def number(name: str) -> Column:
        if whole:
            return F.col(name).cast("long")
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    counts = _counted(df.select([number(c).alias(c) for c in columns]))
    return counts.groupBy("column").agg(
        F.max_by("value", F.struct("n", -F.col("value"))).alias("mode")
    )


def text_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Like ``modes`` for text columns; at a tie the first in byte order wins."""
    counts = _counted(df.select([F.col(c).cast("string").alias(c) for c in columns]))
    top = counts.groupBy("column").agg(F.max("n").alias("n"))
    return (
        counts.join(top, ["column", "n"]).groupBy("column").agg(F.min("value").alias("mode"))
    )


def accuracy(predictions: DataFrame, prediction: str, actual: str) -> DataFrame:
    """The share of rows whose prediction equals the actual label."""
    hit = (F.col(prediction) == F.col(actual)).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))


_CELLS = 2000


def roc_auc(scored: DataFrame, score: str, actual: str) -> DataFrame:
    """The exact area under the ROC curve, a tie counting half: one row, ``roc_auc``.

    The area is the share of (positive, negative) pairs in the right order.
    Rows are first counted per score.  Quantiles of these distinct scores cut
    them into cells of about equal size, whatever their scale; for every score,
    the negatives below it are those in lower cells plus those lower in its cell.
    So a window covers one cell, or one row per cell.  Rows whose score or label
    is null, or whose score is NaN, are left out.  Null if only one class is
    present.
    """
    value, label = F.col(score).cast("double"), F.col(actual)
    by_score = (
        scored.select(value.alias("s"), label.alias("y"))
        .filter(F.col("s").isNotNull() & ~F.isnan("s") & F.col("y").isNotNull())
        .groupBy("s")
        .agg(
            F.count(F.when(F.col("y") == 1, 1)).alias("p"),
            F.count(F.when(F.col("y") != 1, 1)).alias("q"),
        )
    )
    by_score = hand_over(by_score, "scores").read(scored.sparkSession)
    shares = F.array(*[F.lit(k / _CELLS) for k in range(1, _CELLS)])
    found = by_score.agg(F.percentile_approx("s", shares, F.lit(20 * _CELLS)).alias("cuts")).first()["cuts"]
    borders = sorted({c for c in found or [] if math.isfinite(c)})
    cells = Bucketizer(splits=[-math.inf, *borders, math.inf], inputCol="s", outputCol="cell")
    by_score = cells.transform(by_score) if borders else by_score.withColumn("cell", F.lit(0.0))
    by_cell = by_score.groupBy("cell").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))

    def ordered_pairs(counts: DataFrame, group: list[str], order: str, ties: float) -> DataFrame:
        lower = Window.partitionBy(*group).orderBy(order)
        below = F.sum("q").over(lower) - F.col("q")
        pairs = F.col("p") * (below + ties * F.col("q"))
        return counts.select(pairs.alias("pairs"), "p", "q").agg(
            F.sum("pairs").alias("pairs"), F.sum("p").alias("p"), F.sum("q").alias("q")
        )

    levels = [ordered_pairs(by_score, ["cell"], "s", 0.5), ordered_pairs(by_cell, [], "cell", 0.0)]
    total = reduce(DataFrame.unionAll, levels).agg(
        F.sum("pairs").alias("pairs"), F.max("p").alias("p"), F.max("q").alias("q")
    )
    all_pairs = F.col("p").cast("double") * F.col("q")
    return total.select(F.when(all_pairs > 0, F.col("pairs") / all_pairs).alias("roc_auc"))
