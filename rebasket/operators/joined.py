"""Order lines joined to their order and product, one row per order and product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebasket.operators.skew import find_hot_keys, join_unique


def union_lines(prior: DataFrame, train: DataFrame) -> DataFrame:
    """All rows of both tables; a column only one side has is null on the other."""
    return prior.unionByName(train, allowMissingColumns=True)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by the remaining columns.

    Comparing the rank directly lets Spark keep the first row of each key in
    every map task, so a key with very many copies is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*(*order, *rest) or key))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def join_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their order; rows without a partner on either side are dropped."""
    return lines.join(orders, "order_id")


def join_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their product; an unknown product leaves nulls."""
    return lines.join(products, "product_id", "left")


def default_days(df: DataFrame) -> DataFrame:
    """A customer's first order has no gap: count it as zero days."""
    return df.withColumn("days_since_prior_order", F.coalesce("days_since_prior_order", F.lit(0.0)))


def build_joined(
    orders: DataFrame,
    prior: DataFrame,
    train: DataFrame,
    products: DataFrame,
    hot_rows: int | None = None,
) -> DataFrame:
    """The joined table, one row per (order_id, product_id).

    Of several rows for one key the first wins by source (prior before train),
    cart position, and all other columns.  The joined rows of a key are all
    combinations of its lines, orders and products, so the first combination is
    made of the first of each.  Hence every side is reduced before it is joined:
    narrow rows are deduplicated, and repeated dimension rows never multiply.

    Without a hot order the lines are shuffled by order once, which serves both
    the deduplication and the join.  With one, they are deduplicated by order
    and product, and the rows of hot orders and products are salted.  ``hot_rows``
    sets from how many rows on a key is hot.
    """
    by_order, by_product = ["order_id"], ["product_id"]
    lines = union_lines(
        prior.withColumn("_source", F.lit(0)), train.withColumn("_source", F.lit(1))
    )
    # A line without order joins nothing; many of them are no hot key.
    lines = lines.filter(F.col("order_id").isNotNull())
    hot = find_hot_keys(lines, by_order, by_product, min_rows=hot_rows)
    if not hot.of(by_order):
        lines = lines.repartition("order_id")
    position = [c for c in ("_source", "add_to_cart_order") if c in lines.columns]
    lines = first_per_key(lines, by_order + by_product, position).drop("_source")
    ordered = join_unique(lines, first_per_key(orders, by_order), by_order, "inner", hot)
    joined = join_unique(ordered, first_per_key(products, by_product), by_product, "left", hot)
    return default_days(joined)
