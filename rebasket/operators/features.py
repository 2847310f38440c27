"""Behaviour features per customer and product, joined back to the lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.config import FeatureConfig
from rebasket.operators.skew import HotKeys, find_hot_keys, join_unique


def user_features(joined: DataFrame) -> DataFrame:
    """Distinct orders per customer, and the mean gap over their lines.

    The mean runs over lines, so large baskets weigh more.  Spark counts the
    distinct orders in two steps, the first keyed by (customer, order), which
    spreads a customer with very many orders.
    """
    return joined.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("user_order_count"),
        F.avg("days_since_prior_order").alias("user_avg_days_between_orders"),
    )


def product_features(joined: DataFrame) -> DataFrame:
    """Lines per product and the share of them that were reorders."""
    return joined.groupBy("product_id").agg(
        F.count("*").alias("product_order_count"),
        F.avg("reordered").alias("product_reorder_rate"),
    )


def hot_behaviour_keys(joined: DataFrame, hot_rows: int | None = None) -> HotKeys:
    """Customers and products that own a large share of the lines."""
    return find_hot_keys(joined, ["user_id"], ["product_id"], min_rows=hot_rows)


def with_user_features(joined: DataFrame, users: DataFrame, hot: HotKeys) -> DataFrame:
    return join_unique(joined, users, ["user_id"], "left", hot)


def with_product_features(joined: DataFrame, products: DataFrame, hot: HotKeys) -> DataFrame:
    return join_unique(joined, products, ["product_id"], "left", hot)


def fill_numeric(df: DataFrame) -> DataFrame:
    """Nulls and NaN in every numeric column become zero; other types stay."""
    return df.fillna(0)


def project_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns in that order; names the table lacks are left out."""
    return df.select([c for c in wanted if c in df.columns])


def assemble_features(
    joined: DataFrame, users: DataFrame, products: DataFrame, hot: HotKeys, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """The feature table out of the lines and the features of customers and products."""
    wide = with_user_features(joined, users, hot)
    wide = with_product_features(wide, products, hot)
    return project_present(fill_numeric(wide), config.output_columns)


def build_features(
    joined: DataFrame, config: FeatureConfig = FeatureConfig(), hot_rows: int | None = None
) -> DataFrame:
    """The feature table.

    ``joined`` is read several times, but only once for more than three columns,
    so it should be a stored table.  The reorder rate includes the row's own label and
    both order sets: that is the definition, and it makes the rate optimistic.
    """
    hot = hot_behaviour_keys(joined, hot_rows)
    return assemble_features(joined, user_features(joined), product_features(joined), hot, config)
