"""Customer and product features kept up to date as orders arrive.

The features are means and counts, so their sums can be kept: per customer the
number of orders, lines and the days summed up, per product the lines and the
reorders.  An update reads the sums and the new lines, not the lines of before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.config import FeatureConfig
from rebasket.operators.features import assemble_features, hot_behaviour_keys
from rebasket.sources.files import create_new, names_in
from rebasket.sources.tables import MissingTable, read_table


def user_sums(joined: DataFrame) -> DataFrame:
    """Per customer: distinct orders, lines with a gap, and the sum of the gaps."""
    return joined.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.count("days_since_prior_order").alias("lines"),
        F.sum("days_since_prior_order").alias("days"),
    )


def product_sums(joined: DataFrame) -> DataFrame:
    """Per product: lines, lines with a label, and the sum of the labels."""
    return joined.groupBy("product_id").agg(
        F.count("*").alias("rows"),
        F.count("reordered").alias("lines"),
        F.sum("reordered").cast("long").alias("reorders"),
    )


def _added(kept: DataFrame, new: DataFrame, key: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in kept.columns if c != key]
    return kept.unionByName(new).groupBy(key).agg(*sums)


def user_features_of(sums: DataFrame) -> DataFrame:
    mean = F.col("days") / F.nullif(F.col("lines"), F.lit(0))
    return sums.select(
        "user_id", F.col("orders").alias("user_order_count"), mean.alias("user_avg_days_between_orders")
    )


def product_features_of(sums: DataFrame) -> DataFrame:
    rate = F.col("reorders") / F.nullif(F.col("lines"), F.lit(0))
    return sums.select("product_id", F.col("rows").alias("product_order_count"), rate.alias("product_reorder_rate"))


@dataclass(frozen=True)
class Behaviour:
    """The sums below ``root``, a folder per update; a marker makes an update count."""

    root: str

    def updates(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in names_in(spark, f"{self.root}/done"))

    def _table(self, name: str, update: int) -> str:
        return f"{self.root}/{name}/update-{update}"

    def _sums(self, spark: SparkSession, name: str) -> DataFrame:
        done = self.updates(spark)
        if not done:
            raise MissingTable(f"no update below {self.root}")
        return read_table(spark, self._table(name, done[-1]))

    def user_features(self, spark: SparkSession) -> DataFrame:
        return user_features_of(self._sums(spark, "users"))

    def product_features(self, spark: SparkSession) -> DataFrame:
        return product_features_of(self._sums(spark, "products"))

    def features(self, joined: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
        """The feature table of some joined lines with the features as of the last update."""
        spark = joined.sparkSession
        users, products = self.user_features(spark), self.product_features(spark)
        return assemble_features(joined, users, products, hot_behaviour_keys(joined), config)

    def update(self, joined: DataFrame) -> int:
        """Adds the joined lines of new orders and returns the number of the update.

        A batch holds whole orders.  Orders of an earlier update are left out, so
        a batch that comes again changes nothing.  An update that stops half-way
        leaves no marker and is written over by the next one; of two updates at
        the same time one fails before it counts.
        """
        spark, done = joined.sparkSession, self.updates(joined.sparkSession)
        number = done[-1] + 1 if done else 1
        new = joined
        if done:
            seen = spark.read.parquet(*[self._table("orders", k) for k in done]).select("order_id")
            new = joined.join(seen, "order_id", "left_anti")
        new.select("order_id").distinct().write.mode("overwrite").parquet(self._table("orders", number))
        for name, key, sums in (("users", "user_id", user_sums), ("products", "product_id", product_sums)):
            added = sums(new)
            if done:
                added = _added(read_table(spark, self._table(name, done[-1])), added, key)
            added.write.mode("overwrite").parquet(self._table(name, number))
        if not create_new(spark, f"{self.root}/done/update-{number}"):
            raise RuntimeError(f"another job has made update {number} below {self.root}")
        return number
