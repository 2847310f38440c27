"""Purchase-history tables derived from a sales star schema.

Orders, line items and parts of the star carry no basket history, so order
numbers, gaps between orders and repeat purchases are derived here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rebasket.operators.skew import find_hot_keys
from rebasket.session import Handover, hand_over, spread_rows

MOST_ORDERS = 20_000  # of one customer whose lines of an aisle one task orders
MOST_LINES = 10_000  # of one order of such a customer

# Part types of the star, numbered in alphabetical order.
DEPARTMENTS = {
    "ECONOMY": 1,
    "LARGE": 2,
    "MEDIUM": 3,
    "PROMO": 4,
    "SMALL": 5,
    "STANDARD": 6,
}


def star_orders(raw: DataFrame) -> DataFrame:
    """Orders with their number, weekday, hour and gap per customer.

    The position of an order in its customer's history is built in two levels,
    so a customer with a large share of all orders is spread over the days they
    ordered on: orders are counted per (customer, day), the running total goes
    over that short calendar, and only orders of one day are ranked together.
    """
    placed = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("placed"),
        F.to_date("o_orderdate").alias("day"),
    )
    history = Window.partitionBy("user_id").orderBy("day")
    calendar = (
        placed.groupBy("user_id", "day")
        .agg(F.count("*").alias("that_day"))
        .select(
            "user_id",
            "day",
            "that_day",
            (F.sum("that_day").over(history) - F.col("that_day")).alias("before"),
            F.lag("day").over(history).alias("previous_day"),
            F.lead("day").over(history).isNull().alias("final_day"),
        )
    )
    within_day = Window.partitionBy("user_id", "day").orderBy("placed", "order_id")
    ranked = placed.withColumn("rank", F.row_number().over(within_day))
    last = F.col("final_day") & (F.col("rank") == F.col("that_day"))
    gap = F.when(F.col("rank") > 1, F.lit(0)).otherwise(F.datediff("day", "previous_day"))
    return ranked.join(calendar, ["user_id", "day"]).select(
        "order_id",
        "user_id",
        F.when(last, "train").otherwise("prior").alias("eval_set"),
        (F.col("before") + F.col("rank")).cast("int").alias("order_number"),
        (F.dayofweek("day") - 1).alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def star_products(part: DataFrame) -> DataFrame:
    numbers = F.create_map(*[F.lit(x) for pair in DEPARTMENTS.items() for x in pair])
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.substring("p_brand", 7, 10).cast("int").alias("aisle_id"),
        numbers[F.col("p_type")].alias("department_id"),
    )


def star_aisles(part: DataFrame) -> DataFrame:
    return part.select(
        F.substring("p_brand", 7, 10).cast("int").alias("aisle_id"),
        F.col("p_brand").alias("aisle"),
    ).distinct()


def star_departments(part: DataFrame) -> DataFrame:
    numbers = F.create_map(*[F.lit(x) for pair in DEPARTMENTS.items() for x in pair])
    return part.select(
        numbers[F.col("p_type")].alias("department_id"),
        F.col("p_type").alias("department"),
    ).distinct()


def bought_lines(lineitem: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the customer, order number and aisle they belong to."""
    return (
        lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("add_to_cart_order"),
        )
        .join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
        .join(products.select("product_id", "aisle_id"), "product_id")
    )


def first_purchases(lines: DataFrame) -> DataFrame:
    """The number of the order in which a customer first bought from an aisle.

    A partial aggregate, not a window: a window would sort all lines of a heavy
    customer in one task.
    """
    return lines.groupBy("user_id", "aisle_id").agg(F.min("order_number").alias("first_number"))


def star_lines(lines: DataFrame, first: DataFrame) -> DataFrame:
    """Order lines; ``reordered`` is 1 when the customer bought from that aisle before.

    ``first`` should be a stored table: read straight from storage, the join can
    split the partition of a heavy customer at run time.
    """
    return lines.join(first, ["user_id", "aisle_id"]).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("first_number") < F.col("order_number")).cast("int").alias("reordered"),
        "eval_set",
    )


@dataclass(frozen=True)
class StagedTables:
    """The derived tables, written once and read with pruning by every query."""

    spark: SparkSession
    tables: dict[str, Handover]

    def __getitem__(self, name: str) -> DataFrame:
        if name in ("prior", "train"):
            lines = self.tables["lines"].read(self.spark)
            return lines.filter(F.col("eval_set") == name).drop("eval_set")
        return self.tables[name].read(self.spark)


def star_lines_at_once(lines: DataFrame) -> DataFrame:
    """``star_lines`` by a window, which shuffles the lines once instead of twice and stores nothing between.

    One task orders the lines of a customer and aisle, so no customer may be heavy.
    """
    history = Window.partitionBy("user_id", "aisle_id")
    known = lines.filter("user_id IS NOT NULL AND aisle_id IS NOT NULL")
    first = known.withColumn("first_number", F.min("order_number").over(history))
    return first.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("first_number") < F.col("order_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def has_heavy_customer(
    lineitem: DataFrame, orders: DataFrame, most_orders: int = MOST_ORDERS, most_lines: int = MOST_LINES
) -> bool:
    """Whether a customer has more than ``most_orders`` orders, or an order about ``most_lines`` lines.

    Order numbers count the orders of a customer, and lines are counted by a bounded
    sketch, so neither shuffles the table.
    """
    if orders.filter(F.col("order_number") > most_orders).take(1):
        return True
    order = ["l_orderkey"]
    return bool(find_hot_keys(lineitem, order, min_rows=most_lines).of(order))


def stage_star(spark: SparkSession, folder: str) -> StagedTables:
    """Derive the purchase-history tables from the star in ``folder``."""

    def raw(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    part = raw("part")
    tables = {
        "orders": hand_over(star_orders(spread_rows(raw("orders"))), "orders"),
        "products": hand_over(star_products(part), "products"),
        "aisles": hand_over(star_aisles(part), "aisles"),
        "departments": hand_over(star_departments(part), "departments"),
    }
    lineitem, orders = raw("lineitem"), tables["orders"].read(spark)
    bought = bought_lines(spread_rows(lineitem), orders, tables["products"].read(spark))
    if has_heavy_customer(lineitem, orders):
        first = hand_over(first_purchases(bought), "first-purchases").read(spark)
        lines = star_lines(bought, first)
    else:
        lines = star_lines_at_once(bought)
    tables["lines"] = hand_over(lines, "lines", partition_by="eval_set")
    return StagedTables(spark, tables)
