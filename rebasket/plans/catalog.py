"""The registered queries and the stored tables they share."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.operators.features import build_features
from rebasket.operators.joined import build_joined
from rebasket.operators.model import Trained, train
from rebasket.operators.text_index import TextIndex, build_text_index
from rebasket.operators.vector_index import VectorIndex, build_vector_index
from rebasket.session import Handover, configure, hand_over, new_path, spread_rows
from rebasket.sources.runs import save_model
from rebasket.sources.star import StagedTables, stage_star

RECORD_KEY = ["user_id", "order_number", "product_id"]


class Workbench:
    """The tables of one star folder, derived and stored when first asked for.

    As in the pipeline, every stage starts from the stored result of the stage
    before it, so a query reads columns of a table, not a chain of shuffles.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def staged(self) -> StagedTables:
        return stage_star(self.spark, self.folder)

    @property
    def orders(self) -> DataFrame:
        return self.staged["orders"]

    @property
    def products(self) -> DataFrame:
        return self.staged["products"]

    @property
    def prior(self) -> DataFrame:
        return self.staged["prior"]

    @property
    def train(self) -> DataFrame:
        return self.staged["train"]

    @property
    def stocked_products(self) -> DataFrame:
        """The products of all departments but one, so that some lines find none."""
        return self.products.filter(F.col("department_id") != 6)

    def compute_joined(self) -> DataFrame:
        return build_joined(self.orders, self.prior, self.train, self.products)

    @cached_property
    def _joined(self) -> Handover:
        return hand_over(self.compute_joined(), "joined")

    @property
    def joined(self) -> DataFrame:
        return self._joined.read(self.spark)

    @cached_property
    def stored_features(self) -> Handover:
        return hand_over(build_features(self.joined), "features")

    @property
    def features(self) -> DataFrame:
        return self.stored_features.read(self.spark)

    @property
    def rough_records(self) -> DataFrame:
        """Feature rows bent so that every kind of violation occurs."""
        return self.features.select(
            "user_id",
            "product_id",
            F.col("order_number"),
            ((F.col("order_dow") + F.col("order_hour_of_day")) % 9).alias("order_dow"),
            (F.col("order_hour_of_day") + F.col("order_dow")).alias("order_hour_of_day"),
            F.when(F.col("order_number") > 1, F.col("days_since_prior_order") - 1).alias(
                "days_since_prior_order"
            ),
            (F.col("add_to_cart_order") - 1).alias("add_to_cart_order"),
            (F.col("user_order_count") / 2).alias("user_order_count"),
            F.col("product_order_count"),
            (F.col("product_reorder_rate") * 1.5).alias("product_reorder_rate"),
            (F.col("aisle_id") - 1).alias("aisle_id"),
            F.col("department_id"),
        )

    @cached_property
    def trained(self) -> Trained:
        return train(self.features)

    @cached_property
    def model_root(self) -> str:
        root = new_path(self.spark, "model")
        save_model(self.spark, root, "reorder_model", self.trained.model, "workbench")
        return root

    @cached_property
    def text_index(self) -> TextIndex:
        documents = spread_rows(self.raw("documents").select("doc_id", "text"))
        return build_text_index(documents, new_path(self.spark, "text-index"), "doc_id")

    @property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))

    @cached_property
    def vector_index(self) -> VectorIndex:
        return build_vector_index(self.vectors, new_path(self.spark, "vector-index"), cells=16)

    def scratch(self, name: str) -> str:
        return new_path(self.spark, name)


_benches: dict[tuple[str, str], Workbench] = {}
_lock = threading.Lock()


def workbench(spark: SparkSession, folder: str) -> Workbench:
    """The workbench of this application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    with _lock:
        if key not in _benches:
            _benches[key] = Workbench(spark, folder)
        return _benches[key]


QUERIES: dict[str, Callable[[Workbench], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that must agree."""

    def register(build: Callable[[Workbench], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = STAR_SQL + sql
        return build

    return register


# The tables of the workbench in plain SQL over the star.
STAR_SQL = """
WITH d_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
    CASE WHEN lead(o_orderkey) OVER w IS NULL THEN 'train' ELSE 'prior' END AS eval_set,
    CAST(row_number() OVER w AS INTEGER) AS order_number,
    CAST(extract(dow FROM o_orderdate) AS INTEGER) AS order_dow,
    CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
    CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE)
      AS days_since_prior_order
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
), d_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    CAST(substring(p_brand, 7) AS INTEGER) AS aisle_id,
    CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
      WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS department_id
  FROM part
), d_stocked AS (
  SELECT * FROM d_products WHERE department_id <> 6
), d_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS add_to_cart_order,
    CAST(min(order_number) OVER (PARTITION BY user_id, aisle_id) < order_number AS INTEGER)
      AS reordered,
    eval_set
  FROM lineitem
  JOIN d_orders ON d_orders.order_id = l_orderkey
  JOIN d_products ON d_products.product_id = l_partkey
), d_tagged AS (
  SELECT order_id, product_id, add_to_cart_order, reordered,
    CASE eval_set WHEN 'prior' THEN 0 ELSE 1 END AS source
  FROM d_lines
), d_wide AS (
  SELECT t.order_id, t.product_id, add_to_cart_order, reordered, user_id, eval_set,
    order_number, order_dow, order_hour_of_day,
    coalesce(days_since_prior_order, 0.0E0) AS days_since_prior_order,
    product_name, aisle_id, department_id,
    row_number() OVER (PARTITION BY t.order_id, t.product_id
      ORDER BY source, add_to_cart_order, reordered) AS rn
  FROM d_tagged t
  JOIN d_orders o ON o.order_id = t.order_id
  LEFT JOIN d_products p ON p.product_id = t.product_id
), d_joined AS (
  SELECT * EXCLUDE (rn) FROM d_wide WHERE rn = 1
), d_users AS (
  SELECT user_id, count(DISTINCT order_id) AS user_order_count,
    avg(days_since_prior_order) AS user_avg_days_between_orders
  FROM d_joined GROUP BY user_id
), d_items AS (
  SELECT product_id, count(*) AS product_order_count, avg(reordered) AS product_reorder_rate
  FROM d_joined GROUP BY product_id
), d_features AS (
  SELECT j.user_id, j.product_id, order_number, order_dow, order_hour_of_day,
    days_since_prior_order, add_to_cart_order, user_order_count, product_order_count,
    product_reorder_rate, aisle_id, department_id, reordered
  FROM d_joined j JOIN d_users u ON u.user_id = j.user_id
  JOIN d_items i ON i.product_id = j.product_id
), d_signals AS (
  SELECT *, product_reorder_rate >= 0.5E0 AS likely_repeat_item,
    user_order_count >= 5 AND days_since_prior_order > 0 AND days_since_prior_order <= 14
      AS active_customer,
    add_to_cart_order BETWEEN 1 AND 5 AS high_intent_cart_position
  FROM d_features
), d_scored AS (
  SELECT *, CAST(high_intent_cart_position OR (likely_repeat_item AND active_customer)
      AS INTEGER) AS prediction
  FROM d_signals
), d_results AS (
  SELECT *,
    CASE prediction WHEN 1 THEN 'likely_reordered' ELSE 'not_likely_reordered' END AS label,
    CASE WHEN prediction = 1 AND CAST(likely_repeat_item AS INTEGER)
      + CAST(active_customer AS INTEGER) + CAST(high_intent_cart_position AS INTEGER) >= 2
      THEN 'high' ELSE 'medium' END AS confidence_hint,
    coalesce(nullif(concat_ws(', ',
      CASE WHEN likely_repeat_item
        THEN 'product has a strong historical reorder rate' END,
      CASE WHEN active_customer
        THEN 'customer has enough order history and recent activity' END,
      CASE WHEN high_intent_cart_position
        THEN 'product appears early in the cart' END), ''),
      'signals are not strong enough for a reorder') AS reason
  FROM d_scored
), d_rough AS (
  SELECT user_id, product_id, order_number,
    (order_dow + order_hour_of_day) % 9 AS order_dow,
    order_hour_of_day + order_dow AS order_hour_of_day,
    CASE WHEN order_number > 1 THEN days_since_prior_order - 1 END AS days_since_prior_order,
    add_to_cart_order - 1 AS add_to_cart_order,
    user_order_count / 2.0E0 AS user_order_count,
    product_order_count,
    product_reorder_rate * 1.5E0 AS product_reorder_rate,
    aisle_id - 1 AS aisle_id,
    department_id
  FROM d_features
), d_violations AS (
  SELECT user_id, order_number, product_id, field FROM (
    SELECT user_id, order_number, product_id, unnest([
      CASE WHEN order_number IS NULL THEN 'order_number' END,
      CASE WHEN order_dow IS NULL OR order_dow NOT BETWEEN 0 AND 6 THEN 'order_dow' END,
      CASE WHEN order_hour_of_day IS NULL OR order_hour_of_day NOT BETWEEN 0 AND 23
        THEN 'order_hour_of_day' END,
      CASE WHEN days_since_prior_order IS NULL OR days_since_prior_order < 0
        THEN 'days_since_prior_order' END,
      CASE WHEN add_to_cart_order IS NULL OR add_to_cart_order < 1
        THEN 'add_to_cart_order' END,
      CASE WHEN user_order_count IS NULL OR user_order_count < 0
        OR user_order_count <> floor(user_order_count) THEN 'user_order_count' END,
      CASE WHEN product_order_count IS NULL OR product_order_count < 0
        THEN 'product_order_count' END,
      CASE WHEN product_reorder_rate IS NULL OR product_reorder_rate NOT BETWEEN 0 AND 1
        THEN 'product_reorder_rate' END,
      CASE WHEN aisle_id IS NULL OR aisle_id < 1 THEN 'aisle_id' END,
      CASE WHEN department_id IS NULL OR department_id < 1 THEN 'department_id' END
    ]) AS field FROM d_rough) WHERE field IS NOT NULL
)
"""
