from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rebasket.config import FeatureConfig
from rebasket.operators.features import (
    build_features,
    fill_numeric,
    project_present,
    user_features,
)
from rebasket.operators.joined import build_joined, first_per_key, join_orders, union_lines
from rebasket.operators.skew import copies_for, find_hot_keys, join_unique

RATE = 0.6666666666666666

EXPECTED = {
    # user, product, order number: days, cart, user orders, product orders, rate, aisle, dept, label
    (10, 501, 1): (0.0, 1, 3, 3, RATE, 11, 1, 0),
    (10, 502, 1): (0.0, 2, 3, 3, 0.0, 12, 2, 0),
    (10, 501, 2): (7.0, 1, 3, 3, RATE, 11, 1, 1),
    (10, 999, 2): (7.0, 2, 3, 1, 0.0, 0, 0, 0),
    (10, 501, 3): (0.0, 6, 3, 3, RATE, 11, 1, 1),
    (10, 502, 3): (0.0, 2, 3, 3, 0.0, 12, 2, 0),
    (20, 502, 1): (0.0, 1, 1, 3, 0.0, 12, 2, 0),
}

COLUMNS = [
    "days_since_prior_order",
    "add_to_cart_order",
    "user_order_count",
    "product_order_count",
    "product_reorder_rate",
    "aisle_id",
    "department_id",
    "reordered",
]


def as_dict(features):
    return {
        (r.user_id, r.product_id, r.order_number): tuple(r[c] for c in COLUMNS)
        for r in features.collect()
    }


def test_feature_table_of_the_edge_cases(edge_joined):
    features = build_features(edge_joined)
    assert features.columns == list(FeatureConfig().output_columns)
    assert as_dict(features) == EXPECTED


def test_user_means_run_over_lines(edge_joined):
    means = {r.user_id: r.user_avg_days_between_orders for r in user_features(edge_joined).collect()}
    assert means == {10: 2.3333333333333335, 20: 0.0}


def test_repeated_dimension_rows_change_nothing(edge, edge_joined):
    doubled = build_joined(
        edge["orders"].unionAll(edge["orders"]),
        edge["order_products_prior"].unionAll(edge["order_products_prior"]),
        edge["order_products_train"],
        edge["products"].unionAll(edge["products"]),
    )
    columns = edge_joined.columns
    assert sorted(map(repr, doubled.select(columns).collect())) == sorted(
        map(repr, edge_joined.collect())
    )


def test_prior_wins_over_train_then_cart_position(spark, edge):
    lines = "order_id long, product_id long, add_to_cart_order int, reordered int"
    joined = build_joined(
        edge["orders"],
        spark.createDataFrame([(1, 501, 4, 0), (1, 501, 3, 1)], lines),
        spark.createDataFrame([(1, 501, 1, 0)], lines),
        edge["products"],
    )
    assert [(r.add_to_cart_order, r.reordered) for r in joined.collect()] == [(3, 1)]


def test_reducing_before_the_join_equals_reducing_after(edge):
    """The definition: join everything, then keep the first row per key."""
    orders = edge["orders"].unionAll(edge["orders"].withColumn("order_dow", F.lit(6)))
    products = edge["products"].unionAll(edge["products"].withColumn("product_name", F.lit("a")))
    prior, train = edge["order_products_prior"], edge["order_products_train"]
    lines = union_lines(prior.withColumn("s", F.lit(0)), train.withColumn("s", F.lit(1)))
    wide = join_orders(lines, orders).join(products, "product_id", "left")
    late = first_per_key(wide, ["order_id", "product_id"], ["s", "add_to_cart_order"]).drop("s")
    late = late.withColumn(
        "days_since_prior_order", F.coalesce("days_since_prior_order", F.lit(0.0))
    )
    early = build_joined(orders, prior, train, products)
    assert sorted(map(repr, early.select(late.columns).collect())) == sorted(
        map(repr, late.collect())
    )


def test_union_fills_a_missing_column(edge):
    both = union_lines(
        edge["order_products_prior"], edge["order_products_train"].drop("reordered")
    )
    assert both.count() == 9
    assert both.filter("reordered is null").count() == 4


def test_fill_touches_numbers_only(spark):
    rows = spark.createDataFrame(
        [(None, float("nan"), None, None)], "i int, d double, s string, b boolean"
    )
    assert tuple(fill_numeric(rows).first()) == (0, 0.0, None, None)


def test_projection_leaves_out_absent_names(edge):
    assert project_present(edge["aisles"], ["x", "aisle", "y", "aisle_id"]).columns == [
        "aisle",
        "aisle_id",
    ]


@pytest.fixture(scope="module")
def lopsided(spark):
    """Key 7 owns a third of the rows, null another tenth."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 5000)
    )
    return spark.range(30_000).select(key.cast("int").alias("k"), F.col("id").alias("line"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, lopsided, how):
    dimension = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = find_hot_keys(lopsided, ["k"], min_rows=1000)
    assert len(hot.of(["k"])) == 2  # 7 and null
    salted = join_unique(lopsided, dimension.unionAll(spark.sql("select 7L, 14L")), ["k"], how, hot)
    plain = lopsided.join(dimension.unionAll(spark.sql("select 7L, 14L")), ["k"], how)
    assert sorted(salted.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_hot_rows_are_spread(spark, lopsided):
    dimension = spark.range(6000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    hot = find_hot_keys(lopsided, ["k"], min_rows=1000)
    # 64 partitions, no broadcast: the largest must be far below the hot third
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_unique(lopsided, dimension, ["k"], "left", hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes < 30_000 / 3 / 4
    assert copies_for(1000, 10) == 128 and copies_for(11, 10) == 2 and copies_for(10**12, 10**6) == 1 << 16


def test_small_tables_have_no_hot_keys(lopsided):
    assert find_hot_keys(lopsided, ["k"]).of(["k"]) == {}


def test_sums_kept_by_batch_give_the_features_of_all_lines(spark, edge_joined, tmp_path):
    from rebasket.operators.behaviour import Behaviour
    from rebasket.operators.features import build_features, product_features, user_features
    from rebasket.sources.tables import MissingTable

    def same(a, b):
        assert sorted(map(repr, a.select(b.columns).collect())) == sorted(map(repr, b.collect()))

    kept = Behaviour(str(tmp_path / "kept"))
    with pytest.raises(MissingTable):
        kept.user_features(spark)
    first, second = edge_joined.filter("order_id < 2"), edge_joined.filter("order_id >= 2")
    assert [kept.update(first), kept.update(first), kept.update(edge_joined.limit(0))] == [1, 2, 3]
    same(kept.user_features(spark), user_features(first))
    # An update that stops before its marker does not count and is written over.
    second.select("order_id").write.parquet(str(tmp_path / "kept/orders/update-4"))
    assert kept.update(second) == 4
    same(kept.user_features(spark), user_features(edge_joined))
    same(kept.product_features(spark), product_features(edge_joined))
    same(kept.features(edge_joined), build_features(edge_joined))
