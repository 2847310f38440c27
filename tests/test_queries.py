"""Every registered query against its SQL, and the plans of the large joins."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from oracle import compare, contract, duck
from pyspark.sql import functions as F

from rebasket.plans.catalog import ORACLES, QUERIES, workbench

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")

@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_which_queries_have_no_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    table = contract.entry(spark)
    assert table.columns[0] == "user_id" and table.columns[-1] == "reordered"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["joined_table", "feature_table", "stratified_split_rows", "roc_auc_reorder_rate", "topk_similar"]
)
def test_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_shuffled_once_for_dedup_and_order_join(spark, no_broadcast):
    text = plan(workbench(spark, FOLDER).compute_joined())
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, \d+\)", text)) == 2  # lines, orders
    assert "hashpartitioning(order_id" in text and ", product_id#" not in "".join(
        re.findall(r"Exchange hashpartitioning\(.*?\)", text)
    )


def test_hot_orders_reduce_copies_before_the_shuffle(spark, no_broadcast, monkeypatch):
    from rebasket.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    bench = workbench(spark, FOLDER)
    hot = bench.compute_joined()
    found = re.search(r"Exchange hashpartitioning\(order_id#\d+L, product_id.*\n.*", plan(hot))
    assert "WindowGroupLimit" in found.group(0) and "Partial" in found.group(0)
    assert "_salt" in plan(hot)
    monkeypatch.undo()
    plain = bench.compute_joined()
    assert hot.count() == plain.count() and hot.exceptAll(plain).count() == 0


def test_lines_stored_by_customer_are_not_shuffled(spark, no_broadcast):
    text = plan(contract.queries()["join_back_user_features_bucketed"](spark, FOLDER))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert "Exchange hashpartitioning(user_id" in plan(contract.queries()["join_back_user_features"](spark, FOLDER))


def test_split_does_not_shuffle_the_table(spark):
    assert "Exchange" not in plan(contract.queries()["stratified_split_rows"](spark, FOLDER))


def test_scores_read_only_what_they_need(spark):
    text = plan(contract.queries()["rule_signals"](spark, FOLDER))
    read = re.search(r"ReadSchema: struct<(.*)", text).group(1)
    assert "aisle_id" not in read and "order_dow" not in read
    assert "WholeStageCodegen" in text or "*(1)" in text


def test_heavy_customer_keeps_exact_order_numbers(spark):
    """A customer with a third of all orders gets the same numbers as by direct ranking."""
    from pyspark.sql import Window

    from rebasket.sources.star import star_orders

    raw = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    )
    history = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    direct = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.row_number().over(history).alias("number"),
        F.datediff("o_orderdate", F.lag("o_orderdate").over(history)).cast("double").alias("gap"),
        F.lead("o_orderkey").over(history).isNull().alias("last"),
    )
    joined = star_orders(raw).join(direct, "order_id")
    wrong = joined.filter(
        (F.col("order_number") != F.col("number"))
        | ~F.col("days_since_prior_order").eqNullSafe(F.col("gap"))
        | ((F.col("eval_set") == "train") != F.col("last"))
    )
    assert joined.count() == raw.count() and wrong.count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test data")
def test_known_values(spark):
    bench = workbench(spark, "/root/testdata/sf0.01")
    counts = bench.joined.groupBy("eval_set").agg(F.count("*"), F.sum("reordered"))
    assert {row[0]: tuple(row[1:]) for row in counts.collect()} == {
        "prior": (54_011, 24_445),
        "train": (5_934, 4_291),
    }
    assert bench.features.count() == 59_945
    queries = contract.queries()
    share = queries["accuracy_rule_scorer"](spark, bench.folder).first()[0]
    area = queries["roc_auc_reorder_rate"](spark, bench.folder).first()[0]
    assert share == pytest.approx(0.4948202518975728, abs=1e-12)
    assert area == pytest.approx(0.606548, abs=1e-6)
