"""What a query writes, shuffles or gives to one task grows no faster than its rows."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rebasket.operators.similarity import text_top_k
from rebasket.plans import table_queries
from rebasket.plans.catalog import Workbench
from rebasket.session import new_path
from rebasket.sources import star
from rebasket.sources.star import first_purchases, has_heavy_customer, star_lines, star_lines_at_once


@pytest.fixture
def bench(spark, tmp_path):
    """A star of 60 orders of 5 customers, three lines each."""
    ids = spark.range(1, 61)
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    tables = {
        "orders": ids.select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"), day.cast("timestamp").alias("o_orderdate")
        ),
        "lineitem": spark.range(180).select(
            (F.col("id") % 60 + 1).alias("l_orderkey"), (F.col("id") % 9).alias("l_partkey"),
            (F.col("id") / 60).cast("int").alias("l_linenumber"),
        ),
        "part": spark.range(9).select(
            F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"),
            F.concat(F.lit("Brand#"), (F.col("id") % 4 + 1)).alias("p_brand"), F.lit("PROMO").alias("p_type"),
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return Workbench(spark, str(tmp_path))


def rows(frame) -> list:
    return sorted(map(tuple, frame.collect()))


def made(bench, name: str) -> list[Path]:
    return list(Path(new_path(bench.spark, "x")).parent.glob(f"{name}-*"))


def test_lines_are_shuffled_once_unless_a_customer_is_heavy(bench, monkeypatch):
    before = set(made(bench, "first-purchases"))
    light = rows(bench.staged["prior"]) + rows(bench.staged["train"])
    assert set(made(bench, "first-purchases")) == before and len(light) == 180
    monkeypatch.setattr(star, "has_heavy_customer", lambda *tables: True)
    again = star.stage_star(bench.spark, bench.folder)
    assert rows(again["prior"]) + rows(again["train"]) == light
    assert len(set(made(bench, "first-purchases")) - before) == 1


def test_lines_at_once_keep_repeated_lines_and_drop_unknown_customers_and_aisles(spark):
    bought = spark.createDataFrame(
        [(3, 1, 1, 10, 2, "prior", 7), (3, 1, 1, 10, 2, "prior", 7), (1, 1, 1, 10, 1, "prior", 7),
         (4, 2, 1, None, 1, "prior", 7), (5, 3, 1, 10, 3, "train", None), (6, 1, 1, 10, None, "train", 7)],
        "order_id long, product_id long, add_to_cart_order int, user_id long, order_number int, eval_set string, aisle_id int",
    )
    key = lambda r: tuple(str(v) for v in r)
    once = sorted(star_lines_at_once(bought).collect(), key=key)
    assert once == sorted(star_lines(bought, first_purchases(bought)).collect(), key=key)
    assert [r.order_id for r in once] == [1, 3, 3, 6]


def test_heavy_customers_and_orders_are_found(bench):
    lineitem, orders = bench.raw("lineitem"), bench.orders
    assert not has_heavy_customer(lineitem, orders)
    assert has_heavy_customer(lineitem, orders, most_orders=11)
    assert not has_heavy_customer(lineitem, orders, most_orders=12, most_lines=4)
    assert has_heavy_customer(lineitem, orders, most_orders=12, most_lines=3)


def test_buckets_follow_the_rows(bench, monkeypatch):
    expected = rows(table_queries.join_back_user_features(bench).select("order_id", "product_id", "user_order_count"))
    monkeypatch.setattr(table_queries, "BUCKET_ROWS", 10)
    found = table_queries.join_back_user_features_bucketed(bench)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert f"SelectedBucketsCount: {-(-bench.joined.count() // 10)} " in text
    assert rows(found.select("order_id", "product_id", "user_order_count")) == expected


def test_damaged_files_follow_the_orders(bench, monkeypatch):
    expected = rows(table_queries.csv_damaged_lines(bench))
    before = set(made(bench, "damaged-csv"))
    monkeypatch.setattr(table_queries, "FILE_ROWS", 10)
    assert rows(table_queries.csv_damaged_lines(bench)) == expected and len(expected) == 60
    (path,) = set(made(bench, "damaged-csv")) - before
    assert len(list(path.glob("task=*"))) == 6


def test_records_between_two_steps_are_compressed(bench):
    before = set(made(bench, "records-json"))
    found = table_queries.json_scan_roundtrip(bench)
    (path,) = set(made(bench, "records-json")) - before
    assert list(path.glob("*.json.gz")) and not list(path.glob("*.json")) and found.count() == bench.features.count()


def test_raw_files_between_two_steps_are_compressed(bench):
    raw = Path(table_queries._raw_folder(bench, orders="", products="archive/"))
    assert list(raw.glob("orders.csv/*.csv.gz")) and list(raw.glob("archive/products.csv/*.csv.gz"))


def test_few_questions_do_not_shuffle_the_terms_of_the_documents(spark):
    docs = spark.range(40).select("id", F.concat_ws(" ", F.lit("w"), (F.col("id") % 7).cast("string"), F.lit("x y")).alias("text"))
    asked = spark.createDataFrame([("a", "3 w"), ("b", "unknown")], "item string, text string")
    found = text_top_k(docs, asked, "id", "item")
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    by_term = [line for line in plan if "Join [term" in line]
    assert len(by_term) == 2 and all("BroadcastHashJoin" in line for line in by_term)
    assert not [line for line in plan if "Exchange hashpartitioning(query_id" in line and "doc_id" in line]
    assert [(r.query_id, r.doc_id, r.rank) for r in found.orderBy("query_id", "rank").collect()] == [
        ("a", 3, 1), ("a", 10, 2), ("a", 17, 3), ("a", 24, 4)
    ]
