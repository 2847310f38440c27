"""Queries over sources, joins, dedup, aggregates and the feature table."""

from __future__ import annotations

import math
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.config import STAGES, FeatureConfig, TrainingConfig
from rebasket.functions.rules import score_with_rules
from rebasket.operators.behaviour import Behaviour
from rebasket.operators.features import (
    build_features,
    fill_numeric,
    hot_behaviour_keys,
    product_features,
    project_present,
    user_features,
    with_product_features,
    with_user_features,
)
from rebasket.operators.joined import (
    build_joined,
    default_days,
    first_per_key,
    join_orders,
    join_products,
    union_lines,
)
from rebasket.operators.model import with_integer_label
from rebasket.operators.quality import as_declared
from rebasket.operators.sampling import cap_rows, stratified_split
from rebasket.operators.statistics import class_count, medians, modes
from rebasket.plans.catalog import RECORD_KEY, Workbench, query
from rebasket.plans.pipeline import Job, evaluate, run
from rebasket.schemas import RECORD, TABLES
from rebasket.sources.records import read_records, write_json
from rebasket.sources.runs import RUNS, latest_by_version, log_metrics, log_run, read_history
from rebasket.sources.tables import (
    RAW_FILES,
    read_csv,
    read_csv_checked,
    read_raw_tables,
    read_table,
    write_bucketed,
    write_csv,
    write_table,
)

BUCKET_ROWS = 1_000_000  # of the joined table in a bucket
FILE_ROWS = 500_000  # orders in a damaged CSV file

_ORDER_COLUMNS = (
    "order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, "
    "days_since_prior_order"
)


@query(f"SELECT {_ORDER_COLUMNS} FROM d_orders")
def csv_scan_roundtrip(bench: Workbench) -> DataFrame:
    path = write_csv(bench.orders, bench.scratch("orders-csv"))
    return read_csv(bench.spark, path, TABLES["orders"])


@query(f"SELECT {_ORDER_COLUMNS} FROM d_orders")
def csv_scan_inferred(bench: Workbench) -> DataFrame:
    path = write_csv(bench.orders, bench.scratch("orders-csv"))
    kinds = {field.name: field.dataType for field in TABLES["orders"]}
    found = read_csv(bench.spark, path)
    return found.select([F.col(c).cast(kinds[c]).alias(c) for c in found.columns])


@query(
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, order_number, order_id % 7 <> 0 AS good
    FROM (SELECT {_ORDER_COLUMNS} FROM d_orders)"""
)
def csv_damaged_lines(bench: Workbench) -> DataFrame:
    """Every seventh line is damaged, by a word as a number or by a field too many."""
    number = F.when(F.col("order_id") % 14 == 0, "one").otherwise(F.col("order_number").cast("string"))
    more = F.when(F.col("order_id") % 14 == 7, ",more").otherwise("")
    names = TABLES["orders"].fieldNames()
    written = bench.orders.withColumn("order_number", number)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    line = F.concat(F.concat_ws(",", *fields), more)
    path = bench.scratch("damaged-csv")
    header = bench.spark.createDataFrame([(",".join(names),)], "value string")
    # Every file needs a header of its own: sorted, it is the first row of each.
    files = max(4, math.ceil(bench.orders.count() / FILE_ROWS))
    tasks = F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("task")
    task = F.pmod(F.xxhash64("order_id"), F.lit(files)).cast("int").alias("task")
    lines = written.select(task, F.lit(1).alias("place"), line.alias("value"))
    heads = header.select(tasks, F.lit(0).alias("place"), "value")
    dealt = heads.unionByName(lines).repartition(files, "task").sortWithinPartitions("task", "place")
    dealt.select("value", "task").write.partitionBy("task").text(path)
    good, damaged = read_csv_checked(bench.spark, f"{path}/task=*", TABLES["orders"])
    numbers = bench.orders.select(F.col("order_id").cast("string").alias("order_id"), "order_number")
    lost = damaged.select(F.substring_index("line", ",", 1).alias("order_id"), F.lit(False).alias("good"))
    kept = good.select(F.col("order_id").cast("string").alias("order_id"), F.lit(True).alias("good"))
    return kept.unionByName(lost).join(numbers, "order_id").select("order_id", "order_number", "good")


@query(
    """SELECT CAST(order_number AS BIGINT) AS order_number, CAST(order_dow AS BIGINT) AS order_dow,
      CAST(order_hour_of_day AS BIGINT) AS order_hour_of_day, days_since_prior_order,
      CAST(add_to_cart_order AS BIGINT) AS add_to_cart_order, user_order_count,
      product_order_count, product_reorder_rate, CAST(aisle_id AS BIGINT) AS aisle_id,
      CAST(department_id AS BIGINT) AS department_id FROM d_features"""
)
def json_scan_roundtrip(bench: Workbench) -> DataFrame:
    records = bench.features.select(RECORD.fieldNames())
    path = write_json(records, bench.scratch("records-json"), "gzip")
    return as_declared(read_records(bench.spark, path))


@query("SELECT * FROM d_joined")
def parquet_sink_roundtrip(bench: Workbench) -> DataFrame:
    return read_table(bench.spark, write_table(bench.joined, bench.scratch("joined-copy")))


@query("SELECT prediction, reordered AS actual FROM d_scored")
def csv_sink_roundtrip(bench: Workbench) -> DataFrame:
    scored = score_with_rules(bench.features)
    pairs = scored.select("prediction", F.col("reordered").alias("actual"))
    path = write_csv(pairs, bench.scratch("validation-csv"))
    return read_csv(bench.spark, path, pairs.schema)


@query(
    "SELECT user_id, order_number, product_id, prediction, label, confidence_hint, reason "
    "FROM d_results"
)
def json_sink_roundtrip(bench: Workbench) -> DataFrame:
    results = score_with_rules(bench.features).select(
        *RECORD_KEY, "prediction", "label", "confidence_hint", "reason"
    )
    path = write_json(results, bench.scratch("predictions-json"))
    return bench.spark.read.schema(results.schema).json(path)


@query(
    """SELECT order_id, product_id, add_to_cart_order, reordered FROM d_lines
      WHERE eval_set = 'prior'
    UNION ALL
    SELECT order_id, product_id, NULL AS add_to_cart_order, reordered FROM d_lines
      WHERE eval_set = 'train'"""
)
def union_prior_train(bench: Workbench) -> DataFrame:
    return union_lines(bench.prior, bench.train.drop("add_to_cart_order"))


@query(
    """SELECT t.order_id, product_id, add_to_cart_order, reordered, user_id, eval_set,
      order_number, order_dow, order_hour_of_day, days_since_prior_order
    FROM d_tagged t JOIN d_orders o ON o.order_id = t.order_id"""
)
def inner_join_orders(bench: Workbench) -> DataFrame:
    return join_orders(union_lines(bench.prior, bench.train), bench.orders)


@query(
    """SELECT order_id, t.product_id, add_to_cart_order, reordered, product_name, aisle_id,
      department_id
    FROM d_tagged t LEFT JOIN d_stocked p ON p.product_id = t.product_id"""
)
def left_join_products_missing(bench: Workbench) -> DataFrame:
    return join_products(union_lines(bench.prior, bench.train), bench.stocked_products)


@query(
    """SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
      coalesce(days_since_prior_order, 0.0E0) AS days_since_prior_order FROM d_orders"""
)
def null_default_days(bench: Workbench) -> DataFrame:
    return default_days(bench.orders)


@query(
    """SELECT order_id, t.product_id, add_to_cart_order, reordered, product_name,
      coalesce(aisle_id, 0) AS aisle_id, coalesce(department_id, 0) AS department_id
    FROM d_tagged t LEFT JOIN d_stocked p ON p.product_id = t.product_id"""
)
def numeric_null_fill(bench: Workbench) -> DataFrame:
    lines = union_lines(bench.prior, bench.train)
    return fill_numeric(join_products(lines, bench.stocked_products))


@query(
    """SELECT order_id, product_id, add_to_cart_order, reordered, source FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id, product_id
        ORDER BY source, add_to_cart_order, reordered) AS rn FROM d_tagged) WHERE rn = 1"""
)
def dedup_order_product(bench: Workbench) -> DataFrame:
    lines = union_lines(
        bench.prior.withColumn("source", F.lit(0)), bench.train.withColumn("source", F.lit(1))
    )
    return first_per_key(lines, ["order_id", "product_id"], ["source", "add_to_cart_order"])


@query("SELECT * FROM d_joined")
def joined_table(bench: Workbench) -> DataFrame:
    return bench.compute_joined()


@query("SELECT * FROM d_users")
def user_features_table(bench: Workbench) -> DataFrame:
    return user_features(bench.joined)


@query("SELECT * FROM d_items")
def product_features_table(bench: Workbench) -> DataFrame:
    return product_features(bench.joined)


_WITH_USERS = """SELECT j.*, user_order_count, user_avg_days_between_orders
    FROM d_joined j LEFT JOIN d_users u ON u.user_id = j.user_id"""


@query(_WITH_USERS)
def join_back_user_features(bench: Workbench) -> DataFrame:
    hot = hot_behaviour_keys(bench.joined)
    return with_user_features(bench.joined, user_features(bench.joined), hot)


@query(
    """SELECT j.*, product_order_count, product_reorder_rate
    FROM d_joined j LEFT JOIN d_items i ON i.product_id = j.product_id"""
)
def join_back_product_features(bench: Workbench) -> DataFrame:
    hot = hot_behaviour_keys(bench.joined)
    return with_product_features(bench.joined, product_features(bench.joined), hot)


@query(
    """SELECT user_id, product_id, order_number, order_dow, order_hour_of_day,
      days_since_prior_order, add_to_cart_order, aisle_id, department_id, reordered
    FROM d_joined"""
)
def project_configured_columns(bench: Workbench) -> DataFrame:
    return project_present(bench.joined, FeatureConfig().output_columns)


@query("SELECT * FROM d_features")
def feature_table(bench: Workbench) -> DataFrame:
    return build_features(bench.joined)


@query(
    """SELECT user_id, order_number, product_id, CAST(reordered AS INTEGER) AS from_number,
      CAST(CASE WHEN product_id % 7 <> 0 THEN reordered END AS INTEGER) AS from_text FROM d_features"""
)
def label_cast(bench: Workbench) -> DataFrame:
    """Labels that come as fractions lose them; labels that come as text, with gaps, become numbers."""
    numbers = bench.features.withColumn("reordered", F.col("reordered") + 0.75)
    cast = with_integer_label(numbers, "reordered").withColumnRenamed("reordered", "from_number")
    text = F.when(F.col("product_id") % 7 != 0, F.col("from_number").cast("string"))
    both = with_integer_label(cast.withColumn("label", text), "label")
    return both.select(*RECORD_KEY, "from_number", F.col("label").alias("from_text"))


@query("SELECT * EXCLUDE (reordered) FROM d_features")
def label_drop(bench: Workbench) -> DataFrame:
    return bench.features.drop("reordered")


@query("SELECT count(DISTINCT reordered) AS classes FROM d_features")
def label_class_count(bench: Workbench) -> DataFrame:
    return class_count(bench.features, "reordered")


_NUMERIC = FeatureConfig().numeric
_CATEGORICAL = FeatureConfig().categorical


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(median({c}) AS DOUBLE) AS median FROM d_features"
        for c in _NUMERIC
    )
)
def median_by_column(bench: Workbench) -> DataFrame:
    return medians(bench.features, _NUMERIC)


@query(
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS BIGINT) AS mode
        FROM d_features GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
        for c in _CATEGORICAL
    )
)
def mode_by_column(bench: Workbench) -> DataFrame:
    return modes(bench.features, _CATEGORICAL)


_HASH = "md5(concat_ws('|', '42', user_id, order_number, product_id))"


@query(
    f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (ORDER BY {_HASH}) AS rn FROM d_features) WHERE rn <= 1000"""
)
def deterministic_cap(bench: Workbench) -> DataFrame:
    """The row cap of the demo training set."""
    return cap_rows(bench.features, 1000, RECORD_KEY, seed=42)


@query(
    f""", ranked AS (
      SELECT user_id, order_number, product_id, reordered,
        row_number() OVER (PARTITION BY reordered ORDER BY {_HASH}) AS rn FROM d_features
    ), sized AS (
      SELECT reordered, count(*) AS n, sum(count(*)) OVER () AS total,
        ceil(0.2E0 * sum(count(*)) OVER ()) AS wanted FROM d_features GROUP BY reordered
    ), shared AS (
      SELECT reordered, wanted, floor(wanted * n / total) AS base,
        row_number() OVER (ORDER BY wanted * n / total - floor(wanted * n / total) DESC,
          reordered) AS place,
        wanted - sum(floor(wanted * n / total)) OVER () AS missing FROM sized
    )
    SELECT user_id, order_number, product_id, r.reordered,
      rn <= base + CASE WHEN place <= missing THEN 1 ELSE 0 END AS in_test
    FROM ranked r JOIN shared s ON s.reordered = r.reordered"""
)
def stratified_split_rows(bench: Workbench) -> DataFrame:
    split = stratified_split(bench.features, "reordered", 0.2, RECORD_KEY, seed=42)
    return split.select(*RECORD_KEY, "reordered", "in_test")


@query(
    f""", ranked AS (
      SELECT user_id, order_number, product_id,
        row_number() OVER (PARTITION BY product_id ORDER BY {_HASH}) AS rn FROM d_features
    ), sized AS (
      SELECT product_id, count(*) AS n, sum(count(*)) OVER () AS total,
        CAST(ceil(0.2E0 * sum(count(*)) OVER ()) AS HUGEINT) AS wanted FROM d_features GROUP BY product_id
    ), shared AS (
      SELECT product_id, wanted * n // total AS base,
        row_number() OVER (ORDER BY wanted * n % total DESC, product_id) AS place,
        wanted - sum(wanted * n // total) OVER () AS missing FROM sized
    )
    SELECT user_id, order_number, r.product_id,
      rn <= base + CASE WHEN place <= missing THEN 1 ELSE 0 END AS in_test
    FROM ranked r JOIN shared s ON s.product_id = r.product_id"""
)
def stratified_split_many_labels(bench: Workbench) -> DataFrame:
    """A split by product: thousands of labels, their shares and cuts as joined tables."""
    split = stratified_split(bench.features, "product_id", 0.2, RECORD_KEY, seed=42)
    return split.select(*RECORD_KEY, "in_test")


@query(
    """SELECT user_id, max(order_number) AS order_number,
      arg_max(order_id, order_number) AS order_id FROM d_orders GROUP BY user_id"""
)
def latest_version(bench: Workbench) -> DataFrame:
    """The pick of the newest version, here of each customer's newest order."""
    return latest_by_version(bench.orders, "user_id", "order_number", "order_id")


@query(
    """SELECT 'l_extendedprice' AS "column", CAST(median(l_extendedprice) AS DOUBLE) AS median FROM lineitem
    UNION ALL SELECT 'l_discount', CAST(median(l_discount) AS DOUBLE) FROM lineitem"""
)
def median_continuous(bench: Workbench) -> DataFrame:
    """A column of nearly distinct values and one of few, narrowed until 500 rows are ordered."""
    return medians(bench.raw("lineitem"), ["l_extendedprice", "l_discount"], max_ordered=500)


@query(
    """SELECT 'days' AS "column", CAST(days AS DOUBLE) AS mode FROM (
      SELECT days_since_prior_order / 4.0E0 AS days FROM d_features WHERE order_number > 1)
    GROUP BY days ORDER BY count(*) DESC, days LIMIT 1"""
)
def mode_of_doubles(bench: Workbench) -> DataFrame:
    """The most frequent of fractional values, which must not be rounded."""
    days = F.when(F.col("order_number") > 1, F.col("days_since_prior_order") / 4).otherwise(float("nan"))
    return modes(bench.features.select(days.alias("days")), ["days"])


@query(
    """SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', user_id)),
        md5(concat_ws('|', '42', user_id, order_number, product_id))) AS rn
      FROM (SELECT user_id, order_number, product_id FROM d_features)) WHERE rn <= 1000"""
)
def cap_with_repeated_keys(bench: Workbench) -> DataFrame:
    """A cap by a key that many rows share: the rows at the cut are told apart by their other columns."""
    return cap_rows(bench.features.select("user_id", "order_number", "product_id"), 1000, ["user_id"], seed=42)


@query("SELECT * FROM d_joined")
def joined_table_salted(bench: Workbench) -> DataFrame:
    """The joined table by the plan for hot keys: every key of twenty lines counts as hot."""
    return build_joined(bench.orders, bench.prior, bench.train, bench.products, hot_rows=20)


@query("SELECT * FROM d_features")
def feature_table_salted(bench: Workbench) -> DataFrame:
    """The feature table by the plan for hot keys."""
    return build_features(bench.joined, hot_rows=20)


def _behaviour(bench: Workbench) -> Behaviour:
    """The features of all lines, in two batches of whole orders; the first comes twice."""
    kept = Behaviour(bench.scratch("behaviour"))
    even = F.col("order_id") % 2 == 0
    for batch in (bench.joined.filter(even), bench.joined.filter(even), bench.joined.filter(~even)):
        kept.update(batch)
    return kept


@query("SELECT * FROM d_users")
def incremental_user_features(bench: Workbench) -> DataFrame:
    return _behaviour(bench).user_features(bench.spark)


@query("SELECT * FROM d_items")
def incremental_product_features(bench: Workbench) -> DataFrame:
    return _behaviour(bench).product_features(bench.spark)


@query("SELECT * FROM d_features")
def incremental_feature_table(bench: Workbench) -> DataFrame:
    """The feature table out of sums that were kept batch by batch."""
    return _behaviour(bench).features(bench.joined)


def _raw_folder(bench: Workbench, **places: str) -> str:
    """The star's tables as raw CSV files, each below the given subfolder."""
    raw = bench.scratch("raw")
    names = {table: file for file, table in RAW_FILES.items()}
    frames = {
        "orders": bench.orders,
        "order_products_prior": bench.prior,
        "order_products_train": bench.train,
        "products": bench.products,
    }
    for table, place in places.items():
        write_csv(frames[table], f"{raw}/{place}{names[table]}", "gzip")
    return raw


@query(
    """SELECT 'orders' AS name, count(*) AS n FROM d_orders UNION ALL SELECT 'products', count(*) FROM d_products
    UNION ALL SELECT 'order_products_prior', count(*) FROM d_lines WHERE eval_set = 'prior'"""
)
def raw_tables_found(bench: Workbench) -> DataFrame:
    """Raw files in the folder and in its archive; those that are nowhere are left out."""
    raw = _raw_folder(bench, orders="archive/", products="", order_products_prior="archive/")
    found = read_raw_tables(bench.spark, raw)
    counts = [frame.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, frame in found.items()]
    return reduce(DataFrame.unionAll, counts)


@query("SELECT * FROM d_features")
def pipeline_feature_table(bench: Workbench) -> DataFrame:
    """The stages from raw CSV files to the feature table, broken off after the second and resumed."""
    raw = _raw_folder(bench, orders="", products="archive/", order_products_prior="", order_products_train="")
    job = Job(raw=raw, root=bench.scratch("pipeline"), stages=STAGES[:2])
    run(bench.spark, job)
    results = run(bench.spark, replace(job, stages=STAGES[:3]), resume=True)
    if [stage for stage, result in results.items() if result is None] != list(STAGES[:2]):
        raise RuntimeError("a finished stage has run again")
    return read_table(bench.spark, job.table("features"))


@query(
    """SELECT 'run-' || order_dow AS run_id, 'order_dow' AS column_name, value AS accuracy,
      CASE WHEN value < 0.5E0 THEN 'retraining recommended' ELSE 'model stable' END AS status
    FROM (SELECT order_dow, avg(CASE WHEN prediction = reordered THEN 1.0E0 ELSE 0.0E0 END)
      AS value FROM d_scored GROUP BY order_dow)"""
)
def logged_runs(bench: Workbench) -> DataFrame:
    """One run per weekday, logged with parameters and metrics; the status of each as the last run."""
    hit = (F.col("prediction") == F.col("reordered")).cast("double")
    runs = score_with_rules(bench.features).groupBy("order_dow").agg(F.avg(hit).alias("accuracy")).collect()
    job = Job(raw="", root=bench.scratch("runs"), training=TrainingConfig(min_metric=0.5))
    status = []
    for row in sorted(runs):  # seven rows
        run_id = f"run-{row['order_dow']}"
        log_run(bench.spark, job.root, run_id, "weekdays", {"by": "order_dow"}, {"accuracy": row["accuracy"]})
        log_metrics(bench.spark, job.root, run_id, {"accuracy": row["accuracy"]})
        status.append((run_id, evaluate(bench.spark, job)))
    logged = read_history(bench.spark, f"{job.root}/runs", RUNS).select(
        "run_id", F.col("params")["by"].alias("column_name"), F.col("metrics")["accuracy"].alias("accuracy")
    )
    return logged.join(bench.spark.createDataFrame(status, "run_id string, status string"), "run_id")


@query(_WITH_USERS)
def join_back_user_features_bucketed(bench: Workbench) -> DataFrame:
    """Lines stored by customer: their features and the join back shuffle nothing."""
    path = bench.scratch("joined_by_user")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    # A task reads a bucket, so there are as many as the rows ask for.
    buckets = max(8, math.ceil(bench.joined.count() / BUCKET_ROWS))
    stored = write_bucketed(bench.joined, name, path, "user_id", buckets=buckets)
    return stored.join(user_features(stored), "user_id", "left")
