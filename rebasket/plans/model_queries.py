"""Queries over imputation, encoding, training and model scores."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.config import FeatureConfig, TrainingConfig
from rebasket.operators.joined import join_orders, join_products, union_lines
from rebasket.operators.model import (
    assembler,
    encoder,
    imputer,
    model_result,
    predict,
    training_rows,
    validation_rows,
)
from rebasket.plans.catalog import RECORD_KEY, Workbench, query
from rebasket.plans.pipeline import Job, batch_records, score_batch
from rebasket.session import spread_rows
from rebasket.sources.records import write_json
from rebasket.sources.runs import load_model
from rebasket.sources.tables import read_csv, write_csv

_KEY = "user_id, order_number, product_id"


@query(
    """, gaps AS (
      SELECT order_id, t.product_id, add_to_cart_order, days_since_prior_order, aisle_id,
        department_id
      FROM d_tagged t JOIN d_orders USING (order_id)
      LEFT JOIN d_stocked p ON p.product_id = t.product_id
    )
    SELECT order_id, product_id, add_to_cart_order,
      coalesce(days_since_prior_order, (SELECT median(days_since_prior_order) FROM gaps))
        AS days_since_prior_order_filled,
      CAST(coalesce(aisle_id, (SELECT aisle_id FROM gaps WHERE aisle_id IS NOT NULL
        GROUP BY aisle_id ORDER BY count(*) DESC, aisle_id LIMIT 1)) AS VARCHAR)
        AS aisle_id_filled,
      CAST(coalesce(department_id, (SELECT department_id FROM gaps WHERE department_id IS NOT NULL
        GROUP BY department_id ORDER BY count(*) DESC, department_id LIMIT 1)) AS VARCHAR)
        AS department_id_filled
    FROM gaps"""
)
def impute_missing(bench: Workbench) -> DataFrame:
    """First orders lack the gap, lines of an unstocked product its categories."""
    lines = join_orders(union_lines(bench.prior, bench.train), bench.orders)
    lines = join_products(lines, bench.stocked_products)
    fill = imputer(lines, ["days_since_prior_order"], ["aisle_id", "department_id"])
    return fill.transform(lines).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        "days_since_prior_order_filled",
        "aisle_id_filled",
        "department_id_filled",
    )


@query(
    """, slots AS (
      SELECT department_id, row_number() OVER (ORDER BY count(*) DESC, department_id) - 1 AS slot
      FROM d_stocked GROUP BY department_id
    )
    SELECT product_id, p.department_id, CAST(coalesce(slot, -1) AS INTEGER) AS slot
    FROM d_products p LEFT JOIN slots s ON s.department_id = p.department_id"""
)
def one_hot_unknown_ignored(bench: Workbench) -> DataFrame:
    """The position of the 1 per product; -1 for a department not seen in the fit."""
    def as_text(products: DataFrame) -> DataFrame:
        return products.select(
            "product_id", "department_id", F.col("department_id").cast("string").alias("c")
        )

    model = Pipeline(stages=encoder(["c"])).fit(as_text(bench.stocked_products))
    hot = vector_to_array("c_hot")
    return model.transform(as_text(bench.products)).select(
        "product_id",
        "department_id",
        (F.array_position(hot, F.lit(1.0)) - 1).cast("int").alias("slot"),
    )


_NUMERIC = FeatureConfig().numeric


@query(
    f"SELECT {_KEY}, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS input_{i}" for i, c in enumerate(_NUMERIC))
    + " FROM d_features"
)
def assemble_inputs(bench: Workbench) -> DataFrame:
    """The numeric part of the model's input vector, position by position."""
    vectors = assembler(_NUMERIC, []).transform(bench.features)
    inputs = vector_to_array("features")
    return vectors.select(
        *RECORD_KEY, *[inputs[i].alias(f"input_{i}") for i in range(len(_NUMERIC))]
    )


_SPLIT_COUNTS = """SELECT reordered, in_test, count(*) AS n FROM (
      SELECT reordered, row_number() OVER (PARTITION BY reordered ORDER BY 1) <= base
        + CASE WHEN place <= missing THEN 1 ELSE 0 END AS in_test
      FROM d_features JOIN (
        SELECT reordered, floor(wanted * n / total) AS base,
          row_number() OVER (ORDER BY wanted * n / total - floor(wanted * n / total) DESC,
            reordered) AS place,
          wanted - sum(floor(wanted * n / total)) OVER () AS missing
        FROM (SELECT reordered, count(*) AS n, sum(count(*)) OVER () AS total,
          ceil(0.2E0 * sum(count(*)) OVER ()) AS wanted FROM d_features GROUP BY reordered))
      USING (reordered))
    GROUP BY reordered, in_test"""


@query(_SPLIT_COUNTS)
def training_row_counts(bench: Workbench) -> DataFrame:
    rows = training_rows(bench.features, FeatureConfig(), TrainingConfig())
    return rows.groupBy("reordered", "in_test").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('accuracy', true), ('roc_auc', true)) AS m(metric, above)")
def train_random_forest_metrics(bench: Workbench) -> DataFrame:
    """Whether the fitted forest beats the larger class, and chance, on the test rows."""
    tested = bench.trained.validation
    share = tested.groupBy("reordered").count().agg(F.max("count") / F.sum("count")).first()[0]
    least = {"accuracy": share, "roc_auc": 0.5}
    rows = [(name, value > least[name]) for name, value in bench.trained.metrics.items()]
    return bench.spark.createDataFrame(rows, "metric string, above boolean")


@query(f"SELECT {_KEY}, true AS as_fitted, true AS consistent FROM d_features")
def model_batch_scores(bench: Workbench) -> DataFrame:
    """Every row scored by the saved model's latest version, held against the fitted model."""
    model = load_model(bench.spark, bench.model_root, "reorder_model")
    fitted = predict(bench.trained.model, spread_rows(bench.features)).withColumnsRenamed(
        {"prediction": "fitted_prediction", "probability": "fitted_probability"}
    )
    saved = predict(model, fitted)
    return saved.select(
        *RECORD_KEY,
        (
            (F.col("prediction") == F.col("fitted_prediction"))
            & (F.abs(F.col("probability") - F.col("fitted_probability")) < 1e-9)
        ).alias("as_fitted"),
        ((F.col("probability") > 0.5) == (F.col("prediction") == 1)).alias("consistent"),
    )


@query(
    f"""SELECT {_KEY}, 'model_score' AS confidence_hint,
      'Generated by the MLflow model registered for retail reorder prediction.' AS reason,
      true AS label_fits, true AS beats_constant FROM d_features"""
)
def model_result_rows(bench: Workbench) -> DataFrame:
    """The parts of a model result, whether the label fits, and whether the model beats a constant."""
    model = load_model(bench.spark, bench.model_root, "reorder_model")
    results = model_result(predict(model, spread_rows(bench.features)))
    fits = (F.col("prediction") == 1) == (F.col("label") == "likely_reordered")
    hits, ones, rows = results.agg(
        F.avg((F.col("prediction") == F.col("reordered")).cast("double")), F.sum("reordered"), F.count("*")
    ).first()
    better = hits > max(ones, rows - ones) / rows
    return results.select(
        *RECORD_KEY, "confidence_hint", "reason", fits.alias("label_fits"), F.lit(better).alias("beats_constant")
    )


@query(f"SELECT reordered AS actual, n, true AS binary FROM ({_SPLIT_COUNTS}) WHERE in_test")
def validation_export(bench: Workbench) -> DataFrame:
    """The exported test rows, counted per label after a round trip through CSV."""
    pairs = validation_rows(bench.trained.validation, "reordered")
    path = write_csv(pairs, bench.scratch("validation"))
    stored = read_csv(bench.spark, path, pairs.schema)
    return stored.groupBy("actual").agg(
        F.count("*").alias("n"), F.bool_and(F.col("prediction").isin(0, 1)).alias("binary")
    )


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS product_id,
      CAST(order_number AS BIGINT) AS order_number, true AS scored FROM d_rough
    WHERE user_order_count = floor(user_order_count)"""
)
def batch_scores_with_ids(bench: Workbench) -> DataFrame:
    """JSON records with gaps and odd values: what the model can fill is scored, with its ids."""
    path = bench.scratch("records")
    write_json(bench.rough_records, path, "gzip")
    job = Job(raw="", root=bench.model_root, records=path, record_identity=("user_id", "product_id"))
    scored = score_batch(bench.spark, job)
    return scored.select(
        "user_id", "product_id", "order_number", F.col("prediction").isin(0, 1).alias("scored")
    )


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS product_id,
      'user_order_count' AS field FROM d_rough WHERE user_order_count <> floor(user_order_count)"""
)
def batch_records_set_aside(bench: Workbench) -> DataFrame:
    """The records of the same batch that have a value of the wrong kind."""
    path = bench.scratch("records")
    write_json(bench.rough_records, path, "gzip")
    job = Job(raw="", root=bench.model_root, records=path, record_identity=("user_id", "product_id"))
    _, aside = batch_records(bench.spark, job)
    return aside.select("user_id", "product_id", F.explode("errors.field").alias("field"))
