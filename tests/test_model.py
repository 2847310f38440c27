from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rebasket.config import FeatureConfig, ModelConfig, TrainingConfig
from rebasket.functions.rules import MODEL_REASON
from rebasket.operators.model import (
    MissingColumn,
    assembler,
    classifier,
    encoder,
    fit_model,
    imputer,
    model_result,
    predict,
    require_columns,
    train,
    tree_groups,
    with_integer_label,
)

SMALL = ModelConfig(params={"n_estimators": 5, "max_depth": 4, "random_state": 1})


@pytest.fixture(scope="module")
def features(spark):
    """Rows whose label follows the reorder rate, with some noise."""
    rate = (F.col("id") * 37 % 100) / 100
    noise = F.col("id") % 11 == 0
    return spark.range(2_000).select(
        (F.col("id") % 90).alias("user_id"),
        (F.col("id") % 40).alias("product_id"),
        F.col("id").cast("int").alias("order_number"),
        (F.col("id") % 7).cast("int").alias("order_dow"),
        (F.col("id") % 24).cast("int").alias("order_hour_of_day"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 30).cast("double")).alias(
            "days_since_prior_order"
        ),
        (F.col("id") % 9 + 1).cast("int").alias("add_to_cart_order"),
        (F.col("id") % 12).alias("user_order_count"),
        (F.col("id") % 50).alias("product_order_count"),
        rate.alias("product_reorder_rate"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 4).cast("int")).alias("aisle_id"),
        F.concat(F.lit("it's "), (F.col("id") % 3).cast("string")).alias("department_id"),
        ((rate >= 0.5) != noise).cast("int").alias("reordered"),
    )


def test_training_measures_saves_and_scores(spark, features, tmp_path):
    trained = train(features, model=SMALL)
    assert trained.validation.count() == 400
    assert trained.metrics["accuracy"] > 0.8
    assert 0.7 < trained.metrics["roc_auc"] <= 1.0
    assert len(trained.model.stages[-1].trees) == 5

    path = str(tmp_path / "model")
    trained.model.write().overwrite().save(path)
    again = type(trained.model).load(path)
    unseen = features.limit(5).withColumns(
        {"aisle_id": F.lit(99), "department_id": F.lit("new"), "order_dow": F.lit(None).cast("int")}
    )
    rows = model_result(predict(again, unseen)).collect()
    assert len(rows) == 5
    for row in rows:
        assert row.prediction == int(row.probability > 0.5)
        assert row.label == ("likely_reordered" if row.prediction else "not_likely_reordered")
        assert (row.confidence_hint, row.reason, row["mode"]) == (
            "model_score",
            MODEL_REASON,
            "model",
        )


def test_training_after_an_observed_query(spark, features):
    """A session that has observed a query still trains, and scores with the fitted model."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] == 10
    trained = train(features, model=SMALL)
    assert not trained.model.stages[-1].hasSummary
    assert trained.validation.count() == 400
    assert predict(trained.model, features).filter("prediction is null").count() == 0


def test_one_class_has_no_auc(features):
    ones = features.filter("reordered = 1")
    assert set(train(ones, model=SMALL).metrics) == {"accuracy"}


def test_absent_columns_are_skipped(features):
    lean = features.drop("aisle_id", "order_dow", "user_order_count")
    trained = train(lean, model=SMALL, training=TrainingConfig(max_rows=500))
    assert trained.validation.count() == 100


def test_imputer_fills_nulls_and_nan(spark):
    rows = spark.createDataFrame(
        [(1.0, 3, "x'y"), (2.0, 3, "x'y"), (10.0, 4, "z"), (None, None, None), (float("nan"), 4, "x'y")],
        "n double, c int, t string",
    )
    filled = imputer(rows, ["n"], ["c", "t"]).transform(rows).collect()
    assert [r.n_filled for r in filled] == [1.0, 2.0, 10.0, 2.0, 2.0]
    assert [r.c_filled for r in filled] == ["3", "3", "4", "3", "4"]
    assert [r.t_filled for r in filled] == ["x'y", "x'y", "z", "x'y", "x'y"]


def test_unseen_category_is_all_zeros(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    model = Pipeline(stages=encoder(["c"])).fit(seen)
    rows = model.transform(spark.createDataFrame([("a",), ("b",), ("q",)], "c string"))
    assert [list(r[0]) for r in rows.select(vector_to_array("c_hot")).collect()] == [
        [1.0, 0.0],
        [0.0, 1.0],
        [0.0, 0.0],
    ]


def test_keys_never_reach_the_model():
    inputs = assembler(FeatureConfig().numeric, FeatureConfig().categorical).getInputCols()
    assert "user_id" not in inputs and "product_id" not in inputs


def test_guards(features):
    with pytest.raises(MissingColumn):
        with_integer_label(features.drop("reordered"), "reordered")
    with pytest.raises(MissingColumn):
        train(features.drop("reordered"))
    with pytest.raises(ValueError, match="unsupported"):
        classifier(ModelConfig(kind="boosting"), "reordered")
    assert require_columns(features, "user_id") is features


def test_forest_parameters():
    forest = classifier(ModelConfig(), "reordered")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)


def test_fractional_categories_keep_their_text(spark):
    rows = spark.createDataFrame([(v,) for v in (3.0, 3.0, 1.5, 1.5, 1.5, None)], "c double")
    filled = imputer(rows, [], ["c"]).transform(rows)
    assert sorted(r["c_filled"] for r in filled.collect()) == ["1.5"] * 4 + ["3.0"] * 2


def test_columns_without_values_are_left_out(spark):
    rows = spark.createDataFrame([(None, None)], "a double, b int")
    assert imputer(rows, ["a"], ["b"]).transform(rows).columns == ["a", "b"]


def test_forest_parameters_are_used_or_refused():
    params = {"n_estimators": 7, "max_depth": None, "min_samples_leaf": 50, "max_features": "log2", "criterion": "entropy"}
    forest = classifier(ModelConfig(params=params), "y")
    assert forest.getNumTrees() == 7 and forest.getMaxDepth() == 30 and forest.getMinInstancesPerNode() == 50
    assert forest.getFeatureSubsetStrategy() == "log2" and forest.getImpurity() == "entropy"
    with pytest.raises(ValueError, match="warm_start"):
        classifier(ModelConfig(params={"warm_start": True}), "y")


def test_many_rows_grow_few_trees_at_a_time(features, tmp_path):
    """A fit of all trees keeps 100 sampling counts and node numbers per row, mostly on disk."""
    assert tree_groups(100, 1_000_000) == [100]
    assert tree_groups(100, 30_000_000) == [10] * 10
    assert tree_groups(11, 30_000_000) == [6, 5]
    whole = fit_model(features, model=SMALL)
    grouped = fit_model(features, model=SMALL, max_row_trees=2 * 2_000, min_trees=1)
    assert [len(stage.trees) for stage in grouped.stages[-3:]] == [2, 2, 1]
    path = str(tmp_path / "model")
    grouped.save(path)
    rows = predict(type(grouped).load(path), features).collect()
    assert len(rows) == 2_000 and all(r.prediction == int(r.probability > 0.5) for r in rows)
    again = predict(fit_model(features, model=SMALL, max_row_trees=2 * 2_000, min_trees=1), features).collect()
    key = lambda r: r.order_number
    assert [r.probability for r in sorted(again, key=key)] == [r.probability for r in sorted(rows, key=key)]
    votes = grouped.transform(features).select(
        "order_number", *[vector_to_array(f"probability_{k}")[1].alias(f"p{k}") for k in range(3)]
    )
    mean = {r.order_number: (2 * r.p0 + 2 * r.p1 + r.p2) / 5 for r in votes.collect()}
    assert all(abs(r.probability - mean[r.order_number]) < 1e-12 for r in rows)
    hits = sum(r.prediction == r.reordered for r in rows)
    assert hits > 1_600 and len(whole.stages) == len(grouped.stages) - 2
