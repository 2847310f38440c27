"""The reorder model: imputation, encoding, random forest, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rebasket.config import FeatureConfig, ModelConfig, TrainingConfig
from rebasket.functions.rules import MODEL_CONFIDENCE, MODEL_REASON, class_label
from rebasket.operators.forest import Layout, grow, scores
from rebasket.operators.sampling import cap_rows, stratified_split
from rebasket.operators.statistics import accuracy, medians, modes, roc_auc, text_modes
from rebasket.session import hand_over, shared_folder, spread_rows


class MissingColumn(ValueError):
    """A column the job needs is not in the table."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise MissingColumn(f"missing columns: {', '.join(absent)}")
    return df


def with_integer_label(df: DataFrame, label: str) -> DataFrame:
    return require_columns(df, label).withColumn(label, F.col(label).cast("int"))


def imputer(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """A stage that fills numbers with the median and categories with the mode.

    Both are exact and become part of the stage's statement.  Filled columns
    get the suffix ``_filled``; categories turn into text.  Columns without any
    value are left out.
    """
    filled = []
    for row in medians(df, numeric).collect() if numeric else []:  # one row per column
        filled.append(
            f"coalesce(nanvl(CAST(`{row['column']}` AS DOUBLE), CAST(NULL AS DOUBLE)), "
            f"CAST('{row['median']!r}' AS DOUBLE)) AS `{row['column']}_filled`"
        )
    numbers = [c for c in categorical if isinstance(df.schema[c].dataType, NumericType)]
    texts = [c for c in categorical if c not in numbers]
    found = []
    if numbers:
        # One call per column: columns of different types keep their own.
        found += [row for c in numbers for row in modes(df, [c]).collect()]
    if texts:
        found += text_modes(df, texts).collect()
    for row in found:
        value = str(row["mode"]).replace("\\", "\\\\").replace("'", "\\'")
        # The fill value becomes text the way the data does: through the column's type.
        kind = df.schema[row["column"]].dataType.simpleString()
        filled.append(
            f"coalesce(CAST(`{row['column']}` AS STRING), CAST(CAST('{value}' AS {kind}) AS STRING)) "
            f"AS `{row['column']}_filled`"
        )
    return SQLTransformer(statement=f"SELECT {', '.join(['*', *sorted(filled)])} FROM __THIS__")


def filled_columns(stage: SQLTransformer, columns: Sequence[str]) -> list[str]:
    statement = stage.getStatement()
    return [f"{c}_filled" for c in columns if f"`{c}_filled`" in statement]


def encoder(categories: Sequence[str]) -> list:
    """One-hot stages; a category not seen in training becomes all zeros."""
    if not categories:
        return []
    indexed = [f"{c}_index" for c in categories]
    hot = [f"{c}_hot" for c in categories]
    return [
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
    ]


# Rows times trees of one forest, where a model is to be saved as several, and the least trees of each.
MAX_ROW_TREES = 200_000_000
MIN_TREES = 10


def _share(value: object) -> str:
    """How many features a tree node looks at, in Spark's terms."""
    if value is None:
        return "all"
    return value if isinstance(value, str) else str(value)


# What each accepted parameter sets in Spark, and how its value is read.
FOREST_PARAMETERS = {
    "n_estimators": ("numTrees", int),
    "max_depth": ("maxDepth", lambda depth: 30 if depth is None else int(depth)),
    "random_state": ("seed", int),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "min_impurity_decrease": ("minInfoGain", float),
    "max_features": ("featureSubsetStrategy", _share),
    "max_samples": ("subsamplingRate", lambda share: 1.0 if share is None else float(share)),
    "criterion": ("impurity", str),
    "bootstrap": ("bootstrap", bool),
}


def classifier(config: ModelConfig, label: str, tree_memory_mb: int = 1024) -> RandomForestClassifier:
    """The forest with every configured parameter; one without an equivalent is an error.

    Nodes of one level are grown together as far as their statistics fit in
    ``tree_memory_mb`` per task.
    """
    if config.kind != "random_forest":
        raise ValueError(f"unsupported model type: {config.kind}")
    unknown = sorted(set(config.params) - set(FOREST_PARAMETERS))
    if unknown:
        raise ValueError(f"model parameters without an equivalent: {', '.join(unknown)}")
    given = {"n_estimators": 100, "max_depth": 10, "random_state": 42} | dict(config.params)
    settings = {}
    for name, value in given.items():
        spark_name, read = FOREST_PARAMETERS[name]
        settings[spark_name] = read(value)
    return RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        maxMemoryInMB=tree_memory_mb,
        # Rows remember their node in every tree instead of walking all trees
        # once per level, which halves the time at depth 10.
        cacheNodeIds=True,
        **settings,
    )


def tree_groups(trees: int, rows: int, most: int = MAX_ROW_TREES, least: int = MIN_TREES) -> list[int]:
    """How many trees each forest of a model has, nearly alike, so that none has more rows times trees than ``most``."""
    fits = -(-trees // max(most // max(rows, 1), least, 1))
    return [trees // fits + (k < trees % fits) for k in range(fits)]


def grown_in_groups(forest: RandomForestClassifier, groups: Sequence[int]) -> list[RandomForestClassifier]:
    """One forest per group, each with a seed and output columns of its own; a single group is the forest itself."""
    if len(groups) == 1:
        return [forest]
    return [
        forest.copy().setNumTrees(trees).setSeed(forest.getSeed() + k).setPredictionCol(f"prediction_{k}")
        .setRawPredictionCol(f"raw_prediction_{k}").setProbabilityCol(f"probability_{k}")
        for k, trees in enumerate(groups)
    ]


def assembler(numeric: Sequence[str], categories: Sequence[str]) -> VectorAssembler:
    """All model inputs in one vector; keys and other columns never reach the model."""
    return VectorAssembler(
        inputCols=[*numeric, *[f"{c}_hot" for c in categories]], outputCol="features"
    )


def preprocessing(df: DataFrame, features: FeatureConfig) -> list:
    """The stages before the classifier, for the configured columns that exist."""
    numeric = [c for c in features.numeric if c in df.columns]
    categorical = [c for c in features.categorical if c in df.columns]
    fill = imputer(df, numeric, categorical)
    categories = filled_columns(fill, categorical)
    return [fill, *encoder(categories), assembler(filled_columns(fill, numeric), categories)]


def layout(stages: Sequence) -> Layout:
    """What the vectors of fitted preprocessing stages hold: numbers, then one-hot columns."""
    hot = [stage for stage in stages if isinstance(stage, OneHotEncoderModel)]
    sizes = [size - 1 for stage in hot for size in stage.categorySizes]  # the last one is all zeros
    return Layout(len(stages[-1].getInputCols()) - len(sizes), tuple(sizes))


def fit_model(
    train: DataFrame,
    features: FeatureConfig = FeatureConfig(),
    model: ModelConfig = ModelConfig(),
    max_row_trees: int | None = None,
    min_trees: int = MIN_TREES,
) -> PipelineModel:
    """The stages before the forest, and the forest; with ``max_row_trees`` several (see ``tree_groups``)."""
    forest = classifier(model, features.label)
    inputs = Pipeline(stages=preprocessing(train, features)).fit(train)
    # Stored: growing reads the prepared rows three times, for classes, bins and blocks.
    prepared = spread_rows(inputs.transform(train).select("features", features.label))
    rows = hand_over(prepared, "prepared").read(train.sparkSession)
    groups = [forest.getNumTrees()]
    if max_row_trees is not None:
        groups = tree_groups(forest.getNumTrees(), rows.count(), max_row_trees, min_trees)
    forests = grow(rows, grown_in_groups(forest, groups), layout(inputs.stages))
    return PipelineModel([*inputs.stages, *forests])


def predict(model: PipelineModel, records: DataFrame) -> DataFrame:
    """Add ``prediction`` (0 or 1) and the positive ``probability``, the mean over all trees."""
    forests = [stage for stage in model.stages if isinstance(stage, RandomForestClassificationModel)]
    inputs = PipelineModel([stage for stage in model.stages if stage not in forests])
    scored = inputs.transform(records).select(*records.columns, scores(forests, F.col("features")).alias("_score"))
    return scored.select(*records.columns, "_score.prediction", "_score.probability")


def model_result(scored: DataFrame, mode: str = "model") -> DataFrame:
    """Add label, confidence_hint, reason and mode to model predictions."""
    return scored.withColumns(
        {
            "label": class_label(F.col("prediction")),
            "confidence_hint": F.lit(MODEL_CONFIDENCE),
            "reason": F.lit(MODEL_REASON),
            "mode": F.lit(mode),
        }
    )


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    validation: DataFrame  # the test rows with prediction and probability
    metrics: dict


def training_rows(df: DataFrame, features: FeatureConfig, training: TrainingConfig) -> DataFrame:
    """Capped, labelled and split rows: the label as an int, and ``in_test``."""
    require_columns(df, features.label)
    capped = cap_rows(df, training.max_rows, training.row_key, training.seed)
    labelled = with_integer_label(capped, features.label)
    return stratified_split(
        labelled, features.label, training.test_size, training.row_key, training.seed
    )


def validation_rows(scored: DataFrame, label: str) -> DataFrame:
    """(prediction, actual) of the test rows."""
    return scored.select("prediction", F.col(label).alias("actual"))


def evaluate_predictions(scored: DataFrame, label: str) -> dict:
    """Accuracy, and the ROC-AUC if the test labels have more than one class."""
    metrics = {"accuracy": accuracy(scored, "prediction", label).first()["accuracy"]}
    area = roc_auc(scored, "probability", label).first()["roc_auc"]
    if area is not None:
        metrics["roc_auc"] = area
    return metrics


def train(
    df: DataFrame,
    features: FeatureConfig = FeatureConfig(),
    model: ModelConfig = ModelConfig(),
    training: TrainingConfig = TrainingConfig(),
) -> Trained:
    """Fit on the training part and measure on the test part.

    ``df`` is read several times and should be a stored table.
    """
    shared_folder(df.sparkSession)  # where the forest cuts its lineage
    # Stored once: the fit reads the training part many times.
    split = hand_over(training_rows(df, features, training), "split", partition_by="in_test")
    rows = split.read(df.sparkSession)
    fitted = fit_model(rows.filter(~F.col("in_test")), features, model)
    tested = predict(fitted, spread_rows(rows.filter("in_test")))
    scored = hand_over(tested, "validation").read(df.sparkSession)
    metrics = evaluate_predictions(scored, features.label)
    return Trained(fitted, scored, metrics)
