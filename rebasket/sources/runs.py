"""The run log, the metrics history and the saved model versions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.sources.files import create_new
from rebasket.sources.tables import MissingTable, _unless_absent

RUNS = "run_id string, experiment string, params map<string,string>, metrics map<string,double>, ts timestamp"
METRICS = "run_id string, metric string, value double, ts timestamp"
VERSIONS = "model string, version int, path string, run_id string, ts timestamp"


def _append(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def log_run(
    spark: SparkSession, root: str, run_id: str, experiment: str, params: dict, metrics: dict
) -> None:
    """Append one run with its parameters and metrics."""
    row = (run_id, experiment, {k: str(v) for k, v in params.items()}, metrics, _now())
    _append(spark, f"{root}/runs", row, RUNS)


def log_metrics(spark: SparkSession, root: str, run_id: str, metrics: dict) -> None:
    """Append one row per metric, so drift can be followed over all runs."""
    stamp = _now()
    rows = [(run_id, name, float(value), stamp) for name, value in metrics.items()]
    table = spark.createDataFrame(rows, METRICS).coalesce(1)
    table.write.mode("append").parquet(f"{root}/metrics")


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return _unless_absent(lambda: spark.read.schema(schema).parquet(path))


def latest_metrics(history: DataFrame) -> DataFrame:
    """The (metric, value) rows of the last run."""
    stamped = history.select("run_id", "ts").agg(F.max_by("run_id", "ts").alias("run_id"))
    return history.join(stamped, "run_id").select("metric", "value")


def read_latest_metrics(spark: SparkSession, root: str) -> DataFrame:
    history = read_history(spark, f"{root}/metrics", METRICS)
    if history is None:
        raise MissingTable(f"missing metrics: {root}/metrics")
    return latest_metrics(history)


def read_metrics_document(spark: SparkSession, path: str) -> DataFrame:
    """Import a JSON document ``{metric: value, ...}`` as (metric, value) rows."""
    document = _unless_absent(
        lambda: spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    )
    if document is None:
        raise MissingTable(f"missing metrics: {path}")
    names = document.columns
    if not names:
        return spark.createDataFrame([], "metric string, value double")
    values = [F.col(f"`{n}`").cast("double").alias(n) for n in names]
    return document.select(values).unpivot([], names, "metric", "value")


def latest_by_version(table: DataFrame, name: str, version: str, value: str) -> DataFrame:
    """Per name, the value that belongs to the highest version."""
    return table.groupBy(name).agg(
        F.max(version).alias(version), F.max_by(value, version).alias(value)
    )


def _claim(spark: SparkSession, root: str, name: str, version: int) -> int:
    """The first version from this one on that no run has claimed; it is this run's from now on."""
    while not create_new(spark, f"{root}/claims/{name}/version-{version}"):
        version += 1
    return version


def save_model(spark: SparkSession, root: str, name: str, model: PipelineModel, run_id: str) -> str:
    """Save the model as the next version and record where it is.

    Versions are claimed before the model is written, so runs at the same time get
    different ones.
    """
    known = read_history(spark, f"{root}/versions", VERSIONS)
    last = 0
    if known is not None:
        last = known.filter(F.col("model") == name).agg(F.max("version")).first()[0] or 0
    version = _claim(spark, root, name, last + 1)
    path = f"{root}/models/{name}/version={version}-{run_id}"
    model.save(path)
    # The row publishes the version: a run that stops before leaves a claim only.
    _append(spark, f"{root}/versions", (name, version, path, run_id, _now()), VERSIONS)
    return path


def latest_model_path(spark: SparkSession, root: str, name: str) -> str:
    known = read_history(spark, f"{root}/versions", VERSIONS)
    row = None
    if known is not None:
        mine = known.filter(F.col("model") == name)
        row = latest_by_version(mine, "model", "version", "path").first()
    if row is None:
        raise MissingTable(f"no saved version of model {name} below {root}")
    return row["path"]


def load_model(spark: SparkSession, root: str, name: str, path: str | None = None) -> PipelineModel:
    """The model at ``path``, or the latest version of ``name``."""
    return PipelineModel.load(path or latest_model_path(spark, root, name))
