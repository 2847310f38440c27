"""The jobs from raw files to predictions.  Stages hand over Parquet tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.config import DEFAULT_STAGES, STAGES, FeatureConfig, ModelConfig, TrainingConfig
from rebasket.operators.drift import RETRAIN_STATUS, STABLE_STATUS, check_drift, check_history
from rebasket.operators.features import build_features
from rebasket.operators.joined import build_joined
from rebasket.operators.model import (
    Trained,
    model_result,
    predict,
    train,
    validation_rows,
)
from rebasket.operators.quality import split_scorable, split_valid
from rebasket.session import scratch_removed, spread_rows
from rebasket.sources.files import fingerprint
from rebasket.sources.records import read_records, write_json
from rebasket.sources.runs import (
    METRICS,
    load_model,
    log_metrics,
    log_run,
    read_history,
    read_latest_metrics,
    save_model,
)
from rebasket.sources.tables import (
    MissingTable,
    read_raw_checked,
    read_raw_tables,
    read_table,
    write_csv,
    write_table,
)


@dataclass(frozen=True)
class Job:
    """Where the pipeline reads and writes, and its settings.

    ``raw`` holds the CSV files, ``root`` everything the stages write,
    ``records`` the scoring records of the deployment stage, whose
    ``record_identity`` fields go to the output.
    """

    raw: str
    root: str
    records: str | None = None
    records_are_arrays: bool = False
    record_identity: Sequence[str] = ()
    infer_types: bool = False
    set_aside: bool = False
    stages: Sequence[str] = DEFAULT_STAGES
    features: FeatureConfig = field(default_factory=FeatureConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    training: TrainingConfig = field(default_factory=TrainingConfig)

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"


def ingest(spark: SparkSession, job: Job) -> dict[str, str]:
    """Raw CSV files to Parquet; returns the tables written.

    With ``set_aside``, damaged lines become the table ``rejected`` instead of
    stopping the job.
    """
    if job.set_aside:
        raw, rejected = read_raw_checked(spark, job.raw)
        raw = raw | {"rejected": rejected}
        return {name: write_table(frame, job.table(name)) for name, frame in raw.items()}
    raw = read_raw_tables(spark, job.raw, job.infer_types)
    return {name: write_table(frame, job.table(name)) for name, frame in raw.items()}


def process(spark: SparkSession, job: Job) -> str:
    """Orders, lines and products to the joined table."""
    joined = build_joined(
        orders=read_table(spark, job.table("orders")),
        prior=read_table(spark, job.table("order_products_prior")),
        train=read_table(spark, job.table("order_products_train")),
        products=read_table(spark, job.table("products")),
    )
    return write_table(joined, job.table("joined"))


def engineer(spark: SparkSession, job: Job) -> str:
    """The joined table to the feature table."""
    joined = read_table(spark, job.table("joined"))
    return write_table(build_features(joined, job.features), job.table("features"))


def train_model(spark: SparkSession, job: Job) -> Trained:
    """Fit, measure, save the next model version, log the run."""
    trained = train(
        read_table(spark, job.table("features")), job.features, job.model, job.training
    )
    run_id = uuid.uuid4().hex
    save_model(spark, job.root, job.training.model_name, trained.model, run_id)
    write_csv(
        validation_rows(trained.validation, job.features.label),
        f"{job.predictions}/validation",
    )
    log_run(spark, job.root, run_id, job.training.experiment, job.model.params, trained.metrics)
    log_metrics(spark, job.root, run_id, trained.metrics)
    return trained


def needs_retraining(spark: SparkSession, job: Job) -> bool:
    training, metrics = job.training, read_latest_metrics(spark, job.root)
    drifted = check_drift(metrics, training.target_metric, training.min_metric)
    if not drifted or training.patience <= 1:
        return drifted
    history = read_history(spark, f"{job.root}/metrics", METRICS)
    return check_history(history, training.target_metric, training.min_metric, training.patience)


def evaluate(spark: SparkSession, job: Job) -> str:
    """The status of the last run; it informs and never stops the pipeline."""
    return RETRAIN_STATUS if needs_retraining(spark, job) else STABLE_STATUS


def batch_records(spark: SparkSession, job: Job, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records to score, and those set aside with their ``errors``.

    The model fills absent values, so only records with a value of the wrong kind
    are set aside.  ``strict`` instead stops at any record outside the bounds.
    """
    if job.records is None:
        raise MissingTable("no scoring records given")
    records = read_records(spark, job.records, job.records_are_arrays, job.record_identity)
    return split_valid(records, strict=True) if strict else split_scorable(records)


def score_batch(spark: SparkSession, job: Job, path: str | None = None, strict: bool = False) -> DataFrame:
    """Model scores for a batch of JSON records, with the identity of each."""
    records, _ = batch_records(spark, job, strict)
    model = load_model(spark, job.root, job.training.model_name, path)
    return model_result(predict(model, spread_rows(records)))


def deploy(spark: SparkSession, job: Job) -> str:
    """Scores and set-aside records as JSON, next to each other."""
    _, aside = batch_records(spark, job)
    write_json(aside, f"{job.predictions}/quarantine")
    return write_json(score_batch(spark, job), f"{job.predictions}/latest")


TABLE_STAGES = STAGES[:3]

STAGE_JOBS: dict[str, Callable[[SparkSession, Job], object]] = dict(
    zip(STAGES, (ingest, process, engineer, train_model, evaluate, deploy), strict=True)
)


MANIFEST = "stage string, key string, output string"


def _settings(job: Job, stage: str) -> str:
    """What a stage depends on besides its input tables."""
    ingestion = (job.raw, job.infer_types, job.set_aside)
    training = (job.model, job.training, job.features)
    own = {"ingestion": ingestion, "feature_engineering": (job.features,), "training": training}
    return repr(own.get(stage, ()))


def _key(spark: SparkSession, job: Job, stage: str, before: str) -> str:
    """A hash of the raw files and of the settings of this stage and all before it."""
    read = fingerprint(spark, job.raw) if stage == "ingestion" else ()
    return hashlib.sha256(repr((stage, _settings(job, stage), before, read)).encode()).hexdigest()


def _finished(spark: SparkSession, job: Job, stage: str, key: str) -> dict | None:
    """The manifest of the stage, if it was finished with the same inputs and settings."""
    stored = read_history(spark, f"{job.root}/manifests/{stage}", MANIFEST)
    found = stored.filter(F.col("key") == key).take(1) if stored is not None else []
    return found[0].asDict() if found else None


def run(spark: SparkSession, job: Job, resume: bool = False, clean: bool = False) -> dict[str, object]:
    """Run the stages in order; a misspelt stage is reported before any runs.

    Tables that a stage has finished are described by a manifest.  With ``resume``,
    stages that write tables are skipped as long as raw files, settings and all
    stages before are those of their manifest; their result is None.  Training,
    evaluation and deployment always run.  ``clean`` deletes what the stages handed
    over in the shared folder; then a training's ``validation`` cannot be read any
    more, but its export can.
    """
    unknown = [stage for stage in job.stages if stage not in STAGE_JOBS]
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(unknown)}")
    results: dict[str, object] = {}
    with scratch_removed(spark) if clean else nullcontext():
        key = ""
        for stage in job.stages:
            key = _key(spark, job, stage, key)
            if stage not in TABLE_STAGES:
                results[stage] = STAGE_JOBS[stage](spark, job)
            elif resume and _finished(spark, job, stage, key):
                results[stage] = None
            else:
                results[stage] = STAGE_JOBS[stage](spark, job)
                row = spark.createDataFrame([(stage, key, str(results[stage]))], MANIFEST).coalesce(1)
                row.write.mode("overwrite").parquet(f"{job.root}/manifests/{stage}")
    return results


def retrain_if_drifted(spark: SparkSession, job: Job) -> bool:
    """Run the pipeline if there are no metrics yet or the last run drifted."""
    try:
        due = needs_retraining(spark, job)
    except MissingTable:
        due = True
    if due:
        run(spark, job)
    return due
