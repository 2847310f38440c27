"""Threshold drift over tables of (metric, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.config import DRIFT_METRIC, DRIFT_THRESHOLD

# --- fixed values: status texts ---
RETRAIN_STATUS = "retraining recommended"
STABLE_STATUS = "model stable"
# --- end of fixed values ---


def below_threshold(threshold: float = DRIFT_THRESHOLD) -> Column:
    """Drift means strictly below; equal is fine, and so is NaN."""
    return F.col("value") < F.lit(float(threshold))


def flag_drift(
    metrics: DataFrame, metric: str = DRIFT_METRIC, threshold: float = DRIFT_THRESHOLD
) -> DataFrame:
    """The rows of one metric with ``drift`` and ``status``."""
    return (
        metrics.filter(F.col("metric") == metric)
        .withColumn("drift", below_threshold(threshold))
        .withColumn("status", F.when(F.col("drift"), RETRAIN_STATUS).otherwise(STABLE_STATUS))
    )


def check_drift(
    metrics: DataFrame, metric: str = DRIFT_METRIC, threshold: float = DRIFT_THRESHOLD
) -> bool:
    """Whether the metric of one run lies below the threshold.

    ``metrics`` holds one run, a row per metric; an absent or null metric is an error.
    """
    rows = flag_drift(metrics, metric, threshold).filter(F.col("value").isNotNull()).take(2)
    if not rows:
        raise ValueError(f"metric not found: {metric}")
    if len(rows) > 1:
        raise ValueError(f"more than one value of {metric}: pass the metrics of one run")
    return rows[0]["drift"]


def drift_history(
    history: DataFrame, metric: str = DRIFT_METRIC, threshold: float = DRIFT_THRESHOLD, patience: int = 1
) -> DataFrame:
    """One metric over all runs: run_id, ts, value, change, drift, breaches and retrain.

    ``history`` has run_id, metric, value and ts.  ``change`` is the difference to
    the run before, ``breaches`` how many runs in a row up to this one have
    drifted, ``retrain`` whether they are at least ``patience``.  Runs go by ts,
    then run_id; runs without a value are left out.  A metric has one row per run,
    so its sequence is small next to any data the runs were trained on.
    """
    values = history.filter((F.col("metric") == metric) & F.col("value").isNotNull())
    order = Window.partitionBy("metric").orderBy("ts", "run_id")
    flagged = values.withColumn("drift", below_threshold(threshold)).withColumn(
        "change", F.col("value") - F.lag("value").over(order)
    )
    # Drifted runs in a row share the number of sound runs before them.
    numbered = flagged.withColumn("_sound", F.sum(F.when(F.col("drift"), 0).otherwise(1)).over(order))
    streak = Window.partitionBy("metric", "_sound").orderBy("ts", "run_id")
    breaches = F.sum(F.col("drift").cast("int")).over(streak)
    counted = numbered.withColumn("breaches", breaches)
    return counted.select(
        "run_id", "ts", "value", "change", "drift", "breaches", (F.col("breaches") >= patience).alias("retrain")
    )


def check_history(
    history: DataFrame, metric: str = DRIFT_METRIC, threshold: float = DRIFT_THRESHOLD, patience: int = 1
) -> bool:
    """Whether the last ``patience`` runs have all drifted; a metric without any value is an error."""
    last = drift_history(history, metric, threshold, patience).orderBy(F.desc("ts"), F.desc("run_id")).take(1)
    if not last:
        raise ValueError(f"metric not found: {metric}")
    return last[0]["retrain"]
