"""Settings of the jobs.  Every value can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: column lists, model parameters, thresholds, stage names ---

KEY_COLUMNS = ("user_id", "product_id")

NUMERIC_COLUMNS = (
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "add_to_cart_order",
    "user_order_count",
    "product_order_count",
    "product_reorder_rate",
)

CATEGORICAL_COLUMNS = ("aisle_id", "department_id")

LABEL_COLUMN = "reordered"

RANDOM_FOREST_PARAMS = {"n_estimators": 100, "max_depth": 10, "random_state": 42}

STAGES = (
    "ingestion",
    "processing",
    "feature_engineering",
    "training",
    "evaluation",
    "deployment",
)

# The stages of a plain run: scoring a batch ("deployment") is asked for by name.
DEFAULT_STAGES = STAGES[:5]

DRIFT_METRIC = "accuracy"
DRIFT_THRESHOLD = 0.75

# --- end of fixed values ---


@dataclass(frozen=True)
class FeatureConfig:
    """Which columns the feature table carries, in output order."""

    numeric: tuple[str, ...] = NUMERIC_COLUMNS
    categorical: tuple[str, ...] = CATEGORICAL_COLUMNS
    label: str = LABEL_COLUMN
    keys: tuple[str, ...] = KEY_COLUMNS

    @property
    def output_columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.numeric, *self.categorical, self.label)


@dataclass(frozen=True)
class ModelConfig:
    kind: str = "random_forest"
    params: dict = field(default_factory=lambda: dict(RANDOM_FOREST_PARAMS))


@dataclass(frozen=True)
class TrainingConfig:
    """Training settings.

    ``max_rows=None`` trains on the whole table.  A number keeps that many rows,
    chosen by hash (see ``operators.sampling.cap_rows``).  ``row_key`` must
    identify a feature row: it feeds the hashes of the cap and of the split.
    ``patience`` is how many runs in a row have to drift before a new training.
    """

    test_size: float = 0.2
    seed: int = 42
    experiment: str = "reorder"
    model_name: str = "reorder_model"
    max_rows: int | None = None
    target_metric: str = DRIFT_METRIC
    min_metric: float = DRIFT_THRESHOLD
    patience: int = 1
    row_key: tuple[str, ...] = ("user_id", "order_number", "product_id")


# The two published parameter sets, both with a row cap.
FULL_TRAINING = TrainingConfig(max_rows=100_000)
DEMO_TRAINING = TrainingConfig(
    test_size=0.33, experiment="reorder-demo", max_rows=1_000, min_metric=0.65
)
