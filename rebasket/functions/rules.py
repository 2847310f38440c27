"""The rule scorer as column algebra: signals, prediction, reasons, texts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: thresholds, defaults and texts of the scorer ---

REPEAT_RATE = 0.5
ACTIVE_ORDERS = 5
ACTIVE_DAYS = 14
EARLY_POSITION = 5

DEFAULT_RATE = 0
DEFAULT_ORDERS = 0
DEFAULT_DAYS = 999
DEFAULT_POSITION = 999

POSITIVE_LABEL = "likely_reordered"
NEGATIVE_LABEL = "not_likely_reordered"

REASONS = {
    "likely_repeat_item": "product has a strong historical reorder rate",
    "active_customer": "customer has enough order history and recent activity",
    "high_intent_cart_position": "product appears early in the cart",
}
NO_REASON = "signals are not strong enough for a reorder"
REASON_SEPARATOR = ", "

HIGH_CONFIDENCE = "high"
MEDIUM_CONFIDENCE = "medium"
HIGH_CONFIDENCE_REASONS = 2

MODEL_CONFIDENCE = "model_score"
MODEL_REASON = "Generated by the MLflow model registered for retail reorder prediction."
RULE_MODE = "demo"

BUSINESS_NOTE = (
    "Business interpretation: this helps a retailer decide which products to recommend, "
    "prioritize, or monitor for reorder behavior. In a production version, this answer "
    "can be generated with RAG over feature definitions, MLflow metrics, model cards, "
    "and monitoring reports."
)
# ``{dataset}`` is the name of the data the caller works on.
GENERIC_ANSWER = (
    "This project predicts {dataset}-style product reorders using a modular ML pipeline. "
    "GenAI is useful as an assistant layer: it can explain predictions, summarize "
    "monitoring results, answer questions about features, and help a business user "
    "understand why retraining may be needed."
)
# --- end of fixed values ---

SIGNALS = tuple(REASONS)


def or_default(value: Column, default: float) -> Column:
    """``value`` as a double; null and zero become ``default``, NaN stays."""
    number = value.cast("double")
    return F.when(number.isNull() | (number == 0), F.lit(float(default))).otherwise(number)


def _at_least(value: Column, bound: float) -> Column:
    # Spark sorts NaN above every number; no bound counts as reached by NaN.
    return (value >= bound) & ~F.isnan(value)


def signals() -> dict[str, Column]:
    """The three boolean signals, by name."""
    rate = or_default(F.col("product_reorder_rate"), DEFAULT_RATE)
    orders = or_default(F.col("user_order_count"), DEFAULT_ORDERS)
    days = or_default(F.col("days_since_prior_order"), DEFAULT_DAYS)
    position = or_default(F.col("add_to_cart_order"), DEFAULT_POSITION)
    return {
        "likely_repeat_item": _at_least(rate, REPEAT_RATE),
        "active_customer": _at_least(orders, ACTIVE_ORDERS) & (days <= ACTIVE_DAYS),
        "high_intent_cart_position": position <= EARLY_POSITION,
    }


def add_signals(records: DataFrame) -> DataFrame:
    return records.withColumns(signals())


def rule_prediction() -> Column:
    """1 or 0 from the signal columns."""
    repeat, active, early = (F.col(name) for name in SIGNALS)
    return (early | (repeat & active)).cast("int")


def class_label(prediction: Column) -> Column:
    return F.when(prediction == 1, POSITIVE_LABEL).otherwise(NEGATIVE_LABEL)


def rule_reason() -> Column:
    """The triggered reasons in fixed order, or the fallback text."""
    parts = [F.when(F.col(name), F.lit(text)) for name, text in REASONS.items()]
    joined = F.concat_ws(REASON_SEPARATOR, *parts)
    return F.when(joined == "", NO_REASON).otherwise(joined)


def rule_confidence(prediction: Column) -> Column:
    fired = reduce(add, [F.col(name).cast("int") for name in SIGNALS])
    sure = (prediction == 1) & (fired >= HIGH_CONFIDENCE_REASONS)
    return F.when(sure, HIGH_CONFIDENCE).otherwise(MEDIUM_CONFIDENCE)


def score_with_rules(records: DataFrame) -> DataFrame:
    """Add the signals, prediction, label, confidence_hint, reason and mode."""
    return (
        add_signals(records)
        .withColumn("prediction", rule_prediction())
        .withColumns(
            {
                "label": class_label(F.col("prediction")),
                "confidence_hint": rule_confidence(F.col("prediction")),
                "reason": rule_reason(),
                "mode": F.lit(RULE_MODE),
            }
        )
    )


def explanation(
    question: Column, has_context: Column | None = None, dataset: str = "basket"
) -> Column:
    """The answer text for rows scored by ``score_with_rules``.

    A row without context gets the generic answer.  The answer always explains
    the rules, also where a model made the prediction.
    """
    answer = F.concat(
        F.lit("Question: "),
        question,
        F.lit("\nPrediction: "),
        F.col("label"),
        F.lit(" ("),
        F.col("prediction").cast("string"),
        F.lit(").\nReason: "),
        F.col("reason"),
        F.lit(".\n" + BUSINESS_NOTE),
    )
    if has_context is None:
        return answer
    return F.when(has_context, answer).otherwise(GENERIC_ANSWER.format(dataset=dataset))
