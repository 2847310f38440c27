from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rebasket.functions.rules import NO_REASON, SIGNALS, explanation, or_default, score_with_rules
from rebasket.operators.quality import InvalidRecords, split_valid, validate, violations
from rebasket.schemas import RECORD, RECORD_FIELDS, RECORD_TEXT

NAN = float("nan")

CASES = [
    # rate, orders, days, cart -> prediction, signals, confidence
    ((0.6, 5, 7.0, 1), 1, (True, True, True), "high"),
    ((0.6, 5, 0.0, 6), 0, (True, False, False), "medium"),
    ((0.6, 5, 14.0, 6), 1, (True, True, False), "high"),
    ((0.4, 5, 14.0, 6), 0, (False, True, False), "medium"),
    ((0.5, 4, 3.0, 6), 0, (True, False, False), "medium"),
    ((None, None, None, None), 0, (False, False, False), "medium"),
    ((0.0, 9, 0.5, 5), 1, (False, True, True), "high"),
    ((0.1, 1, 3.0, 5), 1, (False, False, True), "medium"),
    ((NAN, 9, NAN, 9), 0, (False, False, False), "medium"),
]


@pytest.fixture(scope="module")
def scored(spark):
    schema = (
        "product_reorder_rate double, user_order_count int, days_since_prior_order double, "
        "add_to_cart_order int, n int"
    )
    rows = spark.createDataFrame([(*case[0], i) for i, case in enumerate(CASES)], schema)
    return score_with_rules(rows).orderBy("n")


def test_rule_cases(scored):
    for row, (_, prediction, fired, confidence) in zip(scored.collect(), CASES, strict=True):
        assert row.prediction == prediction
        assert tuple(row[s] for s in SIGNALS) == fired
        assert row.confidence_hint == confidence
        assert row.label == ("likely_reordered" if prediction else "not_likely_reordered")


def test_reasons_keep_their_order(scored):
    reasons = [row.reason for row in scored.collect()]
    assert reasons[0] == (
        "product has a strong historical reorder rate, "
        "customer has enough order history and recent activity, "
        "product appears early in the cart"
    )
    assert reasons[5] == NO_REASON


def test_zero_and_null_become_the_default(spark):
    rows = spark.createDataFrame([(0.0,), (None,), (3.0,), (NAN,)], "x double")
    values = [r[0] for r in rows.select(or_default(F.col("x"), 999)).collect()]
    assert values[:3] == [999.0, 999.0, 3.0] and values[3] != values[3]


def test_explanation_with_and_without_context(scored):
    rows = scored.select(
        explanation(F.lit("Why?"), F.col("n") > 0, dataset="grocery").alias("text")
    ).collect()
    assert "grocery-style product reorders" in rows[0].text
    assert rows[2].text.startswith(
        "Question: Why?\nPrediction: likely_reordered (1).\nReason: product has a strong "
        "historical reorder rate, customer has enough order history and recent activity.\n"
        "Business interpretation: "
    )


GOOD = {
    "order_number": 3,
    "order_dow": 1,
    "order_hour_of_day": 10,
    "days_since_prior_order": 7.0,
    "add_to_cart_order": 1,
    "user_order_count": 5,
    "product_order_count": 100,
    "product_reorder_rate": 0.6,
    "aisle_id": 24,
    "department_id": 4,
}


def record(**changes):
    values = {**GOOD, **changes}
    return tuple(values[f.name] for f in RECORD_FIELDS)


def bad_fields(spark, *records, schema=RECORD):
    checked = validate(spark.createDataFrame(list(records), schema))
    return [[e.field for e in row.errors] for row in checked.collect()]


def test_bounds_are_inclusive_and_one_step_outside_fails(spark):
    inside, outside, names = [], [], []
    for f in RECORD_FIELDS:
        step = 1 if f.whole else 0.001
        for bound, sign in ((f.low, -1), (f.high, 1)):
            if bound is None:
                continue
            number = int(bound) if f.whole else float(bound)
            inside.append(record(**{f.name: number}))
            outside.append(record(**{f.name: number + sign * step}))
            names.append([f.name])
    assert bad_fields(spark, *inside) == [[]] * len(inside)
    assert bad_fields(spark, *outside) == names


def test_null_is_a_violation_in_every_field(spark):
    assert bad_fields(spark, *[record(**{f.name: None}) for f in RECORD_FIELDS]) == [
        [f.name] for f in RECORD_FIELDS
    ]


def test_nan_and_infinity(spark):
    rows = [
        record(days_since_prior_order=NAN),
        record(product_reorder_rate=NAN),
        record(days_since_prior_order=float("inf")),
        record(order_number=-5),
    ]
    found = bad_fields(spark, *rows)
    assert found == [["days_since_prior_order"], ["product_reorder_rate"], [], []]


def test_text_values_are_typed(spark):
    def text(**changes):
        return tuple(None if v is None else str(v) for v in record(**changes))

    rows = [
        text(order_dow="3.0"),
        text(order_dow="3.5"),
        text(order_dow="x"),
        text(order_number="9007199254740993"),
        text(days_since_prior_order="soon"),
        text(order_dow="NaN", aisle_id="Infinity"),
    ]
    frame = spark.createDataFrame(rows, RECORD_TEXT)
    found = [[e.field for e in r.errors] for r in validate(frame).collect()]
    assert found == [
        [],
        ["order_dow"],
        ["order_dow"],
        [],
        ["days_since_prior_order"],
        ["order_dow", "aisle_id"],
    ]
    good, bad = split_valid(frame)
    assert good.schema["order_dow"].dataType.simpleString() == "bigint"
    assert sorted(r.order_number for r in good.collect()) == [3, 9007199254740993]
    assert bad.count() == 4


def test_report_and_strict_mode(spark):
    frame = spark.createDataFrame(
        [record(), record(order_dow=9, aisle_id=0)], RECORD
    ).withColumn("n", F.monotonically_increasing_id())
    report = violations(frame, ["n"]).collect()
    assert sorted(r.field for r in report) == ["aisle_id", "order_dow"]
    assert all(r.message for r in report)
    with pytest.raises(InvalidRecords):
        split_valid(frame, strict=True)
    with pytest.raises(InvalidRecords):
        split_valid(frame.limit(0), strict=True)
    good, _ = split_valid(frame.filter("order_dow < 9"), strict=True)
    assert good.count() == 1
