from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rebasket.functions.hashing import row_hash
from rebasket.operators.drift import check_drift, flag_drift
from rebasket.operators.sampling import cap_rows, stratified_split, stratum_sizes
from rebasket.operators.statistics import (
    accuracy,
    class_count,
    medians,
    modes,
    roc_auc,
    text_modes,
)


def brute_auc(pairs):
    positives = [s for s, y in pairs if y == 1]
    negatives = [s for s, y in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return won / (len(positives) * len(negatives))


@pytest.mark.parametrize("digits", [1, 3, 12])
def test_auc_equals_all_pairs(spark, digits):
    rng = random.Random(digits)
    pairs = [(round(rng.random(), digits), rng.randint(0, 1)) for _ in range(400)]
    pairs += [(1.0, 1), (1.0, 0), (0.0, 0), (1.5, 1), (-0.5, 1)]
    found = roc_auc(spark.createDataFrame(pairs, "s double, y int"), "s", "y").first()[0]
    assert found == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_of_scores_within_one_cell(spark):
    pairs = [(0.5 + i * 1e-12, int(i % 3 == 0)) for i in range(60)]
    found = roc_auc(spark.createDataFrame(pairs, "s double, y int"), "s", "y").first()[0]
    assert found == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    rows = spark.createDataFrame([(0.2, 1), (0.4, 1)], "s double, y int")
    assert roc_auc(rows, "s", "y").first()[0] is None


def test_accuracy_and_class_count(spark):
    rows = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "p int, y int")
    assert accuracy(rows, "p", "y").first()[0] == 0.75
    assert class_count(rows, "y").first()[0] == 2
    assert class_count(rows.withColumn("y", F.lit(None).cast("int")), "y").first()[0] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 100, 101, 50_000])
def test_median_is_exact(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.gauss(0, 1), float(rng.randint(0, 3)), 1e12]) for _ in range(n)]
    rows = [(v, None) for v in values] + [(None, None), (float("nan"), None)]
    found = medians(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()
    assert [(r["column"], r["median"]) for r in found] == [("a", statistics.median(values))]


def test_median_averages_the_middle_pair(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (10,)], "a int")
    assert medians(rows, ["a"]).first()["median"] == 2.5


def test_mode_takes_the_smaller_value_at_a_tie(spark):
    rows = spark.createDataFrame([(2, "b"), (10, "b"), (2, "a"), (10, "a"), (None, None)], "a int, s string")
    assert modes(rows, ["a"]).first()["mode"] == 2
    assert text_modes(rows, ["s"]).first()["mode"] == "a"


def test_drift_cases(spark):
    def table(**metrics):
        return spark.createDataFrame(list(metrics.items()), "metric string, value double")

    assert check_drift(table(accuracy=0.7), threshold=0.75) is True
    assert check_drift(table(accuracy=0.75), threshold=0.75) is False
    with pytest.raises(ValueError):
        check_drift(table(roc_auc=0.8), metric="accuracy")
    with pytest.raises(ValueError):
        check_drift(table(accuracy=None, roc_auc=0.5))
    status = flag_drift(table(accuracy=0.7)).first()
    assert (status.drift, status.status) == (True, "retraining recommended")


def test_share_of_the_classes():
    assert stratum_sizes({0: 31_210, 1: 28_735}, 11_989) == {0: 6_242, 1: 5_747}
    assert stratum_sizes({0: 8, 1: 7}, 5) == {0: 3, 1: 2}
    assert stratum_sizes({0: 5, 1: 5}, 3) == {0: 2, 1: 1}


@pytest.fixture(scope="module")
def labelled(spark):
    label = F.when(F.col("id") % 3 == 0, 1).otherwise(0)
    return spark.range(5_000).select(
        (F.col("id") % 70).alias("user_id"), F.col("id").alias("line"), label.alias("y")
    )


def test_split_is_exact_repeatable_and_by_class(labelled):
    key = ["user_id", "line"]
    split = stratified_split(labelled, "y", 0.33, key)
    sizes = {(r.y, r.in_test): r["count"] for r in split.groupBy("y", "in_test").count().collect()}
    wanted = stratum_sizes({0: 3_333, 1: 1_667}, 1_650)
    assert sizes == {
        (0, True): wanted[0],
        (1, True): wanted[1],
        (0, False): 3_333 - wanted[0],
        (1, False): 1_667 - wanted[1],
    }
    again = stratified_split(labelled.repartition(7), "y", 0.33, key)
    assert again.filter("in_test").exceptAll(split.filter("in_test")).count() == 0
    other = stratified_split(labelled, "y", 0.33, key, seed=1)
    assert other.filter("in_test").exceptAll(split.filter("in_test")).count() > 0


def test_split_of_a_single_class(labelled):
    ones = labelled.filter("y = 1")
    assert stratified_split(ones, "y", 0.2, ["line"]).filter("in_test").count() == 334


@pytest.mark.parametrize("wanted", [0, 1, 10, 4_999, 5_000, 9_000])
def test_cap_takes_the_first_by_hash(labelled, wanted):
    capped = cap_rows(labelled, wanted, ["user_id", "line"])
    direct = labelled.orderBy(F.md5(F.concat_ws("|", F.lit("42"), "user_id", "line"))).limit(wanted)
    assert sorted(r.line for r in capped.collect()) == sorted(r.line for r in direct.collect())


def test_large_buckets_are_divided(labelled, monkeypatch):
    from rebasket.operators import sampling

    key = ["user_id", "line"]
    direct = stratified_split(labelled, "y", 0.33, key).filter("in_test")
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(sampling, "MAX_RANKED", 3)
    divided = stratified_split(labelled, "y", 0.33, key).filter("in_test")
    assert divided.exceptAll(direct).count() == 0 and divided.count() == direct.count()


def test_no_cap_keeps_the_table(labelled):
    assert cap_rows(labelled, None, ["line"]) is labelled


@pytest.mark.parametrize("ranked", [1_000_000, 3])
def test_repeated_keys_at_the_cut_are_told_apart(labelled, ranked, monkeypatch):
    from rebasket.operators import sampling

    monkeypatch.setattr(sampling, "MAX_RANKED", ranked)
    capped = cap_rows(labelled, 1_001, ["user_id"])
    assert capped.columns == labelled.columns and capped.count() == 1_001
    assert capped.exceptAll(labelled).count() == 0
    again = cap_rows(labelled.repartition(7), 1_001, ["user_id"])
    assert again.exceptAll(capped).count() == 0


def test_rows_alike_are_taken_in_the_wanted_number(spark):
    rows = spark.createDataFrame([(1, "a")] * 100 + [(None, "a")] * 20, "id long, t string")
    assert cap_rows(rows, 15, ["id"]).count() == 15
    assert cap_rows(rows, 110, ["id"]).count() == 110
    split = stratified_split(rows, "t", 0.25, ["id"])
    assert split.filter("in_test").count() == 30 and split.count() == 120


def test_null_labels_are_refused(spark):
    rows = spark.createDataFrame([(k, None if k % 3 == 0 else k % 2) for k in range(103)], "id long, y int")
    with pytest.raises(ValueError, match="35 rows have no y"):
        stratified_split(rows, "y", 0.2, ["id"])


def test_keys_never_read_alike(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), ("a\\|b", "c"), (None, "c"), ("", "c"), ("\\N", "c"), ("c", None)]
    rows = spark.createDataFrame(pairs, "x string, y string")
    assert rows.select(row_hash(1, ["x", "y"]).alias("h")).distinct().count() == len(pairs)


def test_modes_keep_their_type(spark):
    rows = spark.createDataFrame([(v,) for v in (3.0, 3.0, 1.5, 1.5, 1.5, None, float("nan"))], "x double")
    assert modes(rows, ["x"]).collect() == [("x", 1.5)]
    tied = spark.createDataFrame([(2, 0.5), (1, 0.25)], "a int, b double")
    assert {r[0]: r[1] for r in modes(tied, ["a", "b"]).collect()} == {"a": 1.0, "b": 0.25}


def test_narrowed_medians(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(4001)] + [0.25] * 500
    rows = spark.createDataFrame([(v, float(k % 3), None) for k, v in enumerate(values)], "a double, b double, c double")
    want = {"a": statistics.median(values), "b": statistics.median(k % 3 for k in range(len(values)))}
    for few in (100_000, 50, 1):
        assert {r[0]: r[1] for r in medians(rows, ["a", "b", "c"], few).collect()} == pytest.approx(want)


@pytest.mark.parametrize("scale", [1e9, 1e-9, 1.0])
def test_area_does_not_depend_on_the_scale(spark, scale):
    rng = random.Random(3)
    rows = [(rng.choice([rng.random(), 0.5]) * scale, int(rng.random() < 0.3)) for _ in range(3000)]
    pos, neg = ([s for s, y in rows if y == k] for k in (1, 0))
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    frame = spark.createDataFrame([*rows, (math.nan, 1), (None, 0)], "s double, y int")
    assert roc_auc(frame, "s", "y").first()[0] == pytest.approx(want)


@pytest.mark.parametrize("ranked", [1_000_000, 3])
def test_many_classes_are_split_like_few(labelled, monkeypatch, ranked):
    from rebasket.operators import sampling, strata

    monkeypatch.setattr(strata, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(sampling, "MAX_RANKED", ranked)
    key = ["user_id", "line"]
    wide = labelled.withColumn("y", F.when(F.col("line") % 2 == 0, F.lit(0)).otherwise(F.col("line") % 40))
    few = stratified_split(wide, "y", 0.33, key)
    repeated = stratified_split(wide, "y", 0.33, ["user_id"])  # keys that repeat
    monkeypatch.setattr(sampling, "MAX_CLASSES", 1)
    many = stratified_split(wide.repartition(5), "y", 0.33, key)
    assert many.columns == few.columns and many.exceptAll(few).count() == 0 and many.count() == few.count()
    again = stratified_split(wide, "y", 0.33, ["user_id"])
    assert again.exceptAll(repeated).count() == 0 and again.count() == 5_000
    assert stratified_split(wide.limit(0), "y", 0.33, key).count() == 0
    with pytest.raises(ValueError, match="have no y"):
        stratified_split(wide.withColumn("y", F.when(F.col("line") > 5, F.col("y"))), "y", 0.33, key)


def test_shares_of_very_many_rows(spark):
    """Products beyond 64 bits, and many equal remainders: the smaller labels are first."""
    from rebasket.operators.strata import apportion

    sizes = {0: 3 * 10**15 + 1, 1: 10**15, 2: 7} | {k: 1 for k in range(10, 60)}
    wanted = sum(sizes.values()) // 3
    classes = spark.createDataFrame(list(sizes.items()), "label long, n long").repartition(4)
    got = {r.label: r.wanted for r in apportion(classes, wanted).collect()}
    assert got == stratum_sizes(sizes, wanted) and sum(got.values()) == wanted
