from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rebasket.operators import forest
from rebasket.operators.forest import Layout, grow, looked_at, scores
from rebasket.operators.model import assembler, encoder, layout


@pytest.fixture(scope="module")
def rows(spark):
    """Two numbers, of 100 and of 3 values, and a one-hot column of 3; the label follows the first and the third."""
    ids = spark.range(3_000)
    many, few, kind = (F.col("id") * 37 % 100) / 10, F.col("id") % 3, F.col("id") % 7 % 3
    vector = F.array(many, few.cast("double"), *[(kind == k).cast("double") for k in range(3)])
    label = ((many >= 5) != (kind == 1)) != (F.col("id") % 17 == 0)
    return ids.select("id", array_to_vector(vector).alias("features"), label.cast("int").alias("reordered")).localCheckpoint()


def of(**params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="reordered", featuresCol="features", **params)


def scored(model, rows):
    found = rows.select("id", "reordered", scores([model], F.col("features")).alias("s"))
    return sorted(found.select("id", "reordered", "s.*").collect())


def test_scores_are_those_of_spark(rows):
    """The arrays of a model give what Spark's own scoring of the same model gives."""
    for model in (grow(rows, [of(numTrees=9, maxDepth=5, seed=3)], Layout(2, (3,)))[0], of(numTrees=9, seed=3).fit(rows).copy()):
        plain = model.transform(rows).select("id", "prediction", vector_to_array("probability")[1].alias("p"))
        expected = {r.id: (int(r.prediction), r.p) for r in plain.collect()}
        for row in scored(model, rows):
            assert row.prediction == expected[row.id][0] and abs(row.probability - expected[row.id][1]) < 1e-12


def test_a_tree_of_all_rows_is_sparks_tree(rows):
    """Without samples and with all features looked at nothing is drawn, so both trees have the same rows in their nodes."""
    params = dict(numTrees=1, maxDepth=4, bootstrap=False, featureSubsetStrategy="all", seed=1)
    plain, own = of(**params).fit(rows), grow(rows, [of(**params)], Layout(2, (3,)))[0]
    assert own.totalNumNodes == plain.totalNumNodes
    expected = {r.id: r.p for r in plain.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert all(abs(row.probability - expected[row.id]) < 1e-12 for row in scored(own, rows))


def test_passes_and_blocks_do_not_matter(rows, monkeypatch):
    params = dict(numTrees=4, maxDepth=5, bootstrap=False, seed=5)
    whole = scored(grow(rows, [of(**params)], Layout(2, (3,)))[0], rows)
    monkeypatch.setattr(forest, "PASS_CELLS", 1_000)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(forest, "MATRIX_CELLS", 500)
    assert scored(grow(rows, [of(**params)], Layout(2, (3,)))[0], rows) == whole


def test_nothing_is_kept_per_row_and_tree(rows):
    """Blocks hold a code per column and a label; the forest of Spark's kept counts and nodes of every tree."""
    stored, _ = forest._packed(rows, "reordered", Layout(2, (3,)), [np.arange(31.0), np.arange(2.0)])
    sizes = stored.agg(F.sum(F.octet_length("codes") + F.octet_length("labels"))).first()[0]
    assert sizes == 3_000 * (3 * 2 + 4)


def test_samples_are_drawn_with_replacement():
    times = forest._times(1.0, True)
    shares = np.bincount(times, minlength=4)[:4] / len(times)
    assert np.allclose(shares, [np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], atol=1e-4)
    at, n = forest._sample(times, (-7, 0, 1, 2), 10_001)
    assert 9_500 < n.sum() < 10_500 and n.min() == 1
    again = forest._sample(times, (-7, 0, 1, 2), 10_001)
    assert (at == again[0]).all() and (n == again[1]).all()
    others = [(-7, 1, 1, 2), (-7, 0, 2, 2), (-7, 0, 1, 3), (-6, 0, 1, 2)]
    assert all(len(at) != len(o) or (at != o).any() for o, _ in (forest._sample(times, k, 10_001) for k in others))
    assert forest._times(1.0, False) is None and abs(forest._times(0.3, False).mean() - 0.3) < 1e-4


def test_sparse_and_dense_vectors_are_unpacked():
    kind = pa.struct(
        {"type": pa.int8(), "size": pa.int32(), "indices": pa.list_(pa.int32()), "values": pa.list_(pa.float64())}
    )
    rows = [
        {"type": 1, "size": None, "indices": None, "values": [1.5, 0.0, 0.0, 1.0]},
        {"type": 0, "size": 4, "indices": [0], "values": [2.5]},
        {"type": 0, "size": 4, "indices": [2], "values": [1.0]},
    ]
    vectors = pa.array([rows[1], *rows], kind).slice(1)
    assert forest._numbers(vectors, Layout(1, (2, 1))).tolist() == [[1.5, 2.5, 0.0]]
    assert forest._hot(vectors, Layout(1, (2, 1))).tolist() == [[2, 2, 1], [0, 1, 1]]


def test_layout_follows_the_stages(spark):
    seen = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "c string, n double")
    stages = Pipeline(stages=[*encoder(["c"]), assembler(["n"], ["c"])]).fit(seen).stages
    assert layout(stages) == Layout(1, (3,))


def test_looked_at_as_spark():
    assert [looked_at(s, 39, 100) for s in ("auto", "all", "sqrt", "log2", "onethird", "5", "0.5", "1.0")] == [7, 39, 7, 6, 13, 5, 20, 39]
    assert looked_at("auto", 39, 1) == 39 and looked_at("50", 39, 9) == 39


def test_odd_labels_are_refused(rows):
    for bad in (F.lit(None).cast("int"), F.lit(-1)):
        with pytest.raises(ValueError, match="labels"):
            grow(rows.withColumn("reordered", bad), [of(numTrees=2)], Layout(2, (3,)))
    with pytest.raises(ValueError, match="no rows"):
        grow(rows.filter("id < 0"), [of(numTrees=2)], Layout(2, (3,)))
