from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rebasket.operators import similarity
from rebasket.operators.similarity import text_top_k, top_k_similar

EMBEDDINGS = Path("/root/testdata/sf0.01/embeddings.parquet")


def brute(corpus, queries, k, skip_self=False):
    result = set()
    for qid, q in queries:
        ranked = sorted(
            (sum((a - b) ** 2 for a, b in zip(q, v)), cid)
            for cid, v in corpus
            if not (skip_self and cid == qid)
        )
        result |= {(qid, cid, rank) for rank, (_, cid) in enumerate(ranked[:k], 1)}
    return result


def found(frame):
    return {(r.query_id, r.doc_id, r["rank"]) for r in frame.collect()}


@pytest.fixture(scope="module")
def vectors():
    # Small whole numbers, so that many distances are equal and ties matter.
    rng = np.random.default_rng(5)
    return [(i, [float(x) for x in rng.integers(0, 4, 6)]) for i in range(300)]


@pytest.mark.parametrize("limit", [4096, 7])
@pytest.mark.parametrize("skip_self", [False, True])
def test_both_ways_equal_brute_force(spark, vectors, limit, skip_self, monkeypatch):
    monkeypatch.setattr(similarity, "MAX_SHARD_VALUES", 500)
    corpus = spark.createDataFrame(vectors, "id long, vector array<double>").repartition(5)
    queries = vectors[:40]
    asked = spark.createDataFrame(queries, "id long, vector array<double>")
    got = top_k_similar(corpus, asked, k=4, skip_self=skip_self, max_queries=limit)
    assert found(got) == brute(vectors, queries, 4, skip_self)


def test_copies_of_one_vector_are_ranked_by_id(spark):
    copies = [(i, [1.0, 0.0]) for i in range(50)] + [(99, [0.0, 1.0])]
    frame = spark.createDataFrame(copies, "id long, vector array<float>").repartition(4)
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "id string, vector array<double>")
    assert found(top_k_similar(frame, asked, k=3)) == {("q", 0, 1), ("q", 1, 2), ("q", 2, 3)}


def test_fewer_rows_than_k_and_missing_vectors(spark):
    rows = spark.createDataFrame([(1, [0.0]), (2, None)], "id long, vector array<double>")
    asked = spark.createDataFrame([(7, [3.0]), (8, None)], "id long, vector array<double>")
    assert found(top_k_similar(rows, asked)) == {(7, 1, 1)}
    assert found(top_k_similar(rows, asked.limit(0))) == set()


def test_vectors_of_different_length_are_an_error(spark):
    rows = spark.createDataFrame([(1, [0.0]), (2, [1.0, 2.0])], "id long, vector array<double>")
    asked = spark.createDataFrame([(7, [3.0])], "id long, vector array<double>")
    with pytest.raises(Exception, match="different length"):
        top_k_similar(rows.coalesce(1), asked).collect()


@pytest.mark.skipif(not EMBEDDINGS.exists(), reason="no test data")
def test_known_neighbours(spark):
    stored = spark.read.parquet(str(EMBEDDINGS)).select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    near = top_k_similar(stored, stored.filter("id = 0"), skip_self=True).orderBy("rank")
    assert [r.doc_id for r in near.collect()] == [365, 334, 387, 423]


TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


TEXTS = [
    (1, "red apple green apple"),
    (2, "Green pear"),
    (3, "slow train to the coast"),
    (4, "fast train"),
    (5, ""),
    (6, "the red pear and the green apple"),
]


def test_text_search_equals_brute_force(spark):
    documents = spark.createDataFrame([*TEXTS, (7, None), (8, "Zug-FAHRT 2 zug"), (9, "Straße über 漢字"), (10, "Привет Straße")], "id long, text string")
    questions = spark.createDataFrame([(1, "apple TREE"), (2, "zug"), (3, "unknown"), (4, None), (5, "straße Straße 漢字"), (6, "Привет")], "q long, text string")
    counts = {r["id"]: Counter(re.findall(TERMS, lowered(r["text"]))) for r in documents.collect()}
    asked = {r["q"]: Counter(re.findall(TERMS, lowered(r["text"]))) for r in questions.collect()}

    def weights(found):
        holding = {t: sum(t in c for c in counts.values()) for t in found}
        return {t: n * math.log((len(counts) + 1) / (holding[t] + 1)) for t, n in found.items()}

    want = []
    for q, found in asked.items():
        v = weights(found)
        scored = []
        for i, c in counts.items():
            w = weights(c)
            dot = sum(v[t] * w.get(t, 0) for t in v)
            if dot > 0:
                lengths = math.sqrt(sum(x * x for x in v.values())) * math.sqrt(sum(x * x for x in w.values()))
                scored.append((-round(dot / lengths, 9), i))
        want += [(q, i, k + 1, pytest.approx(-s, abs=2e-9)) for k, (s, i) in enumerate(sorted(scored)[:2])]
    got = text_top_k(documents, questions, "id", "q", k=2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("head", [1, 3, 64])
def test_index_search_equals_the_full_search(spark, tmp_path, head):
    """Several question sets over one index; frequent terms, ties, heads shorter than k."""
    from rebasket.operators.text_index import build_text_index, search_index

    rng = np.random.default_rng(head)
    words = [f"t{k}" for k in range(40)] + ["über", "漢字"]
    weights = 1 / np.arange(1, len(words) + 1)

    def texts(n, most):
        drawn = [rng.choice(words, rng.integers(0, most), p=weights / weights.sum()) for _ in range(n)]
        return [" ".join(d) for d in drawn]

    rows = list(enumerate([*texts(150, 30), *["t0 t1 t5"] * 20, None, "", "!"]))
    documents = spark.createDataFrame(rows, "id long, text string").repartition(3)
    index = build_text_index(documents, str(tmp_path / "index"), "id", head=head, shards=3)
    for most in (3, 12):
        questions = spark.createDataFrame(
            [*enumerate(texts(12, most)), (98, None), (99, "nothing like it")], "q long, text string"
        )
        want = text_top_k(documents, questions, "id", "q", k=3).collect()
        got = search_index(index, questions, "q", k=3).collect()
        key = [(r.query_id, r["rank"], r.doc_id) for r in sorted(want, key=lambda r: (r.query_id, r["rank"]))]
        assert key == [(r.query_id, r["rank"], r.doc_id) for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))]
        scores = {(r.query_id, r.doc_id): r.score for r in want}
        assert all(abs(r.score - scores[r.query_id, r.doc_id]) <= 2e-9 for r in got) and len(want) > 20


def test_index_counts_rows_of_one_id_together(spark, tmp_path):
    """Repeated and absent ids, upper case, bytes that are no UTF-8, and more terms than are sent at once."""
    from rebasket.operators import text_index

    rows = [(1, "Aa b aa"), (1, "aa Ü"), (2, None), (None, "aa q"), (None, "q"), (3, "x9 É漢 x9"), (4, "")]
    texts = spark.createDataFrame(rows, "id long, text string")
    broken = spark.sql("select 5L as id, cast(X'6101FF62' as string) as text")
    many = spark.createDataFrame([(6, " ".join(f"w{k}" for k in range(300)))], "id long, text string")
    documents = texts.unionByName(broken).unionByName(many).coalesce(2)

    def found(frame):
        return sorted((str(r.id), r.term, r.n) for r in frame.collect())

    assert found(text_index._counted(documents, "id", "text")) == found(text_index.term_counts(documents, "id"))


def test_index_search_shuffles_no_pairs(spark, tmp_path):
    """Frequent terms only, so that nearly every document answers every question."""
    from rebasket.operators.text_index import build_text_index, search_index

    texts = [(k, " ".join(f"t{j}" for j in range(12) if (k * 7 + j * j) % 5)) for k in range(400)]
    documents = spark.createDataFrame(texts, "id long, text string").repartition(4)
    questions = spark.createDataFrame([(q, t) for q, t in texts[:50]], "q long, text string")
    index = build_text_index(documents, str(tmp_path / "index"), "id", head=4, shards=3)
    got = search_index(index, questions, "q", k=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Postings are dealt by document; no table of running pairs is joined to the postings again.
    assert "RepartitionByExpression [id" in plan and plan.count("Join Inner") == 1
    want = text_top_k(documents, questions, "id", "q", k=2)
    order = ["query_id", "rank", "doc_id"]
    assert got.select(order).orderBy(order).collect() == want.select(order).orderBy(order).collect()


def test_index_of_nothing(spark, tmp_path):
    from rebasket.operators.text_index import build_text_index, search_index

    empty = spark.createDataFrame([], "id long, text string")
    index = build_text_index(empty, str(tmp_path / "index"), "id")
    asked = spark.createDataFrame([(1, "a")], "q long, text string")
    assert search_index(index, asked, "q").count() == 0


@pytest.mark.parametrize("skip_self", [False, True])
def test_cells_give_the_nearest_rows(spark, vectors, tmp_path, skip_self):
    """Every row as a query, ties, a cell that is dealt over shards, missing vectors."""
    from rebasket.operators.vector_index import build_vector_index, search_cells

    rows = vectors + [(1000 + k, [1.0] * 6) for k in range(60)]
    frame = spark.createDataFrame([*rows, (5000, None)], "id long, vector array<double>").repartition(4)
    index = build_vector_index(frame, str(tmp_path / "index"), cells=7, shard_rows=25)
    assert index.rows(spark).count() == 360 and index.cells(spark).agg(F.max("shards")).first()[0] > 1
    want = brute(rows, rows, 4, skip_self)
    assert found(search_cells(index, frame, skip_self=skip_self, first=1)) == want
    near = found(search_cells(index, frame, skip_self=skip_self, first=3, exact=False))
    assert len({(q, d) for q, d, _ in near} & {(q, d) for q, d, _ in want}) > 0.6 * len(want)
    assert found(search_cells(index, frame, k=400, first=1)) == brute(rows, rows, 400)


def test_cells_of_nothing(spark, tmp_path):
    from rebasket.operators.vector_index import build_vector_index, search_cells

    empty = spark.createDataFrame([(1, None)], "id long, vector array<double>")
    index = build_vector_index(empty, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, [0.0])], "id long, vector array<double>")
    assert search_cells(index, asked).count() == 0
    one = build_vector_index(asked, str(tmp_path / "one"))
    assert found(search_cells(one, asked)) == {(1, 1, 1)} and search_cells(one, empty).count() == 0


def test_blocks_of_distances_do_not_change_the_result(spark, vectors, monkeypatch):
    monkeypatch.setattr(similarity, "MAX_BLOCK_VALUES", 100)
    best = similarity._Best([q for q, _ in vectors[:30]], np.array([v for _, v in vectors[:30]]), 4, True)
    import pyarrow as pa

    best.add(pa.array([i for i, _ in vectors]), np.array([v for _, v in vectors]))
    got = {(best.query_ids[i], doc, rank) for i, f in enumerate(best.found) for rank, (_, doc) in enumerate(f, 1)}
    assert got == brute(vectors, vectors[:30], 4, True)


def test_queries_of_a_cell_are_dealt_over_tasks(spark, vectors, tmp_path, monkeypatch):
    """No task compares more pairs than its share, however many queries visit a cell."""
    from rebasket.operators import vector_index

    rows = vectors + [(1000 + k, [1.0] * 6) for k in range(60)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    index = vector_index.build_vector_index(frame, str(tmp_path / "index"), cells=3, shard_rows=50)
    monkeypatch.setattr(vector_index, "QUERY_ROWS", 16)
    monkeypatch.setattr(vector_index, "TASK_PAIRS", 2000)
    cells = index.cells(spark).collect()
    dealt = vector_index._groups(cells, len(rows), 2000)
    rows_of = {c["cell"]: -(-c["rows"] // c["shards"]) for c in cells}
    assert all(blocks > 1 and rows_of[c] * -(-len(rows) // blocks) <= 2000 for c, _, blocks, _ in dealt)
    assert [first for *_, first in dealt][1:] == np.cumsum([s * b for _, s, b, _ in dealt]).tolist()[:-1]
    found_ = vector_index.search_cells(index, frame, skip_self=True, first=1)
    assert found(found_) == brute(rows, rows, 4, True)


def test_ties_are_kept_in_bounds_and_text_ids_in_order():
    """Very many equal vectors leave k rows per query after each step; ids of any kind are ordered."""
    import pyarrow as pa

    best = similarity._Best(["b", "z"], np.zeros((2, 3)), 4, True)
    for start in range(0, 900, 300):
        best.add(pa.array([f"{k % 7}é{k}" for k in range(start, start + 300)] + ["b", "z"]), np.zeros((302, 3)))
        assert len(best.distance) == 8
    names = sorted({f"{k % 7}é{k}" for k in range(900)})
    assert [[doc for _, doc in f] for f in best.found] == [names[:4], names[:4]]
    assert best.batch(pa.schema([("q", pa.string()), ("d", pa.string()), ("x", pa.float64())])).num_rows == 8
