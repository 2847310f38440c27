"""Exact top-k nearest neighbours by Euclidean distance.

``corpus`` and ``queries`` are tables of an id and a vector.  Queries that fit
a checked bound travel to the corpus: each task keeps the k best rows it has
seen per query, so a corpus of any size is read once, nothing is shuffled but
k rows per query and task, and no pair table exists.  More queries than that
are joined in bounded blocks.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from rebasket.session import hand_over

MAX_QUERY_ROWS = 4096
MAX_QUERY_VALUES = 8_000_000  # 64 MB of doubles
MAX_SHARD_VALUES = 16_000_000
MAX_BLOCK_VALUES = 2_000_000  # distances that a task holds at once
MEASURED_ROWS = 16_384  # pairs that are measured exactly at once

# Task functions travel by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A column of equally long number lists as a matrix of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = np.unique(np.diff(vectors.offsets.to_numpy(zero_copy_only=False)))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different length: {lengths.tolist()}")
    return flat.reshape(len(vectors), -1)


def _squares(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors, vectors)


class _Best:
    """The k nearest rows per query over the batches of a task; ties go to the lower id.

    Rough distances of a block come from one matrix product and carry rounding
    error; everything within a safe margin of the k-th distance known so far is
    measured again exactly.  All queries of a block are treated at once.
    """

    def __init__(self, query_ids: list, queries: np.ndarray, k: int, skip_self: bool):
        self.query_ids, self.queries, self.k, self.skip_self = query_ids, queries, k, skip_self
        self.kth = np.full(len(query_ids), np.inf)
        # Of every row held: its query, its exact distance and its id, by query and then in order.
        self.query = np.zeros(0, np.int64)
        self.distance = np.zeros(0)
        self.doc: pa.Array | None = None
        if query_ids:
            self.lengths = _squares(queries)
            largest = np.abs(queries).max(axis=1, initial=0.0) if queries.size else np.zeros(len(query_ids))
            self.scale = 1.0 + largest**2 * queries.shape[1]
            self.left = np.column_stack((-2.0 * queries, np.ones(len(queries))))

    def add(self, ids: pa.Array, docs: np.ndarray) -> None:
        if not self.query_ids:
            return
        # Bounded blocks of rows: the distances of one block are all that is held.
        step = max(1, MAX_BLOCK_VALUES // len(self.query_ids))
        for start in range(0, len(docs), step):
            self._add(ids.slice(start, step), docs[start : start + step])

    def _add(self, ids: pa.Array, docs: np.ndarray) -> None:
        # Without the square of the query, which is the same for all rows.
        rough = self.left @ np.column_stack((docs, _squares(docs))).T
        wanted = self.k + self.skip_self
        limit = np.where(np.isinf(self.kth), np.inf, self.kth - self.lengths)
        open_ = np.flatnonzero(np.isinf(self.kth))
        every = np.zeros(len(self.kth), bool)
        if len(docs) <= wanted:
            every[open_] = True
        elif len(open_):
            limit[open_] = np.partition(rough[open_], wanted - 1, axis=1)[:, wanted - 1]
        limit += 1e-9 * (self.scale + np.abs(limit + self.lengths))
        near = rough <= limit[:, None]
        near[every] = True
        flat = np.flatnonzero(near)
        for start in range(0, len(flat), MEASURED_ROWS):
            query, row = np.divmod(flat[start : start + MEASURED_ROWS], len(docs))
            difference = docs[row] - self.queries[query]
            self._keep(query, _squares(difference), ids.take(pa.array(row)))

    def _keep(self, query: np.ndarray, distance: np.ndarray, ids: pa.Array) -> None:
        inside = ~(distance > self.kth[query])
        if self.skip_self:
            own = [self.query_ids[q] for q in query.tolist()]
            inside &= np.fromiter((a != b for a, b in zip(ids.to_pylist(), own)), bool, len(own))
        if not inside.any():
            return
        ids = ids.filter(pa.array(inside))
        query = np.concatenate((self.query, query[inside]))
        distance = np.concatenate((self.distance, distance[inside]))
        doc = ids if self.doc is None else pa.concat_arrays([self.doc, ids])
        place = pc.rank(doc, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
        order = np.lexsort((place, distance, query))
        query = query[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
        kept = rank < self.k
        order = order[kept]
        self.query, self.distance, self.doc = query[kept], distance[order], doc.take(pa.array(order))
        last = rank[kept] == self.k - 1
        self.kth[self.query[last]] = self.distance[last]

    @property
    def found(self) -> list[list[tuple]]:
        """(distance, id) of the rows held, per query."""
        rows: list[list[tuple]] = [[] for _ in self.query_ids]
        for query, distance, doc in zip(self.query.tolist(), self.distance.tolist(), self.doc.to_pylist() if self.doc is not None else []):
            rows[query].append((distance, doc))
        return rows

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        if self.doc is None:
            return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        asked = pa.array(self.query_ids, schema.field(0).type).take(pa.array(self.query))
        columns = [asked, self.doc.cast(schema.field(1).type), pa.array(self.distance)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _rank(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _output_schema(corpus: DataFrame, queries: DataFrame) -> StructType:
    return StructType(
        [
            StructField("query_id", queries.schema["id"].dataType),
            StructField("doc_id", corpus.schema["id"].dataType),
            StructField("distance", DoubleType()),
        ]
    )


def _by_broadcast(corpus: DataFrame, queries: DataFrame, k: int, skip_self: bool) -> DataFrame:
    rows = queries.collect()  # bounded: the caller has counted them
    query_ids = [row["id"] for row in rows]
    matrix = np.array([row["vector"] for row in rows], dtype=np.float64)
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, matrix))
    schema = _output_schema(corpus, queries)

    arrow = to_arrow_schema(schema)

    def search(batches):
        best = _Best(*shared.value, k, skip_self)
        for batch in batches:
            best.add(batch.column(0), _matrix(batch.column(1)))
        yield best.batch(arrow)

    return corpus.mapInArrow(search, schema)


def _by_blocks(
    corpus: DataFrame, queries: DataFrame, k: int, skip_self: bool, blocks: int, width: int
) -> DataFrame:
    """Blocks of queries against shards of the corpus; both sides of a group are bounded.

    A corpus row is copied once per query block and a query once per shard; each
    group of a block and a shard yields at most k rows per query.
    """
    shards = math.ceil(max(corpus.count(), 1) * width / MAX_SHARD_VALUES)
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    docs = corpus.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    docs = docs.withColumn("block", every_block)
    asked = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", every_shard)
    schema = _output_schema(corpus, queries)
    arrow = to_arrow_schema(schema)

    def search(doc_table: pa.Table, query_table: pa.Table) -> pa.Table:
        if not len(doc_table) or not len(query_table):
            return arrow.empty_table()

        def vectors(table: pa.Table) -> np.ndarray:
            return _matrix(table.column("vector").combine_chunks())

        best = _Best(query_table.column("id").to_pylist(), vectors(query_table), k, skip_self)
        best.add(doc_table.column("id").combine_chunks(), vectors(doc_table))
        return pa.Table.from_batches([best.batch(arrow)])

    return (
        docs.groupBy("block", "shard")
        .cogroup(asked.groupBy("block", "shard"))
        .applyInArrow(search, schema)
    )


def top_k_similar(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    skip_self: bool = False,
    max_queries: int = MAX_QUERY_ROWS,
) -> DataFrame:
    """The ``k`` corpus rows nearest to each query: (query_id, doc_id, distance, rank).

    Both tables have the columns ``id`` (unique) and ``vector``.  ``distance``
    is the squared Euclidean distance; ties go to the lower id.  ``skip_self``
    leaves out the corpus row that has the id of the query.  Rows without a
    vector take no part.
    """
    corpus, queries = (
        df.filter(F.col("vector").isNotNull()).select(
            "id", F.col("vector").cast("array<double>").alias("vector")
        )
        for df in (corpus, queries)
    )
    size = queries.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    width = max(size["width"] or 1, 1)
    blocks = math.ceil(size["rows"] / min(max_queries, max(1, MAX_QUERY_VALUES // width)))
    if blocks <= 1:
        candidates = _by_broadcast(corpus, queries, k, skip_self)
    else:
        candidates = _by_blocks(corpus, queries, k, skip_self, blocks, width)
    return _rank(candidates, k)


def centroids(vectors: DataFrame, group: str, width: int) -> DataFrame:
    """The mean vector per group, as (id, vector); a partial aggregate per position."""
    means = [F.avg(F.col("vector")[i].cast("double")) for i in range(width)]
    return vectors.groupBy(F.col(group).alias("id")).agg(F.array(*means).alias("vector"))


# --- text ---


TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def term_counts(texts: DataFrame, id_column: str, text_column: str = "text") -> DataFrame:
    """(id, term, n): how often each text has each term; A-Z are lower-cased.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
    """
    lower = F.translate(text_column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))
    return (
        texts.select(F.col(id_column).alias("id"), F.explode(terms).alias("term"))
        .groupBy("id", "term")
        .agg(F.count("*").alias("n"))
    )


def text_top_k(
    documents: DataFrame, questions: DataFrame, id_column: str, question_id: str, k: int = 4, digits: int = 9
) -> DataFrame:
    """(query_id, doc_id, rank, score): the ``k`` documents whose terms are closest to each question.

    Terms are kept as they are and sparse.  A term weighs its count times
    ln((documents + 1) / (documents with it + 1)); the score is the cosine of the
    weights, rounded to ``digits``, ties go to the smaller id.  Scores are summed
    over the terms of a question only, and documents without any of them are no
    answer.  Terms are joined, so the postings of a frequent term are dealt over
    many tasks by Spark's skew handling.
    """
    spark = documents.sparkSession
    counts = hand_over(term_counts(documents, id_column), "terms").read(spark)
    total = documents.count()
    holding = counts.groupBy("term").agg(F.count("*").alias("holding"))
    rarity = F.log((F.lit(total) + 1.0) / (F.coalesce("holding", F.lit(0)) + 1.0))

    def weighed(found: DataFrame) -> DataFrame:
        return found.join(holding, "term", "left").select("id", "term", (F.col("n") * rarity).alias("w"))

    def lengths(weights: DataFrame) -> DataFrame:
        return weights.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))

    docs = hand_over(weighed(counts), "weights").read(spark)
    # Stored, the questions have a known size: as long as they are small, Spark sends
    # them to the documents' terms instead of shuffling those once more.
    asked = hand_over(weighed(term_counts(questions, question_id)), "question-weights").read(spark)
    # Dealt by document, the terms that are asked for make whole scores in one task: the
    # pairs of questions and documents, of which there are far more, are not shuffled.
    held = docs.join(asked.select("term").distinct(), "term", "left_semi").repartition("id")
    pairs = held.select(F.col("id").alias("doc_id"), "term", "w").join(
        asked.select(F.col("id").alias("query_id"), "term", F.col("w").alias("v")), "term"
    )
    sums = pairs.groupBy("query_id", "doc_id").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    of_doc = lengths(docs).select(F.col("id").alias("doc_id"), F.col("length").alias("doc_length"))
    of_query = lengths(asked).select(F.col("id").alias("query_id"), F.col("length").alias("query_length"))
    scored = (
        sums.filter("dot > 0")
        .join(of_doc, "doc_id")
        .join(of_query, "query_id")
        .withColumn("score", F.round(F.col("dot") / (F.col("doc_length") * F.col("query_length")), digits))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "doc_id", F.col("rank").cast("int").alias("rank"), "score")
