"""Exact top-k inner products by ball trees, one per shard (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.session import hand_over

LEAF_ROWS = 64
SHARD_ROWS = 8192
QUERY_BLOCK = 4096
"""Queries that go to all shards together; the only thing that is broadcast."""
NONE = np.iinfo(np.int64).min
SEED_ROWS = 512
"""Vectors that give every query a first kth score."""


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and ``v``: floor(256 * x) of every component, of rows that can take part.

    Rows without id or vector, without components, or with a null or non-finite
    component do not.
    """

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * 256
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    made = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", whole).alias("v"),
        F.forall("embedding", finite).alias("fine"),
    )
    usable = F.col("fine") & (F.size("v") > 0) & F.col("vec_id").isNotNull()
    return made.filter(usable).select("vec_id", "v")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows as longs, exact; an error if one does not fit a long."""
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] if a.size and b.size else 0.0
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    large = [[int(x) for x in row] for row in a.tolist()], [[int(x) for x in row] for row in b.tolist()]
    exact = np.array(large[0], object) @ np.array(large[1], object).T
    if exact.max() > -NONE - 1 or exact.min() <= NONE:
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


class BallTree:
    """Balls around halves of halves of the rows, cut along the widest direction."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        self.leaves: list[tuple[int, int]] = []
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, left, right
        self._split(rows, order, 0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.centres = np.array([self.rows[b:e].mean(axis=0) for b, e, _, _ in self.nodes])
        spread = [np.sqrt(((self.rows[b:e] - c) ** 2).sum(axis=1).max()) for (b, e, _, _), c in zip(self.nodes, self.centres)]
        self.radii = np.array(spread)
        self.reach = np.sqrt((self.centres**2).sum(axis=1)) + self.radii

    def _split(self, rows: np.ndarray, order: np.ndarray, begin: int, end: int) -> int:
        number = len(self.nodes)
        self.nodes.append((begin, end, -1, -1))
        if end - begin > LEAF_ROWS:
            own = rows[order[begin:end]]
            far = own[np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
            farther = own[np.argmax(((own - far) ** 2).sum(axis=1))]
            middle = (end - begin) // 2
            along = own @ (farther - far)
            order[begin:end] = order[begin:end][np.argsort(along, kind="stable")]
            left = self._split(rows, order, begin, begin + middle)
            right = self._split(rows, order, begin + middle, end)
            self.nodes[number] = (begin, end, left, right)
        return number

    def search(self, queries: "Queries", k: int) -> "Best":
        """The best k rows of each query, given the scores it already has."""
        best = Best(len(queries.ids), k, queries.floor)
        bounds = queries.rows @ self.centres.T + np.outer(queries.norms, self.radii)
        # Rounding never hides a row, also where large terms cancel out.
        bounds += 1e-6 * (1 + np.abs(bounds)) + 1e-11 * np.outer(queries.norms, self.reach)
        self._visit(0, np.arange(len(queries.ids)), queries, bounds, best)
        return best

    def _visit(self, number: int, asking: np.ndarray, queries: "Queries", bounds: np.ndarray, best: "Best") -> None:
        """All queries whose bound for the node reaches their kth score, nearest child first."""
        asking = asking[bounds[asking, number] >= best.kth[asking]]
        if not len(asking):
            return
        begin, end, left, right = self.nodes[number]
        if left < 0:
            scores = products(queries.rows[asking], self.rows[begin:end])
            best.offer(asking, scores, self.ids[begin:end], queries.ids[asking])
            return
        nearer_left = bounds[asking, left] >= bounds[asking, right]
        for side, first, second in ((nearer_left, left, right), (~nearer_left, right, left)):
            own = asking[side]
            self._visit(first, own, queries, bounds, best)
            self._visit(second, own, queries, bounds, best)


class Queries:
    def __init__(self, ids: np.ndarray, rows: np.ndarray, floor: np.ndarray):
        self.ids, self.rows, self.floor = ids, rows, floor
        self.norms = np.sqrt((rows**2).sum(axis=1))


class Best:
    """The k best of every query: higher score first, then smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k = k
        self.scores = np.full((queries, k), NONE)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = floor
        self.kth = floor.copy()

    def offer(self, asking: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        scores = np.where(ids[None, :] == own[:, None], NONE, scores)
        hit = (scores > NONE).any(axis=1) & (scores.max(axis=1) >= self.kth[asking])
        if not hit.any():
            return
        asking, scores = asking[hit], scores[hit]
        all_scores = np.concatenate((self.scores[asking], scores), axis=1)
        all_ids = np.concatenate((self.ids[asking], np.broadcast_to(ids, scores.shape)), axis=1)
        order = np.lexsort((all_ids, -np.maximum(all_scores, NONE + 1)), axis=1)[:, : self.k]
        self.scores[asking] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[asking] = np.take_along_axis(all_ids, order, axis=1)
        self.kth[asking] = np.maximum(self.floor[asking], self.scores[asking, -1])


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.values if isinstance(column, pa.ListArray) else column.combine_chunks().values
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def top_k(vectors: DataFrame, asks: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for every row that ``asks``.

    ``vectors`` has vec_id and embedding; the score is the inner product of the
    whole-number vectors, ties go to the smaller vec_id, and a row with the
    query's own vec_id is no candidate.  Rows are dealt into shards of about
    8,192, whatever their values, and each shard gets a ball tree.  Queries go to
    all shards in blocks of bounded size.  A bounded sample of the rows gives
    each query a kth score to start from, which all shards share; in a shard,
    nodes are visited in the order of their bounds and left out if the bound is
    below the query's kth score.  Results are exact.

    Repeated rows are rows of their own; a repeated query answers once.  Vectors
    are compared with those of the same length only.  Rows that
    ``whole_vectors`` leaves out take no part; an empty table has no result.  A
    score beyond the range of a long is an error, never a wrong number.
    """
    spark = vectors.sparkSession
    stored = hand_over(whole_vectors(vectors), "vectors").read(spark)
    sizes = {r[0]: r[1] for r in stored.groupBy(F.size("v")).count().collect()}
    results = None
    for dimension, rows in sorted(sizes.items()):
        own = stored.filter(F.size("v") == dimension)
        queries = own.filter(asks).dropDuplicates(["vec_id", "v"])
        count = queries.count()
        blocks = -(-count // QUERY_BLOCK)
        shards = own.repartition(max(1, -(-rows // SHARD_ROWS)), F.xxhash64("vec_id", "v"))
        sample = own.orderBy(F.xxhash64("vec_id", "v")).limit(SEED_ROWS).toArrow()
        for block in range(blocks):
            chosen = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
            if not chosen.num_rows:
                continue
            sent = spark.sparkContext.broadcast(_asked(chosen, sample, dimension, k))
            found = shards.mapInArrow(_searcher(sent, dimension, k), "query_id long, vec_id long, score long")
            results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _asked(chosen: pa.Table, sample: pa.Table, dimension: int, k: int) -> Queries:
    """Queries with the kth best score among the sampled rows, which no answer can be below."""
    ids = chosen["vec_id"].to_numpy()
    rows = _matrix(chosen["v"], dimension)
    scores = products(rows, _matrix(sample["v"], dimension))
    scores[ids[:, None] == sample["vec_id"].to_numpy()[None, :]] = NONE
    floor = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(ids), NONE)
    return Queries(ids, rows, floor)


def _searcher(sent, dimension: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        ids = np.concatenate([b.column("vec_id").to_numpy() for b in parts])
        rows = np.concatenate([_matrix(b.column("v"), dimension) for b in parts])
        queries = sent.value
        for begin in range(0, len(ids), 2 * SHARD_ROWS):
            tree = BallTree(ids[begin : begin + 2 * SHARD_ROWS], rows[begin : begin + 2 * SHARD_ROWS])
            best = tree.search(queries, k)
            held = best.scores > NONE
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": np.repeat(queries.ids, held.sum(axis=1)),
                    "vec_id": best.ids[held],
                    "score": best.scores[held],
                }
            )

    return run
