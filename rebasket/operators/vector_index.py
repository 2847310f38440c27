"""Nearest neighbours of many queries by cells, stored as a partitioned table.

Cell centres come from a bounded sample; every row is stored with the cell of its
nearest centre.  A query visits the cells of its nearest centres, which gives its
k-th distance an upper bound.  The exact search then visits just those other
cells that, by the triangle inequality, can hold something nearer.  Queries
travel to cells, never the corpus to blocks of queries.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from rebasket.operators.similarity import _Best, _matrix
from rebasket.session import hand_over, spread_rows
from rebasket.sources.tables import read_table

SAMPLE_ROWS = 65_536
"""Rows that the centres are fitted on; every row is put into a cell."""
MOST_CELLS = 4096
CELL_ROWS = 1000
"""Rows a cell has on average, as long as there are cells to spare."""
SHARD_ROWS = 50_000
"""Rows of a cell that one task compares; a larger cell is dealt over several."""
QUERY_ROWS = 2048
"""Queries that meet a shard in one step."""
TASK_PAIRS = 4_000_000_000
"""Pairs of rows and queries that one task compares; more queries are dealt over copies of the rows."""

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class VectorIndex:
    """Where an index lies: the rows by cell, and the cells with centre, radius and rows."""

    path: str

    def cells(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, f"{self.path}/cells")

    def rows(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, f"{self.path}/rows")


def _vectors(df: DataFrame) -> DataFrame:
    kept = df.filter(F.col("vector").isNotNull())
    return kept.select("id", F.col("vector").cast("array<double>").alias("vector"))


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances, a row per vector."""
    squares = np.einsum("ij,ij->i", vectors, vectors)[:, None] + np.einsum("ij,ij->i", centres, centres)
    return np.sqrt(np.maximum(squares - 2.0 * (vectors @ centres.T), 0.0))


def _fit_centres(rows: DataFrame, cells: int, total: int, seed: int) -> np.ndarray:
    if cells == 1:
        return np.array([rows.first()["vector"]])
    # A share by hash: the same on every run.
    share = min(1.0, 1.1 * SAMPLE_ROWS / max(total, 1))
    order = F.xxhash64(F.lit(seed), "id")
    picked = rows.filter(F.pmod(order, F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(SAMPLE_ROWS)
    sample = hand_over(picked.select(array_to_vector("vector").alias("features")), "cell-sample")
    model = KMeans(k=cells, seed=seed, maxIter=10, initSteps=2).fit(sample.read(rows.sparkSession))
    return np.array(model.clusterCenters())


def build_vector_index(
    corpus: DataFrame, path: str, cells: int | None = None, seed: int = 42, shard_rows: int = SHARD_ROWS
) -> VectorIndex:
    """Writes ``corpus`` (unique ``id``, ``vector``) by cell below ``path``.

    Rows without a vector are left out.  A cell of more than ``shard_rows`` rows,
    such as one of very many equal vectors, is stored as several shards.
    """
    spark = corpus.sparkSession
    rows = spread_rows(_vectors(corpus))
    total = rows.count()
    cells = max(1, min(cells or -(-total // CELL_ROWS), MOST_CELLS, total))
    centres = _fit_centres(rows, cells, total, seed) if total else np.zeros((0, 0))
    sent = spark.sparkContext.broadcast(centres)  # bounded: MOST_CELLS vectors
    schema = StructType(
        [*rows.schema, StructField("cell", IntegerType()), StructField("away", DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _distances(_matrix(batch.column("vector")), sent.value)
                cell = away.argmin(axis=1)
                columns = [pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=arrow)

    placed = hand_over(rows.mapInArrow(assign, schema), "placed").read(spark)
    sizes = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.max("away").alias("radius"))
    shards = F.ceil(F.col("rows") / shard_rows).cast("int").alias("shards")
    described = sizes.select("cell", "rows", "radius", shards).join(
        spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "cell int, centre array<double>"),
        "cell",
    )
    described.write.mode("overwrite").parquet(f"{path}/cells")
    known = read_table(spark, f"{path}/cells").select("cell", "shards")
    dealt = placed.join(F.broadcast(known), "cell").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")))
    (
        dealt.select("id", "vector", "cell", F.col("shard").cast("int").alias("shard"))
        .repartition("cell", "shard")
        .sortWithinPartitions("cell", "shard")
        .write.mode("overwrite")
        .parquet(f"{path}/rows")
    )
    return VectorIndex(path)


def probes_for(
    index: VectorIndex, queries: DataFrame, k: int = 4, skip_self: bool = False, recall: float = 0.95,
    sample_rows: int = 256,
) -> int:
    """How many cells a query has to visit for this recall, measured on a sample of ``queries``.

    The exact neighbours of at most ``sample_rows`` queries, the first in hash
    order, tell in which of its cells, by distance, a neighbour lies.
    """
    spark = queries.sparkSession
    sample = _vectors(queries).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = hand_over(sample, "probe-sample").read(spark)
    exact = search_cells(index, sample, k, skip_self)
    of_row = index.rows(spark).select(F.col("id").alias("doc_id"), "cell")
    lying = exact.join(of_row, "doc_id").select("query_id", "cell").collect()  # bounded: k per sampled query
    asked = {r["id"]: r["vector"] for r in sample.collect()}
    cells = index.cells(spark).collect()
    if not lying:
        return 1
    centres, numbers = np.array([c["centre"] for c in cells]), np.array([c["cell"] for c in cells])
    away = _distances(np.array([asked[r["query_id"]] for r in lying], np.float64), centres)
    order = numbers[np.argsort(away, axis=1, kind="stable")]
    places = np.sort((order == np.array([r["cell"] for r in lying])[:, None]).argmax(axis=1))
    return int(places[int(np.ceil(recall * len(places))) - 1]) + 1


def _visits(queries: DataFrame, cells: list, first: int | None, bounded: bool) -> DataFrame:
    """(id, vector, cell): the ``first`` cells of each query, or the others within its ``bound``."""
    spark = queries.sparkSession
    numbers = np.array([c["cell"] for c in cells], np.int32)
    centres, radius = np.array([c["centre"] for c in cells]), np.array([c["radius"] for c in cells])
    sent = spark.sparkContext.broadcast((numbers, centres, radius))
    kept = [f for f in queries.schema if f.name in ("id", "vector")]
    schema = StructType([*kept, StructField("cell", IntegerType())])
    arrow = to_arrow_schema(schema)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, centres, radius = sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(start, QUERY_ROWS)
                vectors = _matrix(batch.column("vector"))
                away = _distances(vectors, centres)
                near = np.zeros(away.shape, bool)
                np.put_along_axis(near, np.argsort(away, axis=1, kind="stable")[:, :first], True, axis=1)
                if bounded:
                    # Rounding must not lose a cell: the margin is far above it.
                    scale = 1.0 + away + radius
                    bound = np.sqrt(batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64))
                    near = ~near & ((away - radius - 1e-6 * scale) <= bound[:, None])
                query, cell = np.nonzero(near)
                taken = pa.array(query)
                columns = [batch.column("id").take(taken), batch.column("vector").take(taken)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers[cell])], schema=arrow)

    return queries.mapInArrow(visit, schema)


def _groups(cells: list, queries: int, task_pairs: int) -> list[tuple[int, int, int, int]]:
    """(cell, shards, blocks, first): into how many blocks the queries of a cell are dealt.

    Each shard and block is a group, numbered from ``first`` on; a group has about
    ``task_pairs`` pairs at most, even if every query visits the cell.
    """
    dealt, first = [], 0
    for c in cells:
        rows = -(-c["rows"] // c["shards"])
        blocks = max(1, -(-queries // max(QUERY_ROWS, task_pairs // rows)))
        dealt.append((c["cell"], c["shards"], blocks, first))
        first += c["shards"] * blocks
    return dealt


def _compare(index: VectorIndex, visits: DataFrame, cells: list, queries: int, k: int, skip_self: bool) -> DataFrame:
    """(query_id, doc_id, distance): the k best rows per query and shard.

    The rows of a shard and a block of its queries, of ``queries`` in all, make one
    task; the queries pass by in steps of bounded size.
    """
    spark = visits.sparkSession
    dealt = _groups(cells, queries, TASK_PAIRS)
    known = spark.createDataFrame(dealt, "cell int, shards int, blocks int, first int")
    shards = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    number = (F.col("first") + F.col("shard") * F.col("blocks") + F.col("block")).alias("group")
    rows = index.rows(spark)
    of_query = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int").alias("block")
    asked = visits.join(F.broadcast(known), "cell")  # bounded: a row per cell
    asked = asked.select("id", "vector", "first", "blocks", shards, of_query).select("id", "vector", number)
    held = rows.join(F.broadcast(known), "cell").select("id", "vector", "first", "shard", "blocks", blocks)
    tagged = held.select(number, F.lit(False).alias("asks"), "vector", F.col("id").alias("doc_id"))
    both = tagged.unionByName(
        asked.select("group", F.lit(True).alias("asks"), "vector", F.col("id").alias("query_id")),
        allowMissingColumns=True,
    )
    schema = StructType(
        [
            StructField("query_id", visits.schema["id"].dataType),
            StructField("doc_id", rows.schema["id"].dataType),
            StructField("distance", DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by group, its rows before its queries: only the rows are kept.
        current, ids, vectors = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "asks")], 1)
            borders = np.flatnonzero(np.any(np.diff(keys.astype(np.int64), axis=0) != 0, axis=1)) + 1
            for x, y in zip([0, *borders.tolist()], [*borders.tolist(), len(keys)]):
                part = batch.slice(x, y - x)
                if keys[x][0] != current:
                    current, ids, vectors = keys[x][0], [], []
                if not keys[x][1]:
                    ids.append(part.column("doc_id"))
                    vectors.append(_matrix(part.column("vector")))
                    continue
                if not ids:
                    continue
                for start in range(0, part.num_rows, QUERY_ROWS):
                    some = part.slice(start, QUERY_ROWS)
                    best = _Best(some.column("query_id").to_pylist(), _matrix(some.column("vector")), k, skip_self)
                    for doc_ids, docs in zip(ids, vectors):
                        best.add(doc_ids, docs)
                    yield best.batch(arrow)

    groups = sum(shards * blocks for _, shards, blocks, _ in dealt)
    # One task per group: hashed, several large groups would meet in one task.
    return both.repartitionById(groups, "group").sortWithinPartitions("group", "asks").mapInArrow(search, schema)


def search_cells(
    index: VectorIndex, queries: DataFrame, k: int = 4, skip_self: bool = False, first: int = 8, exact: bool = True
) -> DataFrame:
    """(query_id, doc_id, distance, rank): the ``k`` rows nearest to each query.

    Queries have a unique ``id`` and a ``vector``; ``distance`` is the squared
    Euclidean distance, ties go to the lower id.  With ``exact`` false only the
    ``first`` cells of a query are visited.  Queries without a vector and an empty
    index give no rows; vectors of another length are an error.
    """
    spark = queries.sparkSession
    asked = hand_over(_vectors(queries), "cell-queries").read(spark)
    asked = spread_rows(asked)
    cells = index.cells(spark).collect()  # bounded: MOST_CELLS rows
    schema = f"query_id {asked.schema['id'].dataType.simpleString()}, doc_id "
    schema += f"{index.rows(spark).schema['id'].dataType.simpleString()}, distance double, rank int"
    if not cells:
        return spark.createDataFrame([], schema)
    queries = asked.count()
    order = Window.partitionBy("query_id").orderBy("distance", "doc_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    near = ranked(_compare(index, _visits(asked, cells, first, False), cells, queries, k, skip_self))
    if not exact:
        return near
    near = hand_over(near.drop("rank"), "near").read(spark)
    bounds = near.groupBy("query_id").agg(
        F.when(F.count("*") == k, F.max("distance")).otherwise(float("inf")).alias("bound")
    )
    # A query that has met fewer than k rows has to visit every cell.
    limited = asked.join(bounds.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", "vector", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
    )
    further = _compare(index, _visits(limited, cells, first, True), cells, queries, k, skip_self)
    return ranked(near.unionByName(further))
