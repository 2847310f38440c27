"""Shards of equal bytes by a k-d tree over document metadata (operator 8).

DataFrame functions only; the driver sees sums per node and histogram cell.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.llm.prefix import with_offset
from rebasket.session import hand_over

CELLS = 1 << 14
"""Histogram cells of all nodes of a level together, at least 16 a node."""
TOLERANCE = 0.002
"""A cut may miss a node's weighted median by this share of the node's bytes."""
LOWEST = -(1 << 63)


@dataclass
class Search:
    """The search for one node's weighted median among rows in the order (dimension, tie, id)."""

    node: int
    dimension: int
    total: int
    low: int
    high: int
    before: int = 0
    stage: int = 0
    fixed: tuple[int, ...] = ()
    cut: tuple[int, int, int] | None = None

    def settle(self, key: int) -> None:
        """Rows below ``key`` in this stage go left."""
        self.cut = (*self.fixed, key, *([LOWEST] * (2 - self.stage)))

    def advance(self, cells: list[tuple[int, int, int]]) -> None:
        """Takes weight, least and greatest key of the cells that have rows, ascending."""
        half, passed = self.total / 2, self.before
        for k, (weight, least, greatest) in enumerate(cells):
            last = k == len(cells) - 1
            if passed + weight >= half or last:
                upper = greatest + 1
                nearer_start = half - passed <= passed + weight - half
                near = min(half - passed, passed + weight - half) <= TOLERANCE * self.total
                stuck = least == greatest and self.stage == 2
                if near or stuck:
                    self.settle(least if nearer_start else upper)
                elif least == greatest:
                    self.fixed, self.stage = (*self.fixed, least), self.stage + 1
                    self.before, self.low, self.high = passed, LOWEST, LOWEST
                else:
                    self.before, self.low, self.high = passed, least, greatest
                return
            passed += weight


def _small(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A driver-made table as a literal; its size is bounded by the number of shards."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _keys(dimensions: Sequence[str], dimension: Column) -> Column:
    chosen = F.lit(None).cast("long")
    for k, name in enumerate(dimensions):
        chosen = F.when(dimension == k, F.col(name)).otherwise(chosen)
    return chosen


def _find_cuts(rows: DataFrame, searches: list[Search], dimensions: Sequence[str], tie: str, key: str) -> None:
    """Narrows every open search pass by pass; one grouped sum over ``rows`` each."""
    cells = max(16, CELLS // max(len(searches), 1))
    while open_ := [s for s in searches if s.cut is None]:
        told = [
            {
                "_node": s.node,
                "_dim": s.dimension,
                "_stage": s.stage,
                "_v": s.fixed[0] if s.stage > 0 else None,
                "_t": s.fixed[1] if s.stage > 1 else None,
                "_low": s.low,
                "_high": s.high,
                "_width": max((s.high - s.low) / cells, 1.0),
                "_all": s.low == LOWEST,
            }
            for s in open_
        ]
        params = _small(
            rows.sparkSession,
            told,
            "_node: bigint, _dim: int, _stage: int, _v: bigint, _t: bigint, _low: bigint, _high: bigint, "
            "_width: double, _all: boolean",
        )
        value = _keys(dimensions, F.col("_dim"))
        at = F.when(F.col("_stage") == 0, value).when(F.col("_stage") == 1, F.col(tie)).otherwise(F.col(key))
        inside = (F.col("_stage") == 0) | ((value == F.col("_v")) & ((F.col("_stage") == 1) | (F.col(tie) == F.col("_t"))))
        found = (
            rows.join(F.broadcast(params), rows["node"] == params["_node"])
            .filter(inside)
            .withColumn("_at", at)
            .filter(F.col("_all") | F.col("_at").between(F.col("_low"), F.col("_high")))
            .withColumn(
                "_cell",
                F.when(F.col("_all"), 0.0)
                .when(F.col("_width") > 1e9, (F.col("_at").cast("double") - F.col("_low").cast("double")) / F.col("_width"))
                .otherwise((F.col("_at") - F.col("_low")) / F.col("_width"))
                .cast("long"),
            )
            .groupBy("node", "_cell")
            .agg(F.sum("size").alias("weight"), F.min("_at").alias("least"), F.max("_at").alias("greatest"))
        )
        by_node: dict[int, list] = {}
        for r in found.collect():
            by_node.setdefault(r["node"], []).append((r["_cell"], (r["weight"], r["least"], r["greatest"])))
        for s in open_:
            own = [c for _, c in sorted(by_node[s.node])]
            if s.low == LOWEST and len(own) == 1 and own[0][1] < own[0][2] and s.stage > 0:
                # The first look at a new stage only learns its range.
                s.low, s.high = own[0][1], own[0][2]
            else:
                s.advance(own)


def _divide(rows: DataFrame, searches: list[Search], dimensions: Sequence[str], tie: str, key: str) -> DataFrame:
    """Rows with the node number of the next level; nodes that are not split go left."""
    told = [
        {"_node": s.node, "_dim": s.dimension, "_v": s.cut[0], "_t": s.cut[1], "_k": s.cut[2]} for s in searches
    ]
    cuts = _small(rows.sparkSession, told, "_node: bigint, _dim: int, _v: bigint, _t: bigint, _k: bigint")
    value = _keys(dimensions, F.col("_dim"))
    right = (value > F.col("_v")) | (
        (value == F.col("_v"))
        & ((F.col(tie) > F.col("_t")) | ((F.col(tie) == F.col("_t")) & (F.col(key) >= F.col("_k"))))
    )
    return (
        rows.join(F.broadcast(cuts), rows["node"] == cuts["_node"], "left")
        .withColumn("node", F.col("node") * 2 + F.when(right, 1).otherwise(0))
        .drop("_node", "_dim", "_v", "_t", "_k")
    )


@dataclass
class Tree:
    """The cuts of every level, and the shard number of every leaf."""

    levels: list[list[Search]]
    leaves: dict[int, int]
    dimensions: Sequence[str]
    tie: str
    key: str

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the dimensions, tie and key, with their int ``shard``."""
        placed = rows.withColumn("node", F.lit(0).cast("long"))
        for searches in self.levels:
            placed = _divide(placed, searches, self.dimensions, self.tie, self.key)
        told = [{"_leaf": k, "shard": v} for k, v in self.leaves.items()]
        numbers = _small(rows.sparkSession, told, "_leaf: bigint, shard: int")
        return placed.join(F.broadcast(numbers), placed["node"] == numbers["_leaf"]).drop("_leaf", "node")


def build_tree(
    rows: DataFrame, target_bytes: float, dimensions: Sequence[str], tie: str, key: str, most_leaves: int
) -> Tree:
    """Splits nodes of more than 1.5 times the target at weighted medians, all of a level together.

    There are never more than ``most_leaves`` leaves; the heaviest nodes are split first.

    A node is cut along its widest dimension, relative to that dimension's range
    in the whole table.  Rows alike in the dimension are ordered by ``tie`` and
    ``key``, so a heavy value is cut too; a cut that may fall at the edge of a
    tie within the tolerance does.
    """
    levels: list[list[Search]] = []
    placed = rows.withColumn("node", F.lit(0).cast("long"))
    ranges: dict[str, int] = {}
    while True:
        spans = [f(F.col(d)).alias(f"{n}_{k}") for k, d in enumerate(dimensions) for n, f in (("lo", F.min), ("hi", F.max))]
        ends = [F.min(tie).alias("t0"), F.max(tie).alias("t1"), F.min(key).alias("k0"), F.max(key).alias("k1")]
        nodes = placed.groupBy("node").agg(F.sum("size").alias("total"), *spans, *ends).collect()
        searches = []
        for r in nodes:
            width = {k: r[f"hi_{k}"] - r[f"lo_{k}"] for k in range(len(dimensions))}
            ranges = ranges or {k: max(w, 1) for k, w in width.items()}
            one = not any(width.values()) and r["t0"] == r["t1"] and r["k0"] == r["k1"]
            if r["total"] > 1.5 * target_bytes and not one:
                k = max(width, key=lambda k: (width[k] / ranges[k], -k))
                searches.append(Search(r["node"], k, r["total"], r[f"lo_{k}"], r[f"hi_{k}"]))
        # Every split makes one leaf more.
        searches.sort(key=lambda s: (-s.total, s.node))
        searches = sorted(searches[: max(most_leaves - len(nodes), 0)], key=lambda s: s.node)
        if not searches:
            order = sorted(r["node"] for r in nodes)
            return Tree(levels, {n: k for k, n in enumerate(order)}, dimensions, tie, key)
        _find_cuts(placed, searches, dimensions, tie, key)
        levels.append(searches)
        placed = _divide(placed, searches, dimensions, tie, key)
        if len(levels) % 8 == 0:
            placed = hand_over(placed, "nodes").read(rows.sparkSession)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with size (UTF-8 bytes and one), text_crc32 and the sort key of doc_id."""
    return docs.withColumns(
        {
            "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
            "text_crc32": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long"),
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)),
        }
    )


DIMENSIONS = ("size", "text_crc32")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, for ``shards`` shards of equal bytes.

    The dimensions are the size and the checksum of the text, so equal texts lie
    at one point and stay together unless they are too heavy for one side of a
    cut; then their doc_ids are cut.  Slots count the rows of a shard from 0 in
    a fixed hashed order.  Null texts are empty and weigh one byte, a null
    doc_id sorts first, and repeated rows that agree in doc_id and text are
    never parted.  With fewer rows than shards some shards stay empty.
    """
    rows = hand_over(measured(docs).select("doc_id", "size", "text_crc32", "_id"), "metadata").read(docs.sparkSession)
    total = rows.agg(F.sum("size")).first()[0] or 0
    tree = build_tree(rows, total / shards, DIMENSIONS, "text_crc32", "_id", shards)
    placed = tree.place(rows)
    return with_offset(placed, "shard", F.lit(1), ["_id", "text_crc32", "size"], "slot").drop("_id")


def sharded_rows(docs: DataFrame, shards: int) -> DataFrame:
    """All columns of ``docs`` with shard (int), and slot (long) in the shard; as ``shard_documents``.

    Columns of these two names that ``docs`` already has are replaced.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = measured(docs.select(F.struct(*names).alias("row"), "doc_id", "text"))
    rows = hand_over(packed.select("size", "text_crc32", "_id"), "metadata").read(docs.sparkSession)
    total = rows.agg(F.sum("size")).first()[0] or 0
    placed = build_tree(rows, total / shards, DIMENSIONS, "text_crc32", "_id", shards).place(packed)
    numbered = with_offset(placed, "shard", F.lit(1), ["_id", "text_crc32", "size"], "slot")
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return numbered.select(*columns, "shard", "slot")
