"""Random forests, grown over packed blocks of binned rows and scored by arrays of nodes.

The method is that of Spark's forest: every tree draws its own sample, numbers are cut
at quantiles, every node looks at a random share of the features and takes the split of
the greatest gain, all trees grow level by level, and a split whose leaves agree is taken
back.  Spark keeps a node number per row and tree and walks objects; here a task holds a
block of rows as small integers and finds the nodes of a tree for all of them at once, so
nothing is kept per row and tree.  The models are Spark's own, loaded from its format.
"""

from __future__ import annotations

import ctypes
import json
import math
import pickle
import sys
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.session import new_path

BLOCK_ROWS = 32_768
"""Rows of a block, which a task keeps as small integers; arrays of more rows leave the processor's cache."""
MATRIX_CELLS = 1 << 22
"""Numbers of the matrix that vectors are unpacked to at once."""
PASS_CELLS = 1 << 24
"""Sums that a task keeps in one pass; more nodes are grown in several passes."""
ROW_GROUP_BYTES = 4 << 20
"""Bytes after which stored blocks can be dealt to another task."""
SKETCH_ACCURACY = 10_000
DRAWS = 1 << 16
"""Steps of the share of rows that occur so many times in a sample."""
PURE = 1e-6
_WORD = (1 << 64) - 1
KEPT_BYTES = 32 << 20
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3  # as in malloc.h

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- rows as small integers ---


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of everything that dense and sparse vectors hold."""
    kind, _, indices, values = vectors.flatten()
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    feature = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    feature[(kind.to_numpy() == 0)[row]] = indices.flatten().to_numpy()
    return row, feature, values.flatten().to_numpy()


def _slices(vectors: pa.StructArray, features: int) -> Iterator[pa.StructArray]:
    """The vectors in slices whose matrix has a bounded size."""
    rows = max(1, MATRIX_CELLS // max(features, 1))
    for start in range(0, len(vectors), rows):
        yield vectors.slice(start, rows)


@dataclass(frozen=True)
class Layout:
    """What the vectors hold: numbers first, then the slots of each one-hot column."""

    numbers: int
    sizes: tuple[int, ...] = ()

    @property
    def features(self) -> int:
        return self.numbers + sum(self.sizes)

    @property
    def columns(self) -> int:
        return self.numbers + len(self.sizes)

    @property
    def starts(self) -> np.ndarray:
        """The first slot of each one-hot column."""
        return self.numbers + np.cumsum((0, *self.sizes))[:-1]

    def kind(self, bins: int) -> np.dtype:
        return np.dtype("<u2" if max((bins, *self.sizes)) < (1 << 15) else "<u4")


def _numbers(vectors: pa.StructArray, layout: Layout) -> np.ndarray:
    row, feature, value = _entries(vectors)
    found = np.zeros((layout.numbers, len(vectors)))
    mine = feature < layout.numbers
    found[feature[mine], row[mine]] = value[mine]
    return found


def _hot(vectors: pa.StructArray, layout: Layout) -> np.ndarray:
    """Per one-hot column the slot of the 1, or the number of slots where there is none."""
    row, feature, value = _entries(vectors)
    found = np.repeat(np.array(layout.sizes, np.int64)[:, None], len(vectors), axis=1)
    hot = (feature >= layout.numbers) & (value != 0)
    group = np.searchsorted(layout.starts, feature[hot], "right") - 1
    found[group, row[hot]] = feature[hot] - layout.starts[group]
    return found


# --- bins ---


def _survey(rows: DataFrame, label: str, layout: Layout, most: int) -> tuple[dict[float, int], list[np.ndarray | None]]:
    """The rows per label, and per number its values, or None if they are more than ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list[np.ndarray | None] = [np.zeros(0)] * layout.numbers
        labels: dict[float | None, int] = {}
        for batch in batches:
            for name, n in zip(*(part.to_pylist() for part in batch.column(1).value_counts().flatten())):
                labels[name] = labels.get(name, 0) + n
            for part in _slices(batch.column(0), layout.features):
                numbers = _numbers(part, layout)
                for k, known in enumerate(values):
                    if known is not None:
                        known = np.union1d(known, numbers[k])
                        values[k] = known if len(known) <= most else None
        found = [(-1, name, n) for name, n in labels.items()]
        for k, known in enumerate(values):
            found += [(k, None, 0)] if known is None else [(k, value, 0) for value in known.tolist()]
        columns = list(zip(*found)) if found else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.int64()))], ["feature", "value", "n"]
        )

    given = rows.select(F.unwrap_udt("features").alias("features"), F.col(label).cast("double").alias("label"))
    found = given.mapInArrow(run, "feature int, value double, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    labels, values = {}, [set() for _ in range(layout.numbers)]
    for feature, value, n in found.collect():  # bounded: labels, and few values of each number
        if feature < 0:
            labels[value] = n
        else:
            values[feature].add(value)
    return labels, [None if None in v or len(v) > most else np.array(sorted(v)) for v in values]


def _cuts(rows: DataFrame, values: Sequence[np.ndarray | None], bins: int) -> list[np.ndarray]:
    """Per number the greatest values of its bins but the last: every value, or quantiles of many."""
    cuts = [None if known is None else known[:-1] for known in values]
    wide = [k for k, known in enumerate(values) if known is None]
    if wide:
        share = [k / bins for k in range(1, bins)]
        unpacked = rows.select(vector_to_array("features").alias("x"))
        quantiles = unpacked.agg(*[F.percentile_approx(F.col("x")[k], share, SKETCH_ACCURACY) for k in wide]).first()
        for k, found in zip(wide, quantiles):
            cuts[k] = np.unique(np.array(found, float))
    return cuts


def _packed(rows: DataFrame, label: str, layout: Layout, cuts: Sequence[np.ndarray]) -> tuple[DataFrame, list[np.ndarray]]:
    """The rows as stored blocks of codes, and per number the least value in each bin."""
    bins = max((len(cut) + 1 for cut in cuts), default=1)
    kind = layout.kind(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full((layout.numbers, bins), np.inf)
        task, number, held, rows_held = TaskContext.get().partitionId(), 0, [], 0

        def block(last: bool) -> pa.RecordBatch:
            codes = np.concatenate([c for c, _ in held], axis=1)
            labels = np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([task], pa.int32()),
                    "number": pa.array([number], pa.int32()),
                    "codes": pa.array([codes.tobytes()], pa.binary()),
                    "labels": pa.array([labels.tobytes()], pa.binary()),
                    "least": pa.array([least.tobytes() if last else None], pa.binary()),
                }
            )

        def coded(part: pa.StructArray) -> np.ndarray:
            numbers = _numbers(part, layout)
            codes = np.empty((layout.columns, len(part)), kind)
            for k, cut in enumerate(cuts):
                code = np.searchsorted(cut, numbers[k])
                np.minimum.at(least[k], code, numbers[k])
                codes[k] = code
            codes[layout.numbers :] = _hot(part, layout)
            return codes

        for batch in batches:
            at = 0
            for part in _slices(batch.column(0), layout.features):
                labels = batch.column(1).slice(at, len(part)).to_numpy().astype("<i4")
                held.append((coded(part), labels))
                at, rows_held = at + len(part), rows_held + len(part)
                if rows_held >= BLOCK_ROWS:
                    yield block(False)
                    number, held, rows_held = number + 1, [], 0
        if not held:
            held.append((np.empty((layout.columns, 0), kind), np.empty(0, "<i4")))
        yield block(True)

    given = rows.select(F.unwrap_udt("features").alias("features"), F.col(label).cast("int").alias("label"))
    schema = "task int, number int, codes binary, labels binary, least binary"
    path = new_path(rows.sparkSession, "blocks")
    given.mapInArrow(run, schema).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    stored = rows.sparkSession.read.schema(schema).parquet(path)
    least = np.full((layout.numbers, bins), np.inf)
    for row in stored.filter("least IS NOT NULL").select("least").toLocalIterator():
        least = np.minimum(least, np.frombuffer(row.least).reshape(least.shape))
    return stored.select("task", "number", "codes", "labels"), list(least)


def _threshold(cut: np.ndarray, least: np.ndarray, code: int) -> float:
    """A value between a bin and the next one that has rows."""
    above = least[code + 1 : len(cut) + 1].min()
    middle = (cut[code] + above) / 2
    return float(middle if cut[code] <= middle < above else cut[code])


# --- samples ---


def _times(rate: float, bootstrap: bool) -> np.ndarray | None:
    """How often a row is in a sample, by a number drawn below DRAWS; None for once each."""
    if not bootstrap:
        return None if rate >= 1 else (np.arange(DRAWS) < rate * DRAWS).astype(np.uint8)
    shares, k = [math.exp(-rate)], 0
    while sum(shares) < 1 - 0.5 / DRAWS and k < 250:
        k += 1
        shares.append(shares[-1] * rate / k)
    return np.searchsorted(np.cumsum(shares) * DRAWS, np.arange(DRAWS) + 0.5).clip(max=k).astype(np.uint8)


def _sample(times: np.ndarray | None, key: Sequence[int], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a block in the sample of a tree, and how often each; the same in every pass."""
    if times is None:
        return np.arange(rows), np.ones(rows)
    seed, tree, task, number = key
    random = np.random.Philox(key=(seed & _WORD) | tree << 64, counter=task << 192 | number << 128)
    draws = random.random_raw(-(-rows // 4)).view("<u2")[:rows]
    drawn = times.take(draws, mode="clip")
    at = np.flatnonzero(drawn > 0)
    return at, drawn.take(at).astype(float)


# --- nodes ---


class _Nodes:
    """The nodes of a growing tree; the right child follows the left one, a leaf is its own left child.

    A row goes right if its code in ``column`` lies in ``base`` to ``base + span``.
    """

    def __init__(self, total: np.ndarray, kind: np.dtype):
        self.top = np.iinfo(kind).max
        self.column, self.base, self.span = [np.zeros(1, kind_) for kind_ in (np.int64, kind, kind)]
        self.base[:] = self.top
        self.left = np.zeros(1, np.int64)
        self.stats = total.reshape(1, -1)
        self.gain = np.full(1, -1.0)
        self.feature = np.full(1, -1)
        self.code = np.full(1, -1)

    def split(self, nodes: np.ndarray, found: _Splits, layout: Layout) -> np.ndarray:
        """Gives the nodes two children each; their numbers."""
        first = len(self.left) + 2 * np.arange(len(nodes))
        hot = found.feature >= layout.numbers
        group = np.searchsorted(layout.starts, found.feature, "right") - 1
        self.column[nodes] = np.where(hot, layout.numbers + group, found.feature)
        starts = layout.starts if layout.sizes else np.zeros(1, np.int64)
        self.base[nodes] = np.where(hot, found.feature - starts[group], found.code + 1)
        self.span[nodes] = np.where(hot, 0, self.top // 2)
        self.left[nodes], self.gain[nodes], self.feature[nodes], self.code[nodes] = first, found.gain, found.feature, found.code
        children = np.stack((found.left, found.total - found.left), axis=1).reshape(-1, self.stats.shape[1])
        added = first[0] + np.arange(2 * len(nodes)) if len(nodes) else np.zeros(0, np.int64)
        for name, fill in (("column", 0), ("base", self.top), ("span", 0), ("gain", -1.0), ("feature", -1), ("code", -1)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate((old, np.full(len(added), fill, old.dtype))))
        self.left = np.concatenate((self.left, added))
        self.stats = np.concatenate((self.stats, children))
        return added


def _keep_memory() -> None:
    """Lets this process keep what it frees: sums of a block are new arrays, and new pages cost more than the sums."""
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    if tune:
        tune(_MMAP_THRESHOLD, KEPT_BYTES)
        tune(_TRIM_THRESHOLD, 2 * KEPT_BYTES)


def _walk(flat: np.ndarray, rows: int, at: np.ndarray, tree: tuple[np.ndarray, ...], levels: int) -> np.ndarray:
    """The node of each row ``at``; ``flat`` has the codes of all rows column by column."""
    column, base, span, left = tree
    offset = column * rows
    node = np.zeros(len(at), np.int64)
    for _ in range(levels):
        place = offset.take(node)
        place += at
        code = flat.take(place, mode="clip")
        code -= base.take(node)
        right = code <= span.take(node)
        node = left.take(node)
        node += right
    return node


# --- sums ---


@dataclass(frozen=True)
class _Plan:
    """Which sums a pass takes of some nodes of a tree.

    Sums lie in one array: rows per node and class; per number that a node looks at, rows
    per bin and class; per slot that a node looks at, rows per class.
    """

    tree: int
    key: tuple[int, int]  # of the sample
    walk: tuple[np.ndarray, ...]
    slot: np.ndarray  # by node: the place among the nodes of this pass, or -1
    nodes: int
    classes: int
    bins: int
    number_node: np.ndarray  # numbers that nodes look at, by node
    number: np.ndarray
    hot_node: np.ndarray  # slots that nodes look at
    hot: np.ndarray

    @property
    def first_number(self) -> int:
        return self.nodes * self.classes

    @property
    def first_hot(self) -> int:
        return self.first_number + len(self.number) * self.bins * self.classes

    @property
    def cells(self) -> int:
        return self.first_hot + len(self.hot) * self.classes

    def rounds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per node its first, second, ... number and where its sums begin among those of numbers; -1 for none."""
        begin = np.searchsorted(self.number_node, np.arange(self.nodes))
        place = np.arange(len(self.number)) - begin[self.number_node]
        found = []
        for k in range(int(place.max(initial=-1)) + 1):
            these = np.flatnonzero(place == k)
            column, start = np.zeros(self.nodes, np.int64), np.full(self.nodes, -1)
            column[self.number_node[these]] = self.number[these]
            start[self.number_node[these]] = these * self.bins * self.classes
            found.append((column, start))
        return found

    def taken(self, layout: Layout) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Per one-hot column that is looked at: its place, its codes, which sums of it are taken, and whereto."""
        group = np.searchsorted(layout.starts, self.hot, "right") - 1
        found = []
        for g in np.unique(group).tolist():
            these = np.flatnonzero(group == g)
            size = layout.sizes[g] + 1
            source = self.hot_node[these] * size + self.hot[these] - layout.starts[g]
            found.append((layout.numbers + g, size, source, these))
        return found


class _Sums:
    """The sums of one plan over the blocks of a task."""

    def __init__(self, plan: _Plan, layout: Layout):
        self.plan, self.rounds, self.taken = plan, plan.rounds(), plan.taken(layout)
        self.cells = np.zeros(plan.cells)
        # All codes of the one-hot columns that are looked at; those of the slots are taken at the end.
        self.hot = [np.zeros(plan.nodes * size * plan.classes) for _, size, _, _ in self.taken]

    def add(
        self, flat: np.ndarray, joint: np.ndarray, labels: np.ndarray, at: np.ndarray, times: np.ndarray, levels: int
    ) -> None:
        """Adds the rows ``at`` of a block; ``flat`` has its codes column by column, ``joint`` its codes and labels as one."""
        plan, classes, rows = self.plan, self.plan.classes, len(labels)
        slot = plan.slot.take(_walk(flat, rows, at, plan.walk, levels))
        if len(slot) and slot.min() < 0:
            open_ = np.flatnonzero(slot >= 0)
            slot, at, times = slot.take(open_), at.take(open_), times.take(open_)
        for (column, size, _, _), held in zip(self.taken, self.hot):
            key = slot * (size * classes)
            key += joint[column * rows : (column + 1) * rows].take(at)
            held += np.bincount(key, times, len(held))
        if not self.taken:
            self.cells[: plan.first_number] += np.bincount(slot * classes + labels.take(at), times, plan.first_number)
        keys, weights = [], []
        for column, start in self.rounds:
            key = start.take(slot)
            if start.min() < 0:  # nodes without this number have no further one either
                looks = np.flatnonzero(key >= 0)
                slot, at, times, key = slot.take(looks), at.take(looks), times.take(looks), key.take(looks)
            place = (column * rows).take(slot)
            place += at
            key += joint.take(place, mode="clip")
            keys.append(key)
            weights.append(times)
        if keys:
            sums = np.bincount(np.concatenate(keys), np.concatenate(weights), plan.first_hot - plan.first_number)
            self.cells[plan.first_number : plan.first_hot] += sums

    def whole(self) -> np.ndarray:
        """The sums as planned."""
        plan = self.plan
        for (_, size, source, these), held in zip(self.taken, self.hot):
            self.cells[plan.first_hot :].reshape(-1, plan.classes)[these] = held.reshape(-1, plan.classes)[source]
            total = held.reshape(plan.nodes, size, plan.classes).sum(axis=1).ravel()
            self.cells[: plan.first_number] = total
        return self.cells


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Of the classes on the last axis; zero without rows."""
    total = counts.sum(axis=-1, keepdims=True)
    share = counts / np.where(total > 0, total, 1)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1 - (share * share).sum(axis=-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)


@dataclass(frozen=True)
class _Splits:
    """The best split of every node: its gain (not above zero for none), and the rows that go left."""

    gain: np.ndarray
    feature: np.ndarray
    code: np.ndarray
    left: np.ndarray
    total: np.ndarray

    def of(self, which: np.ndarray) -> _Splits:
        return _Splits(*(part[which] for part in (self.gain, self.feature, self.code, self.left, self.total)))


@dataclass(frozen=True)
class Rules:
    """What a split has to reach."""

    impurity: str
    min_rows: int
    min_gain: float


def _best(plan: _Plan, cells: np.ndarray, layout: Layout, rules: Rules) -> _Splits:
    total = cells[: plan.first_number].reshape(plan.nodes, plan.classes)
    numbers = cells[plan.first_number : plan.first_hot].reshape(-1, plan.bins, plan.classes)
    hot = cells[plan.first_hot :].reshape(-1, plan.classes)
    # Rows without the 1 of a slot go left.
    left = np.concatenate((np.cumsum(numbers, axis=1)[:, :-1].reshape(-1, plan.classes), total[plan.hot_node] - hot))
    per_number = plan.bins - 1
    node = np.concatenate((np.repeat(plan.number_node, per_number), plan.hot_node))
    feature = np.concatenate((np.repeat(plan.number, per_number), plan.hot))
    code = np.concatenate((np.tile(np.arange(per_number), len(plan.number)), np.zeros(len(plan.hot), np.int64)))
    whole = total[node]
    rows, rows_left = whole.sum(axis=1), left.sum(axis=1)
    rows_right = rows - rows_left
    share = rows_left / np.where(rows > 0, rows, 1)
    gain = _impurity(total, rules.impurity)[node]
    gain = gain - share * _impurity(left, rules.impurity) - (1 - share) * _impurity(whole - left, rules.impurity)
    valid = (np.minimum(rows_left, rows_right) >= max(rules.min_rows, 1)) & (gain >= rules.min_gain)
    gain = np.where(valid, gain, -1.0)
    order = np.lexsort((code, feature, -gain, node))
    first = order[np.flatnonzero(np.diff(node[order], prepend=-1))]
    found = _Splits(
        np.full(plan.nodes, -1.0), np.full(plan.nodes, -1), np.full(plan.nodes, -1), np.zeros_like(total), total
    )
    at = node[first]
    found.gain[at], found.feature[at], found.code[at], found.left[at] = gain[first], feature[first], code[first], left[first]
    return found


_FOUND = "tree int, gain binary, feature binary, code binary, left binary, total binary"


def _pass(
    blocks: DataFrame, plans: Sequence[_Plan], layout: Layout, kind: np.dtype, levels: int, times: np.ndarray | None, rules: Rules
) -> dict[int, _Splits]:
    """The best splits of the planned nodes, by place of the plan."""
    spark, classes = blocks.sparkSession, plans[0].classes
    wide = "<u2" if classes * (max((plans[0].bins, *layout.sizes)) + 1) < 1 << 16 else "<i8"
    # By value: a worker may not find this module.
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(list(plans)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        sums = [_Sums(plan, layout) for plan in pickle.loads(sent.value)]
        for batch in batches:
            for task, number, codes, labels in zip(*batch.columns):
                flat, y = np.frombuffer(codes.as_buffer(), kind), np.frombuffer(labels.as_buffer(), "<i4").astype(np.int64)
                if not len(y):
                    continue
                joint = (flat.reshape(-1, len(y)) * np.int64(classes) + y).astype(wide).ravel()
                for held in sums:
                    at, n = _sample(times, (*held.plan.key, task.as_py(), number.as_py()), len(y))
                    held.add(flat, joint, y, at, n, levels)
        for k, held in enumerate(sums):
            cells = held.whole()
            small = cells.max(initial=0) < 1 << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([cells.astype("<u4" if small else "<u8").tobytes()], pa.binary())],
                ["tree", "cells"],
            )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        planned = pickle.loads(sent.value)
        for batch in batches:
            for k, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                size, data = planned[k].cells, cells.as_buffer()
                found = np.frombuffer(data, "<u4" if data.size == 4 * size else "<u8")
                totals[k] = totals[k] + found if k in totals else found.astype(float)
        for k, cells in totals.items():
            found = _best(planned[k], cells, layout, rules)
            parts = [found.gain, found.feature.astype("<i8"), found.code.astype("<i8"), found.left, found.total]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), *[pa.array([part.tobytes()], pa.binary()) for part in parts]],
                ["tree", "gain", "feature", "code", "left", "total"],
            )

    counted = blocks.mapInArrow(count, "tree int, cells binary").repartition("tree")
    found = {}
    for row in counted.mapInArrow(choose, _FOUND).collect():  # bounded: a split per node of the pass
        found[row.tree] = _Splits(
            np.frombuffer(row.gain), np.frombuffer(row.feature, "<i8"), np.frombuffer(row.code, "<i8"),
            np.frombuffer(row.left).reshape(-1, classes), np.frombuffer(row.total).reshape(-1, classes),
        )
    sent.destroy()
    return found


def looked_at(strategy: str, features: int, trees: int) -> int:
    """How many features a node looks at, as Spark reads the strategy."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {
        "all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
        "log2": max(1, math.ceil(math.log2(features))) if features else 0,
    }
    if strategy in named:
        return named[strategy]
    if strategy.isdecimal():
        return min(int(strategy), features)
    return math.ceil(float(strategy) * features)


def _looked_at(seed: int, tree: int, level: int, nodes: int, wanted: int, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the features it looks at: (node, feature), by node."""
    wanted = min(wanted, len(usable))
    if wanted == 0 or nodes == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    random = np.random.Generator(np.random.SFC64([seed & _WORD, tree, level, 1 << 40]))
    chosen = np.empty((nodes, wanted), np.int64)
    step = max(1, MATRIX_CELLS // len(usable))
    for start in range(0, nodes, step):
        drawn = random.random((min(step, nodes - start), len(usable)))
        chosen[start : start + step] = np.sort(np.argpartition(drawn, wanted - 1, axis=1)[:, :wanted], axis=1)
    return np.repeat(np.arange(nodes), wanted), usable[chosen.ravel()]


def _grown(
    blocks: DataFrame, forests: Sequence[RandomForestClassifier], layout: Layout, cuts: Sequence[np.ndarray], classes: int
) -> list[list[_Nodes]]:
    """The trees of every forest, all grown at once."""
    bins = max((len(cut) + 1 for cut in cuts), default=1)
    kind = layout.kind(bins)
    example = forests[0]
    keys = [(forest.getSeed(), k) for forest in forests for k in range(forest.getNumTrees())]
    rules = Rules(example.getImpurity().lower(), example.getMinInstancesPerNode(), example.getMinInfoGain())
    times = _times(example.getSubsamplingRate(), example.getBootstrap())
    # A number with one value offers no split.
    usable = np.array([k for k, cut in enumerate(cuts) if len(cut)] + list(range(layout.numbers, layout.features)), np.int64)
    wanted = looked_at(example.getFeatureSubsetStrategy(), layout.features, example.getNumTrees())
    trees: list[_Nodes | None] = [None] * len(keys)
    open_ = [np.zeros(1, np.int64) for _ in keys]
    empty = _Nodes(np.zeros(classes), kind)
    hot_cells = sum(size + 1 for size in layout.sizes) * classes  # what a node takes besides its own sums

    def plans(level: int) -> Iterator[tuple[np.ndarray, _Plan]]:
        for k, (seed, tree) in enumerate(keys):
            nodes, known = open_[k], trees[k] or empty
            node, feature = _looked_at(seed, tree, level, len(nodes), wanted, usable)
            each = classes * (1 + wanted * bins)
            most = max(1, PASS_CELLS // (each + hot_cells))  # nodes of one plan
            for start in range(0, len(nodes), most):
                some = nodes[start : start + most]
                slot = np.full(len(known.left), -1)
                slot[some] = np.arange(len(some))
                here = (node >= start) & (node < start + len(some))
                number = here & (feature < layout.numbers)
                hot = here & (feature >= layout.numbers)
                yield some, _Plan(
                    k, (seed, tree), (known.column, known.base, known.span, known.left), slot, len(some), classes, bins,
                    node[number] - start, feature[number], node[hot] - start, feature[hot],
                )

    def passes(level: int) -> Iterator[list[tuple[np.ndarray, _Plan]]]:
        held, cells = [], 0
        for planned in plans(level):
            more = planned[1].cells + planned[1].nodes * hot_cells
            if held and cells + more > PASS_CELLS:
                yield held
                held, cells = [], 0
            held.append(planned)
            cells += more
        if held:
            yield held

    # At the last level nothing is split, but a forest of single nodes needs their rows.
    for level in range(max(example.getMaxDepth(), 1)):
        following: list[list[np.ndarray]] = [[] for _ in keys]
        for held in list(passes(level)):
            found = _pass(blocks, [plan for _, plan in held], layout, kind, level, times, rules)
            for k, (nodes, plan) in enumerate(held):
                splits = found[k]
                if level == 0:
                    trees[plan.tree] = _Nodes(splits.total[0], kind)
                if example.getMaxDepth() == 0:
                    continue
                grow = np.flatnonzero(splits.gain > 0)
                added = trees[plan.tree].split(nodes[grow], splits.of(grow), layout)
                if level + 1 < example.getMaxDepth():
                    mixed = _impurity(trees[plan.tree].stats[added], rules.impurity) >= PURE
                    following[plan.tree].append(added[mixed])
        open_ = [np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in following]
        if not any(map(len, open_)):
            break
    done = iter(trees)
    return [[next(done) for _ in range(forest.getNumTrees())] for forest in forests]


# --- Spark's format ---

_OF_TREES = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
    "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "probabilityCol",
    "rawPredictionCol", "seed",
)
_SPLIT = pa.struct(
    {"featureIndex": pa.int32(), "leftCategoriesOrThreshold": pa.list_(pa.float64()), "numCategories": pa.int32()}
)


def _merged(tree: _Nodes) -> np.ndarray:
    """The nodes to keep in their order: leaves of one split that agree are taken back, from the bottom up."""
    leaf = tree.left == np.arange(len(tree.left))
    choice = tree.stats.argmax(axis=1)
    for node in range(len(leaf) - 1, -1, -1):
        first = tree.left[node]
        if not leaf[node] and leaf[first] and leaf[first + 1] and choice[first] == choice[first + 1]:
            leaf[node] = True
    kept, level = [np.zeros(1, np.int64)], np.zeros(1, np.int64)
    while len(level):
        first = tree.left[level[~leaf[level]]]
        level = np.stack((first, first + 1), axis=1).ravel()
        kept.append(level)
    tree.left = np.where(leaf, np.arange(len(leaf)), tree.left)
    return np.concatenate(kept)


def _node_rows(number: int, tree: _Nodes, layout: Layout, cuts: Sequence, least: Sequence, impurity: str) -> pa.Table:
    kept = _merged(tree)
    place = np.full(len(tree.left), -1, np.int64)
    place[kept] = np.arange(len(kept))
    inner = tree.left[kept] != kept
    left = np.where(inner, place[tree.left[kept]], -1)
    stats = tree.stats[kept]
    splits = []
    for is_inner, feature, code in zip(inner.tolist(), tree.feature[kept].tolist(), tree.code[kept].tolist()):
        if not is_inner:
            splits.append((-1, [], -1))
        elif feature < layout.numbers:
            splits.append((feature, [_threshold(cuts[feature], least[feature], code)], -1))
        else:
            splits.append((feature, [0.0], 2))
    names = ("featureIndex", "leftCategoriesOrThreshold", "numCategories")
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(np.arange(len(kept), dtype=np.int32)),
            pa.array(stats.argmax(axis=1).astype(float)),
            pa.array(_impurity(stats, impurity)),
            pa.array(stats.tolist(), pa.list_(pa.float64())),
            pa.array(stats.sum(axis=1).astype(np.int64)),
            pa.array(np.where(inner, tree.gain[kept], -1.0)),
            pa.array(left.astype(np.int32)),
            pa.array(np.where(inner, left + 1, -1).astype(np.int32)),
            pa.array([dict(zip(names, split)) for split in splits], _SPLIT),
        ],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
    )
    return pa.table({"treeID": pa.array(np.full(len(kept), number, np.int32)), "nodeData": nodes})


def _metadata(spark: SparkSession, name: str, forest: RandomForestClassifier, only: Sequence[str] | None, **more) -> str:
    def named(values: dict) -> dict:
        return {p.name: v for p, v in values.items() if only is None or p.name in only}

    document = {
        "class": f"org.apache.spark.ml.classification.{name}", "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version, "uid": forest.uid if only is None else f"dtc_{uuid4().hex[:12]}",
        "paramMap": named(forest._paramMap), "defaultParamMap": named(forest._defaultParamMap),
    }
    return json.dumps(document | more)


# Where the nodes of a model lie that this session has grown or read.
_stored: WeakKeyDictionary = WeakKeyDictionary()


def _model(
    spark: SparkSession, forest: RandomForestClassifier, trees: Sequence[_Nodes], layout: Layout, cuts: Sequence,
    least: Sequence, classes: int,
) -> RandomForestClassificationModel:
    path = new_path(spark, "forest")
    whole = _metadata(
        spark, "RandomForestClassificationModel", forest, None,
        numFeatures=layout.features, numClasses=classes, numTrees=len(trees),
    )
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [
        (k, _metadata(spark, "DecisionTreeClassificationModel", forest, _OF_TREES), 1.0) for k in range(len(trees))
    ]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    impurity = forest.getImpurity().lower()
    nodes = pa.concat_tables(_node_rows(k, tree, layout, cuts, least, impurity) for k, tree in enumerate(trees))
    spark.createDataFrame(nodes).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    _stored[model] = path
    return model


def grow(
    rows: DataFrame, forests: Sequence[RandomForestClassifier], layout: Layout
) -> list[RandomForestClassificationModel]:
    """One model per forest, each with its own number of trees, seed and output columns.

    ``rows`` has the column ``features`` and the label, and is read three times, so it
    should be a stored table.  Its vectors are as ``layout`` says.  Numbers of more values
    than bins are cut at quantiles of all rows.
    """
    spark, example = rows.sparkSession, forests[0]
    for forest in forests:
        forest._transfer_params_to_java()  # Spark refuses values out of bounds
    labels, values = _survey(rows, example.getLabelCol(), layout, example.getMaxBins())
    if not labels:
        raise ValueError("no rows to train on")
    odd = [name for name in labels if name is None or name < 0 or name != int(name)]
    if odd:
        raise ValueError(f"labels must be whole numbers from 0 on: {odd[0]}")
    classes = max(2, int(max(labels)) + 1)
    cuts = _cuts(rows, values, example.getMaxBins())
    blocks, least = _packed(rows, example.getLabelCol(), layout, cuts)
    grown = _grown(blocks, forests, layout, cuts, classes)
    return [_model(spark, forest, trees, layout, cuts, least, classes) for forest, trees in zip(forests, grown)]


# --- scores ---


@dataclass(frozen=True)
class _Scorer:
    """The trees of a model: nodes as in ``_Nodes``, and the share of each class at a leaf.

    A row goes right if the code of its value is above ``base``: the number of thresholds
    of the feature that are less than the value.
    """

    features: int
    slots: np.ndarray  # by feature: its row of codes, or -1
    thresholds: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]

    def codes(self, vectors: pa.StructArray) -> np.ndarray:
        row, feature, value = _entries(vectors)
        slot = self.slots[feature]
        used = slot >= 0
        found = np.zeros((len(self.thresholds), len(vectors)))
        found[slot[used], row[used]] = value[used]
        codes = np.empty(found.shape, np.int32)
        for k, cut in enumerate(self.thresholds):
            codes[k] = found[k] > cut[0] if len(cut) == 1 else np.searchsorted(cut, found[k])
        return codes

    def votes(self, vectors: pa.StructArray) -> np.ndarray:
        """Per class and row the sum of the shares over all trees, in their order."""
        rows, flat, at = len(vectors), self.codes(vectors).ravel(), np.arange(len(vectors))
        classes = self.trees[0][3].shape[1]
        found = np.zeros((classes, rows))
        for column, base, left, shares, depth in self.trees:
            offset = column * rows
            node = np.zeros(rows, np.int64)
            for _ in range(depth):
                place = offset.take(node)
                place += at
                right = flat.take(place, mode="clip") > base.take(node)
                node = left.take(node)
                node += right
            for k in range(classes):
                found[k] += shares[:, k].take(node)
        return found


def _nodes(model: RandomForestClassificationModel) -> pa.Table:
    """The stored nodes of a model, which is stored once if it is not yet."""
    spark = SparkSession.getActiveSession()
    if model not in _stored:
        path = new_path(spark, "forest")
        model.save(path)
        _stored[model] = path
    node = F.col("nodeData")
    table = spark.read.parquet(f"{_stored[model]}/data").select(
        "treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), node["split"]["leftCategoriesOrThreshold"].alias("cut"),
        node["split"]["numCategories"].alias("categories"), node["impurityStats"].alias("stats"),
    )
    return table.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])


def _scorer(models: Sequence[RandomForestClassificationModel]) -> _Scorer:
    trees, cuts = [], {}
    for model in models:
        nodes = _nodes(model)
        tree = nodes["treeID"].to_numpy()
        columns = [nodes[c].to_numpy() for c in ("left", "right", "feature", "categories")]
        lists = nodes["cut"].to_pylist()
        stats = np.array(nodes["stats"].to_pylist(), float)
        borders = np.flatnonzero(np.diff(tree, prepend=-1, append=-1))
        for start, end in zip(borders[:-1].tolist(), borders[1:].tolist()):
            left, right, feature, categories = (c[start:end].astype(np.int64) for c in columns)
            if (categories > 2).any():
                raise ValueError("splits of more than two categories are not supported")
            cut = np.array([c[0] if c else 0.0 for c in lists[start:end]])
            hot = categories == 2
            # Of two categories the one on the left may be 1.
            swapped = hot & (cut == 1.0)
            left, right = np.where(swapped, right, left), np.where(swapped, left, right)
            cut = np.where(hot, 0.5, cut)
            for f in np.unique(feature[left >= 0]).tolist():
                cuts.setdefault(f, []).append(cut[(feature == f) & (left >= 0)])
            trees.append((left, right, feature, cut, stats[start:end]))
    features = models[0].numFeatures
    used = sorted(cuts)
    slots = np.full(max(features, 1), -1)
    slots[used] = np.arange(len(used))
    thresholds = [np.unique(np.concatenate(cuts[f])) for f in used] or [np.zeros(1)]
    walks = []
    for left, right, feature, cut, stats in trees:
        order, level, depth = [np.zeros(1, np.int64)], np.zeros(1, np.int64), 0
        while len(level := level[left[level] >= 0]):
            level = np.stack((left[level], right[level]), axis=1).ravel()
            order.append(level)
            depth += 1
        order = np.concatenate(order)
        place = np.empty(len(left), np.int64)
        place[order] = np.arange(len(order))
        inner = left[order] >= 0
        following = np.where(inner, place[left[order]], np.arange(len(order)))
        column = np.where(inner, slots[feature[order]], 0)
        base = np.full(len(order), np.iinfo(np.int32).max, np.int32)
        for f in np.unique(feature[order][inner]).tolist():
            these = inner & (feature[order] == f)
            base[these] = np.searchsorted(thresholds[slots[f]], cut[order][these])
        total = stats.sum(axis=1, keepdims=True)
        shares = (stats / np.where(total > 0, total, 1))[order]
        walks.append((column, base, following, shares, depth))
    return _Scorer(features, slots, thresholds, walks)


def scores(models: Sequence[RandomForestClassificationModel], vectors: Column) -> Column:
    """(prediction, probability) of the vectors: the class with most votes of all trees, and the share of class 1."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(cloudpickle.dumps(_scorer(models)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = pickle.loads(sent.value)
        for batch in batches:
            found = [scorer.votes(part) for part in _slices(batch, len(scorer.thresholds))]
            votes = np.concatenate(found, axis=1) if found else np.zeros((2, 0))
            total = votes.sum(axis=0)
            yield pa.StructArray.from_arrays(
                [pa.array(votes.argmax(axis=0).astype(np.int32)), pa.array(votes[1] / np.where(total > 0, total, 1))],
                ["prediction", "probability"],
            )

    return F.arrow_udf(run, "prediction int, probability double")(F.unwrap_udt(vectors))
