"""Near duplicates of whole documents by SetSketch registers (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.llm.links import link_classes, shared_buckets
from rebasket.llm.membership import holds, membership
from rebasket.llm.text import mixed, per_text, shingle_sets, slices, spaced_words
from rebasket.session import hand_over

BASE = 1.02
"""Registers are whole powers of this base."""
LEVELS = (1 << 16) - 1
SHIFT = 256
"""Registers count from this power, so that every size of set fits between 0 and LEVELS."""
BANDS = 32
BAND_REGISTERS = 4
"""A pair of similarity 0.8 shares no band with a probability of 5e-8."""
MARGIN = 0.15
"""A pair is verified if its estimate reaches the threshold less this; over 4 deviations."""
BITS_APART = 29
"""Of one bit per register, similar sets of 0.8 differ in 13 with a deviation of 3.4."""

_REGISTERS = BANDS * BAND_REGISTERS
_ODD = mixed(np.arange(1, _REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mixed(np.arange(1001, _REGISTERS + 1001, dtype=np.uint64))


def registers(sets: list[np.ndarray]) -> tuple[list[bytes | None], np.ndarray]:
    """The registers of each set, two bytes each: level of its least of so many hashed minima.

    And one bit of each minimum, 64 in each of two longs.
    """
    filled = [k for k, s in enumerate(sets) if len(s)]
    out: list[bytes | None] = [None] * len(sets)
    bits = np.zeros((len(sets), 2), np.int64)
    if not filled:
        return out, bits
    values = np.concatenate([sets[k] for k in filled])
    starts = np.concatenate(([0], np.cumsum([len(sets[k]) for k in filled])[:-1]))
    least = np.empty((_REGISTERS, len(filled)), np.uint64)
    for r in range(_REGISTERS):
        least[r] = np.minimum.reduceat(values * _ODD[r] + _ADD[r], starts)
    share = (least.T.astype(np.float64) + 0.5) / 2.0**64
    arrival = -np.log1p(-np.minimum(share, 1 - 1e-16))
    level = np.floor(1 + SHIFT - np.log(arrival) / np.log(BASE))
    packed = np.clip(level, 0, LEVELS).astype(">u2")
    for k, row in zip(filled, packed):
        out[k] = row.tobytes()
    odd = (mixed(least.T) & np.uint64(1)).astype(np.uint8)
    bits[filled] = np.ascontiguousarray(np.packbits(odd, axis=1)).view(">i8").astype(np.int64)
    return out, bits


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest similarity given how many registers of a are larger, smaller and equal.

    The sizes are known exactly, so one parameter is left; it is searched on a
    grid of hundredths up to what the sizes allow.
    """
    larger = (a > b).sum(axis=1)[:, None]
    smaller = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - larger - smaller
    share = (n_a / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 101)[None, :]

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up = np.maximum(chance(share - (1 - share) * grid), 1e-12)
    down = np.maximum(chance((1 - share) - share * grid), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    score = larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)
    possible = grid <= np.minimum(share / (1 - share), (1 - share) / share) + 0.01
    return grid[0][np.argmax(np.where(possible, score, -np.inf), axis=1)]


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (of the distinct shingles), registers and bits of every row."""

    def work(texts: list[bytes | None]) -> dict[str, object]:
        sets = shingle_sets([spaced_words(t) for t in texts], width)
        filled, bits = registers(sets)
        return {
            "n_shingles": np.array([len(s) for s in sets], np.int64),
            "set_key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            "registers": pa.array(filled, pa.binary()),
            "bits0": bits[:, 0].copy(),
            "bits1": bits[:, 1].copy(),
        }

    schema = "n_shingles long, set_key binary, registers binary, bits0 long, bits1 long"
    return per_text(docs, schema, work, "doc_id")


def _candidate_texts(docs: DataFrame, reps: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """node and text of the nodes that share a bucket; other texts stay where they are."""
    nodes = hand_over(members.select("node").distinct(), "nodes").read(docs.sparkSession)
    hashes = nodes.select(F.xxhash64("node").alias("hash"))
    filtered = holds(docs.filter("doc_id is not null"), membership(hashes, nodes.count()), F.xxhash64("doc_id"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets([spaced_words(t) for t in part.column("text").to_pylist()], width)
            key = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_pydict(
                {"node": part.column("node"), "text": part.column("text"), "set_key": key}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = filtered.select(F.col("doc_id").alias("node"), F.col("text").cast("binary").alias("text")).mapInArrow(
        keys, f"node {kind}, text binary, set_key binary"
    )
    # A doc_id may stand on several texts; the node is the one with its set.
    wanted = reps.join(nodes, "node", "left_semi").select("node", "set_key")
    return keyed.join(wanted, ["node", "set_key"]).select("node", "text").dropDuplicates(["node"])


def _verify(pairs: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    least = percent / 100 - MARGIN

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(-1, _REGISTERS).astype(np.int32)
                for c in ("regs_a", "regs_b")
            ]
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
            likely = joint_estimate(*sides, *sizes) >= least
            yield batch.select(["a", "b"]).filter(pa.array(likely))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            columns = [part.column(c).to_pylist() for c in ("a", "text_a", "b", "text")]
            known = dict(zip(columns[0], columns[1])) | dict(zip(columns[2], columns[3]))
            sets = dict(zip(known, shingle_sets([spaced_words(t) for t in known.values()], width)))
            held = []
            for a, b in zip(columns[0], columns[2]):
                inter = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                held.append(100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter))
            yield part.select(["a", "b"]).filter(pa.array(held))

    sized = reps.select("node", "n_shingles", "registers")
    a = sized.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("registers").alias("regs_a"))
    b = sized.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("registers").alias("regs_b"))
    # No pair above the threshold has sizes further apart than the threshold.
    close = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    likely = pairs.join(a, "a").join(b, "b").filter(close).mapInArrow(estimate, "a long, b long")
    both = likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), "text"), "b"
    )
    return both.mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Rows are linked if 100 * shared >= ``percent`` * all of their distinct
    ``width``-word shingles, and classes are what links connect; component_id is
    the smallest doc_id of the class.  Rows of equal sets are one node.  Nodes
    that agree in a band of registers are candidates; the joint estimate drops
    unlikely pairs and whole texts confirm the others (see ``links`` for how
    buckets of any size are worked off).

    A text of fewer words has its whole sequence as one shingle; null and empty
    texts have none and are linked with nothing.  Rows of one doc_id are one
    document.  A row without doc_id is linked with nothing, has no component_id
    and is kept.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = hand_over(sketch(ids, width), "sketches").read(spark)
    known = sketches.filter("n_shingles > 0 and doc_id is not null")
    reps = known.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n_shingles", "registers", "bits0", "bits1")]
    )
    reps = hand_over(reps, "representatives").read(spark)
    named = known.select("doc_id", "set_key").join(reps.select("set_key", "node"), "set_key").select("doc_id", "node")
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("most")).filter("a < most")
    more = hand_over(
        named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")), "same_id"
    ).read(spark)
    band = 2 * BAND_REGISTERS
    buckets = reps.select(
        "node",
        F.col("n_shingles").alias("size"),
        F.explode(
            F.array(*[F.xxhash64(F.lit(k), F.substring("registers", k * band + 1, band)) for k in range(BANDS)])
        ).alias("bucket"),
    )
    shared = hand_over(shared_buckets(buckets), "members").read(spark)
    texts = hand_over(_candidate_texts(ids, reps, shared, width), "texts").read(spark)
    members = shared.join(reps.select("node", "bits0", "bits1"), "node")
    classes = link_classes(
        members,
        lambda pairs: _verify(pairs, reps, texts, width, percent),
        None if more.isEmpty() else more,
        percent,
        BITS_APART,
    )
    component = (
        reps.select("set_key", "node")
        .join(classes, "node", "left")
        .select("set_key", F.coalesce("component", "node").alias("component"))
    )
    joined = sketches.join(component.withColumnRenamed("set_key", "key"), F.expr("n_shingles > 0 and set_key = key"), "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        found.alias("component_id"),
        F.coalesce(found == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one_per_class(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without near duplicates of a kept one.

    Of a class the row of the smallest doc_id stays; of several rows of that
    doc_id one does, the same on every run unless they are alike in all columns'
    text forms.  Rows without doc_id all stay.
    """
    found = hand_over(near_duplicates(docs, width, percent), "classes").read(docs.sparkSession)
    gone = found.filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    left = docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
    repeated = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    again = hand_over(repeated.select(F.col("doc_id").alias("again")), "repeated").read(docs.sparkSession)
    if not again.limit(1).count():
        return left
    single = left.join(again, left["doc_id"].cast("long") == again["again"], "left_anti")
    several = left.join(again, left["doc_id"].cast("long") == again["again"], "left_semi")
    names = [F.col(f"`{c}`") for c in docs.columns]
    first = several.groupBy("doc_id").agg(F.min_by(F.struct(*names), F.struct(F.xxhash64(*names), "text")).alias("r"))
    return single.unionByName(first.select(*[F.col(f"r.`{c}`").alias(c) for c in docs.columns]))
