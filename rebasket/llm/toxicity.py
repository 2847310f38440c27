"""Toxicity scores by FTRL-proximal logistic regression on hashed words (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebasket.llm.text import give_back, mixed, numbered, per_text, plain_words, slices, word_hashes
from rebasket.session import hand_over

HASH_BITS = 20
SAMPLE_ROWS = 30_000
"""Labelled rows the classifier learns from at most, chosen by a hash of doc_id."""
WORKERS = 2
"""Tasks that learn side by side; their states are averaged."""
THRESHOLD = 0.3


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    epochs: int = 4

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """L1 makes every coordinate of a small gradient sum exactly zero."""
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def features(texts: list[bytes | None]) -> list[np.ndarray]:
    """The distinct hashed words, word pairs and pairs with a gap of one of each text.

    Coordinate 0 is the constant and stands first in every text.
    """
    codes, starts, distinct = numbered([plain_words(t) for t in texts])
    hashed = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - HASH_BITS)
    one = mixed(hashed + np.uint64(1)) >> shift
    two = mixed(mixed(hashed[:-1] + np.uint64(2)) + hashed[1:]) >> shift
    gap = mixed(mixed(hashed[:-2] + np.uint64(3)) + hashed[2:]) >> shift
    found = []
    for b, e in zip(starts[:-1], starts[1:]):
        own = np.concatenate((one[b:e], two[b : max(e - 1, b)], gap[b : max(e - 2, b)]))
        own = np.unique(own).astype(np.int64)
        found.append(np.concatenate(([0], own[own > 0])))
    return found


def learn(rows: list[np.ndarray], labels: list[int], settings: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """The state (z, n) after ``epochs`` passes, one example at a time."""
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    for _ in range(settings.epochs):
        for own, label in zip(rows, labels):
            w = settings.weights(z[own], n[own])
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label
            step = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / settings.alpha
            z[own] += g - step * w
            n[own] += g * g
    return z, n


def labelled_sample(labels: DataFrame, usable: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the same on every run; of several labels the larger holds."""
    known = labels.filter(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, settings: Ftrl = Ftrl(), rows: int = SAMPLE_ROWS
) -> dict[str, np.ndarray]:
    """The weights that are not zero: ``index`` ascending and ``weight``.

    ``usable`` tells the rows of ``labels`` (doc_id, toxic) to learn from.  The
    sample of ids has a bounded size and goes to the documents, whose other rows
    are not moved; of several texts of an id the smallest by its bytes is learned.
    Each worker learns from its share; z and n are averaged over the workers that
    got any.
    """
    sample = labelled_sample(labels, usable, rows)
    chosen = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .repartition(WORKERS, F.xxhash64("doc_id"))
        .sortWithinPartitions(F.xxhash64("doc_id", "text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[np.ndarray] = []
        marks: list[int] = []
        for part in slices(batches):
            known += [f.astype(np.int32) for f in features(part.column("text").to_pylist())]
            marks += [int(t > 0) for t in part.column("toxic").to_pylist()]
        if known:
            z, n = learn(known, marks, settings)
            index = np.flatnonzero(n)
            known.clear()
            yield pa.RecordBatch.from_pydict({"index": index, "z": z[index], "n": n[index]})
            del z, n, index
            give_back()

    learned = chosen.mapInArrow(run, "index long, z double, n double")
    states = hand_over(learned, "learned-states").read(docs.sparkSession)
    workers = max(states.filter(F.col("index") == 0).count(), 1)  # every text holds coordinate 0
    mean = states.groupBy("index").agg((F.sum("z") / workers).alias("z"), (F.sum("n") / workers).alias("n"))
    # What L1 leaves at zero never reaches the driver.
    merged = mean.filter(F.abs("z") > settings.l1).orderBy("index").toArrow()
    z, n = merged["z"].to_numpy(), merged["n"].to_numpy()
    return {"index": merged["index"].to_numpy(), "weight": settings.weights(z, n)}


def score_toxicity(docs: DataFrame, model: dict[str, np.ndarray], *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, score (0 to 1) and predicted (score at least ``threshold``) of every whole ``text``.

    The weights are sparse and bounded by the hash space, and are broadcast.
    Null and empty texts get the score of the constant alone.  Repeated rows get
    the same score; no row leaves its task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    state: list[np.ndarray] = []

    def work(texts: list[bytes | None]) -> dict[str, object]:
        if not state:
            dense = np.zeros(1 << HASH_BITS)
            dense[sent.value["index"]] = sent.value["weight"]
            state.append(dense)
        sums = np.array([state[0][f].sum() for f in features(texts)])
        return {"score": 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))}

    scored = per_text(docs, "score double", work, *(keep or ("doc_id",)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``threshold``."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col("text").alias("own"), "text")
    kept = score_toxicity(rows, model, "row", "own", threshold=threshold).filter("predicted = 0")
    columns = [F.col("own").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return kept.select(*columns)


def held_out() -> Column:
    """Rows whose labels no model may see; a row without doc_id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
