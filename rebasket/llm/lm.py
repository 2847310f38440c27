"""Scores of whole texts by a recurrent language model (operator 5)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebasket.llm import gru
from rebasket.llm.text import numbered, slices, spaced_words, with_bytes
from rebasket.session import hand_over

HEAD_WORDS = 200_000
"""Most words whose counts are sent to all tasks; the counts of others are joined."""
HEAD_BYTES = 64
"""Longer words are never sent, so the head has a bounded size."""
SEGMENT = 256
WARM_SEGMENTS = 4096
"""Segments from which one task makes the weights that all workers start from."""
WORKER_SEGMENTS = 8192
BUFFER_TOKENS = 1_500_000
FAN_IN = 32
"""Sets of weights that one step averages."""
_SEEDS = (1 << 64) - 1
END_WORD = b""
"""No word is empty, so the end of a text is counted under this one."""


def training() -> Column:
    """Rows to learn from: all but those held out."""
    return ~held_out()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """word (bytes) and count over all texts of ``docs``, the end of every text included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(spaced_words(text))
            counts[END_WORD] += part.num_rows
            if len(counts) > 400_000:
                yield _counted(counts)
                counts = Counter()
        if counts:
            yield _counted(counts)

    partial = with_bytes(docs).mapInArrow(run, "word binary, count long")
    return partial.groupBy("word").agg(F.sum("count").alias("count"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"word": pa.array(list(counts), pa.binary()), "count": pa.array(list(counts.values()), pa.int64())}
    )


@dataclass(frozen=True)
class Vocabulary:
    """What the training texts say about tokens, of bounded size."""

    head: dict[bytes, int]  # counts of the frequent words and of the end
    least: int  # every shorter word with at least this count is in the head
    total: int  # N
    distinct: int  # V
    codes: dict[bytes, int]  # the model's number of its words
    log_share: np.ndarray  # natural log of the smoothed share of each model token

    @property
    def norm(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def rest(self) -> float:
        """Smoothed count of all tokens that the model does not tell apart."""
        return float(np.exp(self.log_share[gru.UNKNOWN]) * self.norm)


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Vocabulary:
    """From a stored count table; the driver gets a histogram of counts and the head."""
    sums = counts.agg(F.sum("count"), F.count(F.lit(1))).first()
    total, distinct = int(sums[0] or 0), int(sums[1])
    ends = counts.filter(F.octet_length("word") == 0).first()
    short = counts.filter(F.octet_length("word") <= HEAD_BYTES)
    histogram = sorted(((r[0], r[1]) for r in short.groupBy("count").count().collect()), reverse=True)
    least, held = 0, 0
    for count, words in histogram:
        if held + words > head_words:
            break
        least, held = count, held + words
    least = least or (histogram[0][0] + 1 if histogram else 1)
    rows = short.filter(F.col("count") >= least).toArrow().to_pydict()
    head = dict(zip(rows["word"], rows["count"])) | ({END_WORD: ends["count"]} if ends else {})
    ranked = sorted((w for w in head if w != END_WORD), key=lambda w: (-head[w], w))[: gru.WORDS - 2]
    codes = {w: k + 2 for k, w in enumerate(ranked)} | {END_WORD: gru.END}
    norm = total + 0.5 * (distinct + 1)
    share = np.zeros(gru.WORDS)
    for word, code in codes.items():
        if word in head:
            share[code] = (head[word] + 0.5) / norm
    share[gru.UNKNOWN] = max(1.0 - share.sum(), 0.5 / norm)
    if END_WORD not in head:  # no training text: the end is one of the unknown tokens
        share[gru.END] = share[gru.UNKNOWN] = share[gru.UNKNOWN] / 2
    with np.errstate(divide="ignore"):
        return Vocabulary(head, least, total, distinct, codes, np.log(share))


def _coded(texts: list[list[bytes]], codes: dict[bytes, int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[bytes]]:
    """Model numbers of each text with its end; and the words' numbers, starts and distinct words."""
    flat, starts, distinct = numbered(texts)
    table = np.fromiter((codes.get(w, gru.UNKNOWN) for w in distinct), np.int16, len(distinct))
    coded = table[flat] if len(flat) else np.zeros(0, np.int16)
    end = np.full(1, gru.END, np.int16)
    return [np.concatenate((coded[b:e], end)) for b, e in zip(starts[:-1], starts[1:])], flat, starts, distinct


def _segments(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """order and tokens of every segment of all texts; the order, a hash with the doc_id, spreads copies.

    It depends on the rows alone, not on how they are spread.  Rows of equal
    doc_id and text go to one worker, which reads them as a stream.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known.codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = sent.value
        for part in slices(batches):
            orders, tokens = [], []
            for text, seed in zip(part.column("text").to_pylist(), part.column("seed").to_pylist()):
                words = [*spaced_words(text), END_WORD]
                for at in range(0, len(words), SEGMENT):
                    own = words[at : at + SEGMENT]
                    orders.append(xxhash.xxh3_64_intdigest(b" ".join(own), (seed + at) & _SEEDS))
                    tokens.append(np.fromiter((codes.get(w, gru.UNKNOWN) for w in own), np.int16, len(own)).tobytes())
            order = (np.array(orders, np.uint64) >> np.uint64(2)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"order": order, "tokens": pa.array(tokens, pa.binary())})

    seeded = docs.select("text", F.xxhash64("doc_id").alias("seed"))
    return with_bytes(seeded, "seed").mapInArrow(run, "order long, tokens binary")


def _trained(segments: DataFrame, start: bytes, rate: float) -> DataFrame:
    """A row per task: its number, the tokens it learned from and the weights it came to."""
    sent = segments.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, held = gru.Trainer(gru.unpacked(sent.value), rate), []
        for batch in batches:
            held += [np.frombuffer(t, np.int16) for t in batch.column("tokens").to_pylist()]
            while len(held) >= WORKER_SEGMENTS // 2:
                trainer.learn(held[: WORKER_SEGMENTS // 2])
                held = held[WORKER_SEGMENTS // 2 :]
        if held:
            trainer.learn(held)
        if trainer.tokens:
            yield pa.RecordBatch.from_pydict({"n": [trainer.tokens], "weights": pa.array([gru.packed(trainer.model)], pa.binary())})

    return segments.mapInArrow(run, "n long, weights binary")


def _mean(frames: list[tuple[int, bytes]]) -> tuple[int, bytes]:
    total = sum(n for n, _ in frames)
    flat = sum(np.frombuffer(w, np.float32).astype(np.float64) * (n / total) for n, w in frames)
    return total, flat.astype(np.float32).tobytes()


def _averaged(trained: DataFrame, workers: int) -> bytes | None:
    """The mean weights, by tokens; averaged in a tree, so one set reaches the driver."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        n, weights = _mean(list(zip(frame["n"].tolist(), frame["weights"].tolist())))
        return pd.DataFrame({"part": [frame["above"].iloc[0]], "n": [n], "weights": [weights]})

    level = trained.select(F.spark_partition_id().cast("long").alias("part"), "n", "weights")
    while workers > 1:
        above = level.withColumn("above", F.floor(F.col("part") / FAN_IN))
        level = above.groupBy("above").applyInPandas(merge, "part long, n long, weights binary")
        workers = -(-workers // FAN_IN)
    rows = [(r["n"], bytes(r["weights"])) for r in level.orderBy("part").collect()]
    return _mean(rows)[1] if rows else None


def fit(docs: DataFrame, known: Vocabulary) -> bytes:
    """The weights of the recurrent model, learned from ``docs``.

    One task warms the weights up on a bounded share of the segments; then each
    worker learns from its part and the weights are averaged, so the work is
    spread and grows with the input.  Every segment is learned from.  The number
    of workers follows from the segments alone, so the weights do not depend on
    the cluster.
    """
    start = gru.packed(gru.fresh(known.log_share))
    segments = hand_over(_segments(docs, known), "segments").read(docs.sparkSession)
    count = segments.count()
    if not count:
        return start
    edge = int(min(WARM_SEGMENTS / count, 1.0) * (1 << 62))
    warm = segments.filter(F.col("order") <= edge).repartition(1).sortWithinPartitions("order", "tokens")
    start = _averaged(_trained(warm, start, gru.RATE), 1) or start
    workers = -(-count // WORKER_SEGMENTS)
    dealt = segments.repartition(workers, "order").sortWithinPartitions("order", "tokens")
    return _averaged(_trained(dealt, start, gru.RATE / 2), workers) or start


def _scored(docs: DataFrame, known: Vocabulary, weights: bytes, *keep: str) -> DataFrame:
    """Per row what the head tells: counts, base and model sums, and the words to be looked up."""
    sent = docs.sparkSession.sparkContext.broadcast((known, weights))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def finished(model, rows: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        found = gru.score(model, texts) / np.log(10)
        merged = {n: pa.concat_arrays([r[n] for r in rows]) for n in rows[0]}
        merged["score"] = pa.array(merged["score"].to_numpy() + found)
        return pa.RecordBatch.from_pydict(merged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = sent.value[0], gru.unpacked(sent.value[1])
        rows, texts, held = [], [], 0
        for part in slices(batches):
            own, row = _looked_up(part, vocabulary)
            rows.append({k: part.column(k) for k in keep} | row)
            texts += own
            held += sum(map(len, own))
            if held >= BUFFER_TOKENS:
                yield finished(model, rows, texts)
                rows, texts, held = [], [], 0
        if texts:
            yield finished(model, rows, texts)

    return with_bytes(docs, *keep).mapInArrow(
        run,
        f"{kinds}, n_tokens long, n_known long, base_score double, score double, rare array<struct<word: binary, n: bigint>>",
    )


_RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _looked_up(part: pa.RecordBatch, known: Vocabulary) -> tuple[list[np.ndarray], dict[str, pa.Array]]:
    words = [spaced_words(t) for t in part.column("text").to_pylist()]
    coded, flat, starts, distinct = _coded(words, known.codes)
    counts = np.fromiter((known.head.get(w, -1) for w in distinct), np.int64, len(distinct))
    logs = np.where(counts >= 0, np.log10(np.maximum(counts, 0) + 0.5), 0.0)
    outside = np.fromiter((w not in known.codes for w in distinct), bool, len(distinct))
    end = known.head.get(END_WORD, 0)
    rest = np.log10(known.rest)
    n_known, base, score, rare = [], [], [], []
    for begin, stop, own in zip(starts[:-1], starts[1:], words):
        codes = flat[begin:stop]
        seen = counts[codes] >= 0
        n_known.append(int(seen.sum()) + (end > 0))
        logged = logs[codes]
        base.append(float(logged.sum()) + np.log10(end + 0.5) - (len(own) + 1) * np.log10(known.norm))
        unknown = outside[codes]
        score.append(float(logged[unknown].sum()) - int(unknown.sum()) * rest)
        missing = Counter(own[k] for k in np.flatnonzero(~seen).tolist())
        rare.append([{"word": w, "n": n} for w, n in missing.items()])
    return coded, {
        "n_tokens": pa.array([len(w) + 1 for w in words], pa.int64()),
        "n_known": pa.array(n_known, pa.int64()),
        "base_score": pa.array(base, pa.float64()),
        "score": pa.array(score, pa.float64()),
        "rare": pa.array(rare, _RARE),
    }


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are the lower-cased words between white space and one end.  Counts
    cover all training rows (those not ``held_out``; a row without doc_id is one).
    ``base_score`` adds log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens.
    ``score`` is the model's log10 probability: the recurrent network tells
    2,046 words, the end and "another word" apart, its state runs through the
    whole text, and another word gets its smoothed share of the others' counts,
    so all probabilities of a token add up to one.

    The counts of frequent words go to all tasks; those of other words are
    joined to the rows that hold them.  Null and empty texts are their end
    alone; without training rows all counts are zero.  Repeated rows are
    scored alike.
    """
    spark = docs.sparkSession
    train = docs.filter(training())
    counts = hand_over(token_counts(train), "token_counts").read(spark)
    known = vocabulary(counts)
    weights = fit(train, known)
    keyed = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    rows = hand_over(_scored(keyed, known, weights, "row", "doc_id"), "scored").read(spark)
    head = (F.octet_length("word") <= HEAD_BYTES) & (F.col("count") >= known.least)
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    looked = rare.join(counts.filter(~head), "word", "left").select(
        "row",
        "n",
        F.when(F.col("count").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + 0.5)).alias("logged"),
    )
    added = looked.groupBy("row").agg(F.sum("known").alias("known"), F.sum("logged").alias("logged"))
    held = F.coalesce("logged", F.lit(0.0))
    return rows.join(added, "row", "left").select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + held).alias("base_score"),
        (F.col("score") + held).alias("score"),
    )
