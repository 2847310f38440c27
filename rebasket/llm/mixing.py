"""Mixing sources to target weights from packed blocks (operator 1)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.llm.prefix import with_offset
from rebasket.llm.text import mixed, slices, with_bytes
from rebasket.session import Handover, hand_over, spread_rows

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
"""A source gives each of its words this often at most."""
BLOCK_WORDS = 256
SHARD_SLOTS = 65_536
GROUP_SHARDS = 1024
"""Output shards whose source counts one task draws."""
SEED = 20_240_601

_WORD = r"[^\x20\x09-\x0D]+"
_FIND = re.compile(rb"[^\x20\x09-\x0D]+")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: int) -> list[float]:
    """Words wanted of each source: ``share`` of all words by weight, at most ``most`` times its size.

    What a capped source cannot give is shared again by weight among the others.
    """
    wanted = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), [k for k in range(len(sizes)) if sizes[k] > 0]
    while open_:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if left * weights[k] / total > most * sizes[k]]
        if not full:
            for k in open_:
                wanted[k] = left * weights[k] / total
            break
        for k in full:
            wanted[k] = float(most * sizes[k])
        left -= sum(most * sizes[k] for k in full)
        open_ = [k for k in open_ if k not in set(full)]
    return wanted


class Permutation:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked on until below n."""

    def __init__(self, n: int, *key: int):
        self.n = n
        self.half = np.uint64(max((max(n - 1, 1).bit_length() + 1) // 2, 1))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        base = np.array([SEED], np.uint64)
        for k in key:
            base = mixed(base * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        self.keys = [mixed(base + np.uint64(r)) for r in range(1, 5)]

    def _walk(self, x: np.ndarray, rounds, backwards: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in rounds:
            if backwards:
                left, right = right ^ (mixed(left + key) & self.mask), left
            else:
                left, right = right, left ^ (mixed(right + key) & self.mask)
        return (left << self.half) | right

    def _apply(self, x, backwards: bool) -> np.ndarray:
        x = np.atleast_1d(np.asarray(x)).astype(np.uint64)
        rounds = self.keys[::-1] if backwards else self.keys
        out = self._walk(x, rounds, backwards)
        outside = np.flatnonzero(out >= self.n)
        while len(outside):
            out[outside] = self._walk(out[outside], rounds, backwards)
            outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def __call__(self, x) -> np.ndarray:
        return self._apply(x, False)

    def inverse(self, x) -> np.ndarray:
        return self._apply(x, True)


@dataclass(frozen=True)
class Source:
    """What one source gives: blocks, and slots that the mix fills from it."""

    number: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int
    cut: int
    """Words by which the last slot is short of its block."""


def plan_source(number: int, name: str | None, size: int, target: float, most: int, block: int) -> Source:
    words = min(int(target + 0.5), most * size)
    blocks = -(-size // block)
    passes, rest = divmod(words, size) if size else (0, 0)
    slots, cut = passes * blocks, 0
    if rest:
        short = blocks * block - size  # words that the last block lacks
        at = int(Permutation(blocks, number, passes).inverse(blocks - 1)[0])
        more = -(-rest // block)
        if at < more and more * block - short < rest:
            more += 1
        cut = more * block - (short if at < more else 0) - rest
        slots += more
    return Source(number, name, size, target, blocks, slots, cut)


def draw(counts: np.ndarray, sizes: Sequence[int], *key: int) -> np.ndarray:
    """Multinomial source counts of parts of the given sizes, given the totals of the sources."""
    generator = np.random.Generator(np.random.Philox(key=[SEED, hash_key(*key)]))
    left, rows = counts.astype(np.int64).copy(), []
    for size in sizes:
        row = _hypergeometric(generator, left, size)
        rows.append(row)
        left -= row
    return np.array(rows, np.int64).reshape(len(rows), len(counts))


def _hypergeometric(generator: np.random.Generator, left: np.ndarray, size: int) -> np.ndarray:
    total, row = int(left.sum()), np.zeros(len(left), np.int64)
    for k, own in enumerate(left.tolist()):
        if size and own:
            if total < 1_000_000_000:
                row[k] = generator.hypergeometric(own, total - own, size) if total > own else size
            else:  # beyond the generator's range the binomial differs by less than a block
                row[k] = min(own, generator.binomial(size, own / total))
            row[k] = max(row[k], size - (total - own))
            size -= int(row[k])
        total -= own
    return row


def hash_key(*key: int) -> int:
    value = np.zeros(1, np.uint64)
    for k in key:
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
    return int(value[0])


@dataclass(frozen=True)
class Mix:
    sources: list[Source]
    rows: Handover
    """The input rows with _source, _size and _offset, their place among the source's words."""
    pieces: DataFrame
    """shard, slot, begin (in the slot), source, pass, offset, first_word, n_words: one per part of a document."""


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, source, and _size: the words of ``text``."""
    return docs.select(
        *keep,
        "source",
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("_size"),
        F.xxhash64("text").alias("_text"),
    )


def mix(
    docs: DataFrame,
    *keep: str,
    weight: Callable[[int], float] = lambda k: WEIGHTS[k % len(WEIGHTS)],
    share: float = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    store_sizes: bool = True,
) -> Mix:
    """Draws blocks of ``block_words`` words from every source until its target is met.

    ``docs`` has doc_id, source and text.  Sources are numbered by code point,
    the null source last, and ``weight`` gives the weight of each number.  The
    words of a source, documents in a fixed hashed order, are cut into blocks of
    equal length (the last may be shorter).  Each output shard gets multinomial
    source counts, drawn given the totals that meet the targets, so that no
    drawing error is left.  Slot j of a source takes the block that a keyed
    permutation of all its blocks gives for j, a new permutation in each pass;
    the last slot is cut to meet the target to the word.  Slots and the
    documents' pieces are joined by source and block.

    ``store_sizes`` writes the measured rows once; without, ``docs`` is read again,
    which is better for rows that carry their texts.

    Null and empty texts and sources without words give nothing.  Repeated rows
    and doc_ids are separate rows.  Reruns give the same mix.  Only sizes per
    source and source counts per 1,024 shards pass the driver.
    """
    spark = docs.sparkSession
    sized = measure(spread_rows(docs), *keep, *(["doc_id"] if "doc_id" not in keep else []))
    if store_sizes:
        sized = hand_over(sized, "sizes").read(spark)
    sums = {r[0]: r[1] for r in sized.groupBy("source").agg(F.sum("_size")).collect()}
    names = sorted((n for n in sums if n is not None)) + [None] * (None in sums)
    sizes = [sums[n] for n in names]
    wanted = targets(sizes, [weight(k) for k in range(len(names))], share, most)
    sources = [
        plan_source(k, n, s, t, most, block_words) for k, (n, s, t) in enumerate(zip(names, sizes, wanted))
    ]
    numbers = spark.createDataFrame([(s.number, s.name) for s in sources], "_source int, _name string")
    placed = with_offset(
        sized.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("_name"))).drop("_name"),
        "_source",
        F.col("_size"),
        ["doc_id", "_text", "_size"],
        "_offset",
    )
    rows = hand_over(placed.drop("_text"), "rows")
    return Mix(sources, rows, _join_blocks(rows.read(spark), _slots(spark, sources, shard_slots), block_words))


def _slots(spark, sources: list[Source], shard_slots: int) -> DataFrame:
    """shard, slot, source, pass, block and cut of every slot of the mix."""
    counts = np.array([s.slots for s in sources], np.int64)
    total = int(counts.sum()) if len(counts) else 0
    shards = -(-total // shard_slots)
    groups = -(-shards // GROUP_SHARDS)
    sizes = [min(shard_slots * GROUP_SHARDS, total - g * shard_slots * GROUP_SHARDS) for g in range(groups)]
    drawn = draw(counts, sizes)
    first = np.cumsum(drawn, axis=0) - drawn
    plan = [(g, sizes[g], drawn[g].tolist(), first[g].tolist()) for g in range(groups)]
    schema = "part long, size long, counts array<long>, first array<long>"
    sent = spark.sparkContext.broadcast(sources)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = -(-row["size"] // shard_slots)
                parts = [min(shard_slots, row["size"] - k * shard_slots) for k in range(own)]
                taken = draw(np.array(row["counts"], np.int64), parts, row["part"])
                starts = np.cumsum(taken, axis=0) - taken + np.array(row["first"], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"] * GROUP_SHARDS + k for k in range(own)], pa.int64()),
                        "size": pa.array(parts, pa.int64()),
                        "counts": pa.array(taken.tolist(), pa.list_(pa.int64())),
                        "first": pa.array(starts.tolist(), pa.list_(pa.int64())),
                    }
                )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = Permutation(max(row["size"], 1), 7, row["part"])
                done = 0
                for source, count, first in zip(sent.value, row["counts"], row["first"]):
                    if not count:
                        continue
                    j = np.arange(first, first + count)
                    turn, within = j // source.blocks, j % source.blocks
                    block = np.zeros(count, np.int64)
                    for t in np.unique(turn):
                        own = turn == t
                        block[own] = Permutation(source.blocks, source.number, int(t))(within[own])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": np.full(count, row["part"], np.int64),
                            "slot": place(np.arange(done, done + count)),
                            "source": np.full(count, source.number, np.int32),
                            "pass": turn.astype(np.int32),
                            "block": block,
                            "cut": np.where(j == source.slots - 1, source.cut, 0),
                        }
                    )
                    done += count

    drawn_shards = spark.createDataFrame(plan, schema).mapInArrow(split, schema)
    return drawn_shards.repartition(max(1, min(shards, 200)), "part").mapInArrow(
        fill, "shard long, slot long, source int, pass int, block long, cut long"
    )


def _join_blocks(rows: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    size, offset = F.col("_size"), F.col("_offset")
    parts = (
        rows.filter(size > 0)
        .select(
            F.col("_source").alias("source"),
            offset.alias("offset"),
            size,
            F.explode(
                F.sequence((offset / block_words).cast("long"), ((offset + size - 1) / block_words).cast("long"))
            ).alias("block"),
        )
        .withColumn("_from", F.greatest("offset", F.col("block") * block_words))
        .withColumn("_to", F.least(F.col("offset") + F.col("_size"), (F.col("block") + 1) * block_words))
    )
    ends = parts.groupBy("source", "block").agg(F.max("_to").alias("_end"))
    cut = slots.filter("cut > 0").join(ends, ["source", "block"])
    whole = slots.filter("cut = 0").withColumn("_end", F.lit(None).cast("long"))
    # The cut concerns one slot a source; its block is read to a smaller end.
    limited = whole.unionByName(cut.withColumn("_end", F.col("_end") - F.col("cut")))
    joined = parts.join(limited, ["source", "block"])
    to = F.least("_to", F.coalesce("_end", "_to"))
    return joined.filter(F.col("_from") < to).select(
        "shard",
        "slot",
        (F.col("_from") - F.col("block") * block_words).alias("begin"),
        "source",
        "pass",
        "offset",
        (F.col("_from") - F.col("offset")).alias("first_word"),
        (to - F.col("_from")).alias("n_words"),
    )


def mixed_words(made: Mix) -> DataFrame:
    """Per input row: doc_id, size, source_size, target, and taken, the words in the mix."""
    rows = made.rows.read(made.pieces.sparkSession)
    spark = rows.sparkSession
    totals = spark.createDataFrame(
        [(s.number, s.size, s.target) for s in made.sources], "source int, source_size long, target double"
    )
    taken = made.pieces.groupBy("source", "offset").agg(F.sum("n_words").alias("taken"))
    sized = rows.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source").alias("source"), F.col("_offset").alias("offset")
    )
    # A row without words shares its offset with the next one and has no pieces.
    with_words = sized.filter("size > 0").join(taken, ["source", "offset"], "left")
    without = sized.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        with_words.unionByName(without)
        .join(F.broadcast(totals), "source")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def cut_words(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The characters from the first to the last word of each range, one range a line."""
    spans = [m.span() for m in _FIND.finditer(text)]
    return b"\n".join(text[spans[b][0] : spans[e - 1][1]] for b, e in ranges)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows of ``docs``: one per document and pass that takes words of it.

    A row whose words are all taken keeps its text; otherwise the text is what
    the pass takes, and n_chars, if there is such a column, follows.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "doc_id", "source", "text"
    )
    # The row itself travels with its place, so that rows alike in doc_id stay apart.
    made = mix(rows.withColumn("body", F.col("text")), "row", "body", store_sizes=False, **settings)
    taken = made.pieces.groupBy(F.col("source").alias("_source"), F.col("offset").alias("_offset")).agg(
        F.sort_array(F.collect_list(F.struct("pass", "first_word", "n_words"))).alias("pieces")
    )
    joined = made.rows.read(spark).filter("_size > 0").join(taken, ["_source", "_offset"])
    kind = rows.schema["row"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            index, texts, changed = [], [], []
            listed = zip(
                part.column("text").to_pylist(), part.column("pieces").to_pylist(), part.column("_size").to_pylist()
            )
            for k, (text, pieces, size) in enumerate(listed):
                ranges: dict[int, list[list[int]]] = {}
                for p in pieces:
                    own = ranges.setdefault(p["pass"], [])
                    if own and own[-1][1] == p["first_word"]:
                        own[-1][1] += p["n_words"]
                    else:
                        own.append([p["first_word"], p["first_word"] + p["n_words"]])
                for own in ranges.values():
                    whole = own == [[0, size]]
                    index.append(k)
                    texts.append(text if whole else cut_words(text, own))
                    changed.append(not whole)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": part.column("row").take(pa.array(index, pa.int64())),
                    "text": pa.array(texts, pa.binary()),
                    "changed": pa.array(changed, pa.bool_()),
                }
            )

    written = with_bytes(joined, "row", "_size", "pieces", text="body").mapInArrow(
        write, f"row {kind}, text binary, changed boolean"
    )
    text = F.col("text").cast("string")
    columns = {c: F.col(f"row.`{c}`") for c in rest} | {"text": text}
    if "n_chars" in columns:
        number = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("changed"), F.length(text).cast(number)).otherwise(columns["n_chars"])
    return written.select(*[columns[c].alias(c) for c in docs.columns])
