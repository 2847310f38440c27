"""Passages that repeat across documents, by MinHash over short paragraphs (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.llm.links import link_classes
from rebasket.llm.membership import Membership, membership
from rebasket.llm.text import mixed, numbered, shingle_sets, slices, with_bytes, word_hashes
from rebasket.session import hand_over

UNIT_WORDS = 8
"""A paragraph has at least so many words; shorter sentences in a row form one."""
LONG_WORDS = 64
"""Longer stretches without a sentence end are cut at words chosen by their hash."""
ANCHOR = 24
PASSAGE_WORDS = 30
"""Neighbouring repeated paragraphs are a passage from so many words on."""
GAP_WORDS = 8
"""Words between repeated paragraphs that a passage bridges (less than a paragraph)."""
FRAGMENT = 8
"""Words of a fragment: exact pieces that overlap, for passages without sentence ends."""
SPREAD = 15
"""Of so many neighbouring fragments at least one is counted in the first pass."""
SHINGLE = 5
PERCENT = 80
BITS_APART = 29
"""Of 128 bits, paragraphs of similarity 0.8 differ in 13 with a deviation of 3.4."""
MISSED = 0.005
"""Share of pairs at the threshold that the bands may miss; closer pairs are missed less."""
REGISTERS = 3
"""Minima that make up a band: paragraphs that share a quotation only seldom agree in three."""

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BOUNDARY = np.frombuffer(b".!?", np.uint8)


def tuned_bands(percent: int = PERCENT, missed: float = MISSED, registers: int = REGISTERS) -> int:
    """The fewest bands of so many registers that miss at most ``missed`` at the threshold."""
    return int(np.ceil(np.log(missed) / np.log(1 - (percent / 100) ** registers)))


def paragraphs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The paragraphs of texts: text number, first and last (exclusive) word in the flat array.

    Also the distinct words, their numbers in the flat array and where texts
    start in it, and first and last (exclusive) words of the stretches before
    they are cut.  A paragraph never crosses a line; it is a sentence, or a row of
    sentences shorter than ``UNIT_WORDS``, or a piece of a longer stretch.
    Whether a stretch is cut depends on its length, so passages without sentence
    ends are found by ``fragments`` of the uncut stretches.
    """
    lines = [(t or b"").lower().split(b"\n") for t in texts]
    parts = [[line.split() for line in text] for text in lines]
    codes, starts, distinct = numbered([[w for line in text for w in line] for text in parts])
    n = len(codes)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, distinct, codes, starts, none, none
    last = np.cumsum(np.fromiter(map(len, distinct), np.int64, len(distinct))) - 1
    ends = np.isin(np.frombuffer(b"".join(distinct), np.uint8)[last], _BOUNDARY)[codes]
    lengths = np.fromiter((len(line) for text in parts for line in text), np.int64)
    line_ends = np.cumsum(lengths)
    line_ends = np.unique(line_ends[line_ends > 0])
    ends[line_ends - 1] = True
    hashes = word_hashes(distinct)[codes]
    begin, end = _stretches(ends)
    whole = _rows(begin, end, line_ends, n)
    long = np.repeat(end - begin > LONG_WORDS, end - begin)
    if long.any():
        anchor = mixed(np.concatenate((hashes[:1], hashes[:-1])) * _STEP + hashes) % np.uint64(ANCHOR) == 0
        ends |= long & anchor
        begin, end = _stretches(ends)
    begin, end = _rows(begin, end, line_ends, n)
    # A row of short sentences may be as long as a page.
    wide = np.repeat(end - begin > LONG_WORDS, end - begin)
    if wide.any():
        stops = np.zeros(n, bool)
        stops[end - 1] = True
        anchor = mixed(np.concatenate((hashes[:1], hashes[:-1])) * _STEP + hashes) % np.uint64(ANCHOR) == 0
        begin, end = _stretches(stops | (wide & anchor))
    fits = end - begin >= UNIT_WORDS
    begin, end = begin[fits], end[fits]
    return np.searchsorted(starts, begin, "right") - 1, begin, end, distinct, codes, starts, *whole


def _rows(begin: np.ndarray, end: np.ndarray, line_ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring stretches below ``UNIT_WORDS`` words of a line as one."""
    short = end - begin < UNIT_WORDS
    first = np.isin(begin, np.concatenate(([0], line_ends)))
    opens = first | ~short | np.concatenate(([True], ~short[:-1]))
    begin = begin[opens]
    return begin, np.concatenate((begin[1:], [n]))


def _stretches(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    end = np.flatnonzero(ends) + 1
    return np.concatenate(([0], end[:-1])), end


def signatures(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the words of each paragraph, and its ``bands`` bucket numbers, as longs."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros((0, bands), np.int64)
    total = np.concatenate(([0], np.cumsum(end - begin)))
    inside = np.arange(total[-1]) - np.repeat(total[:-1] - begin, end - begin)
    order = (inside - np.repeat(begin, end - begin)).astype(np.uint64)
    node = mixed(np.add.reduceat(mixed(hashes[inside] + order * _STEP), total[:-1]) + (end - begin).astype(np.uint64))
    rolled = np.full(len(hashes) - SHINGLE + 1, SHINGLE, np.uint64)
    for k in range(SHINGLE):
        rolled = mixed(rolled * _STEP + hashes[k : k + len(rolled)])
    sizes = end - begin - SHINGLE + 1
    cuts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    shingle = rolled[np.arange(int(sizes.sum())) - np.repeat(cuts - begin, sizes)]
    buckets = np.empty((len(begin), bands), np.int64)
    for k in range(bands):
        band = np.full(len(begin), k + 1, np.uint64)
        for r in range(k * REGISTERS, (k + 1) * REGISTERS):
            odd = mixed(np.array([2 * r + 11], np.uint64)) | np.uint64(1)
            band = mixed(band * _STEP + np.minimum.reduceat(shingle * odd + odd, cuts))
        buckets[:, k] = band.view(np.int64)
    return node.view(np.int64), buckets


def fragments(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the fragment at every word, and the first words of those that are counted.

    Of ``SPREAD`` neighbouring fragments of a stretch the one with the least hash
    is counted, so texts that share ``SPREAD + FRAGMENT - 1`` words inside
    stretches count a common fragment there, whatever stands around it.
    """
    n, reach = len(hashes) - FRAGMENT + 1, SPREAD + FRAGMENT - 1
    fits = end - begin >= reach
    if not fits.any():
        return np.zeros(max(n, 0), np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(FRAGMENT):
        total += mixed(hashes[k : k + n] + np.array([k], np.uint64) * _STEP)
    node = mixed(total + np.uint64(FRAGMENT))
    open_at = np.zeros(len(hashes) + 1, np.int64)
    open_at[begin[fits]] += 1
    np.subtract.at(open_at, end[fits] - reach + 1, 1)
    asked = np.flatnonzero(np.cumsum(open_at) > 0)
    around = np.lib.stride_tricks.sliding_window_view(mixed(node), SPREAD)
    at = asked + around[asked].argmin(axis=1)
    return node, at[np.concatenate(([True], at[1:] != at[:-1]))]


def _reached(hits: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All fragments less than ``SPREAD`` words from a hit in its stretch: words shared around it."""
    row = np.searchsorted(begin, hits, "right") - 1
    low = np.maximum(hits - SPREAD + 1, begin[row])
    high = np.minimum(hits + SPREAD - 1, end[row] - FRAGMENT)
    low[1:] = np.maximum(low[1:], high[:-1] + 1)
    sizes = np.maximum(high - low + 1, 0)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - low, sizes)


def bits(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One bit of each of 128 minima over the shingles of each paragraph, in two longs."""
    out = np.zeros((len(begin), 2), np.int64)
    if not len(begin):
        return out
    sizes = end - begin - SHINGLE + 1
    cuts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    at = np.arange(int(sizes.sum())) - np.repeat(cuts - begin, sizes)
    shingle = np.full(len(at), SHINGLE, np.uint64)
    for k in range(SHINGLE):
        shingle = mixed(shingle * _STEP + hashes[at + k])
    odd = np.empty((len(begin), 128), np.uint8)
    for r in range(128):
        times = mixed(np.array([2 * r + 5], np.uint64)) | np.uint64(1)
        odd[:, r] = mixed(np.minimum.reduceat(shingle * times + times, cuts)) & np.uint64(1)
    out[:] = np.ascontiguousarray(np.packbits(odd, axis=1)).view(">i8")
    return out


def _found(part: pa.RecordBatch, bands: int):
    text, begin, end, distinct, codes, starts, *whole = paragraphs(part.column("text").to_pylist())
    hashes = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    node, buckets = signatures(hashes, begin, end, bands)
    return text, begin, end, node, buckets, distinct, codes, starts, hashes, whole


def _sightings(docs: DataFrame, bands: int) -> DataFrame:
    """Per bucket and per paragraph hash: the least and greatest of what was seen there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text, _, _, node, buckets, _, _, starts, hashes, whole = _found(part, bands)
            doc_ids = part.column("doc_id").to_numpy().astype(np.int64)
            every, counted = fragments(hashes, *whole)
            owner = np.searchsorted(starts, counted, "right") - 1
            ids = doc_ids[np.concatenate((text, owner))]
            # 32 bits tell two values of one place apart but for one pair in 4e9.
            of_node = (mixed(node.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            of_doc = (mixed(ids.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            for k in range(bands):
                yield pa.RecordBatch.from_pydict({"place": buckets[:, k], "seen": of_node})
            places = np.concatenate((node, every[counted].view(np.int64)))
            yield pa.RecordBatch.from_pydict({"place": places, "seen": of_doc})

    seen = with_bytes(docs, "doc_id").mapInArrow(run, "place long, seen int")
    grouped = seen.groupBy("place").agg(F.min("seen").alias("least"), F.max("seen").alias("most"))
    return grouped.filter("least < most").select(F.col("place").alias("hash"))


def _occurrences(docs: DataFrame, known: Membership, bands: int) -> DataFrame:
    """The paragraphs and fragments that may be repeated; with their words where a bucket is shared."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = sent.value
        for part in slices(batches):
            text, begin, end, node, buckets, distinct, codes, starts, hashes, whole = _found(part, bands)
            hit = places.holds(buckets.reshape(-1).view(np.uint64)).reshape(buckets.shape)
            near = hit.any(axis=1)
            kept = np.flatnonzero(near | places.holds(node.view(np.uint64)))
            words = [
                b" ".join([distinct[c] for c in codes[begin[k] : end[k]]]) if near[k] else None for k in kept.tolist()
            ]
            own = bits(hashes, begin[kept], end[kept])
            yield pa.RecordBatch.from_pydict(
                {
                    "bits0": own[:, 0].copy(),
                    "bits1": own[:, 1].copy(),
                    "doc_id": part.column("doc_id").take(pa.array(text[kept])),
                    "first_word": begin[kept] - starts[text[kept]],
                    "n_words": end[kept] - begin[kept],
                    "node": node[kept],
                    "buckets": pa.array([buckets[k][hit[k]].tolist() for k in kept.tolist()], pa.list_(pa.int64())),
                    "text": pa.array(words, pa.binary()),
                    "fragment": np.zeros(len(kept), bool),
                }
            )
            every, counted = fragments(hashes, *whole)
            hits = counted[places.holds(every[counted])]
            if len(hits):
                at = _reached(hits, *whole)
                owner = np.searchsorted(starts, at, "right") - 1
                none = np.zeros(len(at), np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bits0": none,
                        "bits1": none,
                        "doc_id": part.column("doc_id").take(pa.array(owner)),
                        "first_word": at - starts[owner],
                        "n_words": none + FRAGMENT,
                        "node": every[at].view(np.int64),
                        "buckets": pa.nulls(len(at), pa.list_(pa.int64())),
                        "text": pa.nulls(len(at), pa.binary()),
                        "fragment": np.ones(len(at), bool),
                    }
                )

    return with_bytes(docs, "doc_id").mapInArrow(
        run,
        "bits0 long, bits1 long, doc_id long, first_word long, n_words long, node long, buckets array<long>, text binary, "
        "fragment boolean",
    )


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sides = [
                shingle_sets([t.split() for t in part.column(c).to_pylist()], SHINGLE) for c in ("text_a", "text")
            ]
            held = []
            for a, b in zip(*sides):
                inter = len(np.intersect1d(a, b, assume_unique=True))
                held.append(100 * inter >= PERCENT * (len(a) + len(b) - inter))
            yield part.select(["a", "b"]).filter(pa.array(held, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), "text"), "b"
    )
    return both.mapInArrow(confirm, "a long, b long")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """The passages of ``docs`` that other documents hold too, a row each.

    doc_id, first_word and n_words (words between white space); class_id of the
    paragraphs' class, class_docs (documents that share it), kept_doc_id (the
    document where it stays: the smallest, at its first place) and removed.
    Documents without a repeated passage have no row.

    Paragraphs (see ``paragraphs``) are alike if their words are equal or 100 *
    shared >= 80 * all of their five-word shingles; classes are what this
    connects.  A first pass only counts, per bucket and paragraph hash, whether
    different ones meet there; a second pass takes up the paragraphs that do, by
    filters of bounded size, and ``links`` verifies them.  Where stretches share
    ``SPREAD + FRAGMENT - 1`` words or more, their equal ``fragments`` are taken
    up too, word by word to both ends, so a passage without sentence ends is found
    whole wherever it stands.  Words outside repeated paragraphs follow their
    fragments; a document that keeps a fragment keeps it at all its places.
    Neighbouring repeated words with fewer than ``GAP_WORDS`` words between them
    form a passage; passages below ``PASSAGE_WORDS`` words are left alone.  A
    passage that stays in part has a row for each part, however short.

    Null and empty texts have no paragraphs.  Rows of one doc_id are one
    document, what repeats inside it only is not repeated; rows without doc_id
    take no part.
    """
    spark, bands = docs.sparkSession, tuned_bands()
    ids = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = hand_over(_sightings(ids, bands), "places").read(spark)
    stored = hand_over(_occurrences(ids, membership(shared, shared.count()), bands), "occurrences").read(spark)
    near = stored.filter(F.col("text").isNotNull())
    members = hand_over(
        near.select(
            "node", "bits0", "bits1", (F.col("n_words") - (SHINGLE - 1)).alias("size"), F.explode("buckets").alias("bucket")
        )
        .join(shared.withColumnRenamed("hash", "bucket"), "bucket")
        .groupBy("bucket", "node")
        .agg(*[F.max(c).alias(c) for c in ("size", "bits0", "bits1")]),
        "members",
    ).read(spark)
    linked = members.select("node").distinct()
    texts = near.select("node", "text").join(linked, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = hand_over(texts, "texts").read(spark)
    classes = link_classes(members, lambda pairs: _verify(pairs, texts), percent=PERCENT, differing=BITS_APART)
    placed = (
        stored.select("doc_id", "first_word", "n_words", "node", "fragment")
        .join(classes, "node", "left")
        .withColumn("class", F.coalesce("component", "node"))
        .drop("component", "node")
    )
    placed = hand_over(placed, "placed").read(spark)
    per_class = (
        placed.groupBy("class", "doc_id")
        .agg(F.min("first_word").alias("at"))
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "at")).alias("keep"))
        .filter("docs > 1")
    )
    repeated = placed.join(per_class, "class").withColumn(
        "removed",
        ~((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("fragment") | (F.col("first_word") == F.col("keep.at")))),
    )
    return _passages(repeated)


def _passages(repeated: DataFrame) -> DataFrame:
    piece = F.struct("first_word", "n_words", "fragment", "removed", "class", "docs", F.col("keep.doc_id").alias("kept"))
    per_doc = repeated.groupBy("doc_id").agg(F.collect_list(piece).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            cuts = lists.offsets.to_numpy()
            flat = lists.values
            names = [flat.type.field(k).name for k in range(flat.type.num_fields)]
            fields = {k: flat.field(j).to_numpy(zero_copy_only=False) for j, k in enumerate(names)}
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                found = _joined({name: v[cuts[k] : cuts[k + 1]] for name, v in fields.items()})
                if found:
                    columns = zip(("first_word", "n_words", "class_id", "class_docs", "kept_doc_id", "removed"), zip(*found))
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc] * len(found), pa.int64())} | dict(columns))

    return per_doc.mapInArrow(
        run,
        "doc_id long, first_word long, n_words long, class_id long, class_docs long, kept_doc_id long, removed boolean",
    )


def _joined(pieces: dict[str, np.ndarray]) -> list[tuple]:
    """The passages of a document: its long enough runs of repeated words, cut where ``removed`` changes."""
    begin, removed = pieces["first_word"], pieces["removed"].astype(bool)
    end, fragment = begin + pieces["n_words"], pieces["fragment"].astype(bool)
    base = int(begin.min())
    state = np.zeros(int(end.max()) - base, np.int8)  # 1 stays, 2 is removed
    # What comes later counts: a word of a paragraph follows it, and what is kept stays whole.
    for some, value in ((fragment & removed, 2), (fragment & ~removed, 1), (~fragment & removed, 2), (~fragment & ~removed, 1)):
        if some.any():
            change = np.zeros(len(state) + 1, np.int64)
            np.add.at(change, begin[some] - base, 1)
            np.add.at(change, end[some] - base, -1)
            state[np.cumsum(change[:-1]) > 0] = value
    edges = np.flatnonzero(np.diff(state)) + 1
    first, last = np.concatenate(([0], edges)), np.concatenate((edges, [len(state)]))
    held = state[first] > 0
    first, last = first[held], last[held]
    apart = np.concatenate(([True], first[1:] - last[:-1] >= GAP_WORDS))
    run = np.cumsum(apart) - 1
    length = np.append(last[:-1][apart[1:]], last[-1]) - first[apart]
    number = np.flatnonzero(apart | np.concatenate(([True], state[first[1:]] != state[first[:-1]])))
    fits = length[run[number]] >= PASSAGE_WORDS
    first, last = first[number], last[np.concatenate((number[1:] - 1, [len(last) - 1]))]
    rows = []
    for b, e in zip((first[fits] + base).tolist(), (last[fits] + base).tolist()):
        gone = bool(state[b - base] == 2)
        own = np.flatnonzero((begin < e) & (end > b) & (removed == gone))
        longest = own[np.lexsort((pieces["class"][own], pieces["n_words"][own]))[-1]]
        rows.append((b, e - b, *(int(pieces[k][longest]) for k in ("class", "docs", "kept")), gone))
    return rows
