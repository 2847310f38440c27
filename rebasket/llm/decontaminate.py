"""Benchmark decontamination with an FM-index per training shard (operator 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.llm.fm_index import FmIndex
from rebasket.llm.text import numbered, plain_spaced, plain_words, slices, with_bytes
from rebasket.session import hand_over

WINDOW = 10
BLOCK_WORDS = 1_000_000
"""Benchmark words searched for together; their windows are what is broadcast."""
SHARD_BYTES = 8 << 20
"""Training text in one index."""
PIECE_WORDS = 500_000
"""Words of one document that are indexed together; pieces overlap by a window."""

_WORD = re.compile(rb"[^ ]+")


@dataclass(frozen=True)
class Phrases:
    """The distinct windows of a block of benchmark items."""

    words: dict[bytes, int]  # numbered from 2; 1 is any other word, 0 the end
    patterns: np.ndarray  # a window a row, right-aligned
    lengths: np.ndarray
    owner_starts: np.ndarray  # items of window w: owners[owner_starts[w]:owner_starts[w + 1]]
    owners: np.ndarray
    items: list[str]

    @property
    def alphabet(self) -> int:
        return len(self.words) + 2


def phrases_of(items: list[tuple[str, bytes | None]], window: int) -> Phrases:
    words: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    names: dict[str, int] = {}
    for name, text in items:
        codes = [words.setdefault(w, len(words) + 2) for w in plain_words(text)]
        number = names.setdefault(name, len(names))
        for k in range(max(len(codes) - window + 1, min(len(codes), 1))):
            found.setdefault(tuple(codes[k : k + window]), set()).add(number)
    patterns = np.zeros((len(found), window), np.int64)
    for row, codes in enumerate(found):
        patterns[row, window - len(codes) :] = codes
    owners = [sorted(o) for o in found.values()]
    return Phrases(
        words,
        patterns,
        np.array([len(c) for c in found], np.int64),
        np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64),
        np.array([o for group in owners for o in group], np.int64),
        list(names),
    )


def occurrences(codes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Start and window number of all places of the windows in ``codes`` (1: a foreign word).

    A window has no foreign word, so the index holds the runs of benchmark words
    that are long enough for the shortest window, each ended by one foreign word.
    """
    known = np.concatenate(([False], codes > 1, [False]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    begins, ends = edges[::2], edges[1::2]
    least = int(phrases.lengths.min()) if len(phrases.lengths) else 1
    fits = ends - begins >= least
    begins, ends = begins[fits], ends[fits]
    if not len(begins) or not len(phrases.lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = ends - begins + 1
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    source = np.arange(int(sizes.sum())) - np.repeat(starts - begins, sizes)
    symbols = np.ones(len(source) + 1, np.int64)
    inside = source < np.repeat(ends, sizes)
    symbols[:-1][inside] = codes[source[inside]]
    symbols[-1] = 0
    index = FmIndex(symbols, phrases.alphabet)
    low, high = index.search(phrases.patterns, phrases.lengths)
    counts = high - low
    window = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(len(window))
    return source[index.locate(rows)], window


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    order = np.argsort(starts, kind="stable")
    spans: list[dict[str, int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist()):
        if spans and s <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], e)
        else:
            spans.append({"begin": s, "end": e})
    return spans


def search_texts(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[list[dict[str, int]], list[str]]]:
    """Merged word spans and the names of the items found, for each text of a shard."""
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    found: list[set[int]] = [set() for _ in texts]
    reach = max(int(phrases.lengths.max()) - 1, 0) if len(phrases.lengths) else 0
    pieces = []
    for number, words in enumerate(texts):
        for begin in range(0, max(len(words) - reach, 1), PIECE_WORDS):
            pieces.append((number, begin, words[begin : begin + PIECE_WORDS + reach]))
    group: list = []
    held = 0
    for piece in [*pieces, None]:
        if piece is None or (group and held + len(piece[2]) > 2 * PIECE_WORDS):
            _search_group(group, phrases, spans, found)
            group, held = [], 0
        if piece is not None:
            group.append(piece)
            held += len(piece[2]) + 1
    results = []
    for own, items in zip(spans, found):
        places = np.array(own, np.int64).reshape(-1, 2)
        results.append((_merged(places[:, 0], places[:, 1]), sorted(phrases.items[i] for i in items)))
    return results


def _search_group(group, phrases: Phrases, spans, found) -> None:
    if not group:
        return
    codes, starts, distinct = numbered([words + [b"\0"] for _, _, words in group])
    table = np.fromiter((phrases.words.get(w, 1) for w in distinct), np.int64, len(distinct))
    places, windows = occurrences(table[codes], phrases)
    piece = np.searchsorted(starts, places, "right") - 1
    for p, at, w in zip(piece.tolist(), (places - starts[piece]).tolist(), windows.tolist()):
        number, begin, _ = group[p]
        spans[number].append((begin + at, begin + at + int(phrases.lengths[w])))
        found[number].update(phrases.owners[phrases.owner_starts[w] : phrases.owner_starts[w + 1]].tolist())


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *keep: str,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """``keep``, n_words, ``spans`` (begin, end in words) and ``items`` of every row of ``docs``.

    ``items`` has item_id and text.  Windows are ``window`` consecutive words of
    an item, or all words of a shorter one; spans are the merged places of any
    window, items the ascending ids (as strings) with a window in the text; ``with_text`` adds the
    text as bytes.
    Items are taken in blocks of about ``block_words`` words, whose windows are
    broadcast; each task indexes its shards and searches every window of a block
    backwards, so no document is shuffled and copies cost what other rows cost.

    Null and empty texts have no words.  Items of null or empty text have no
    windows; a null item_id counts as an item named by the empty string.
    Repeated rows are judged each for itself; repeated item_ids are one item.
    """
    keep = keep or ("doc_id",)
    stated = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.col("text").cast("binary").alias("text"),
    )
    size = stated.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    stated = stated.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    if blocks > 1:
        stated = hand_over(stated, "benchmark").read(docs.sparkSession)
    result = with_bytes(docs, *keep).withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "spans": F.lit(None).cast("array<struct<begin: bigint, end: bigint>>"),
            "items": F.lit(None).cast("array<string>"),
        }
    )
    for block in range(blocks):
        own = stated.filter(F.col("block") == block).select("name", "text").collect()
        phrases = phrases_of([(r[0], bytes(r[1]) if r[1] else None) for r in own], window)
        result = result.mapInArrow(
            _searcher(docs.sparkSession.sparkContext.broadcast(phrases)), result.schema
        )
        if block % 4 == 3:
            result = hand_over(result, "contamination").read(docs.sparkSession)
    text = ["text"] if with_text else []
    return result.select(*keep, *text, "n_words", "spans", "items")


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for part in slices(batches, SHARD_BYTES):
            texts = [plain_words(t) for t in part.column("text").to_pylist()]
            found = search_texts(texts, phrases)
            spans, items = [], []
            olds = zip(part.column("spans").to_pylist(), part.column("items").to_pylist())
            for (new_spans, new_items), (old_spans, old_items) in zip(found, olds):
                both = (old_spans or []) + new_spans
                spans.append(
                    _merged(np.array([s["begin"] for s in both]), np.array([s["end"] for s in both]))
                    if old_spans
                    else new_spans
                )
                items.append(sorted(set(old_items or []) | set(new_items)))
            columns = {n: part.column(n) for n in part.schema.names} | {
                "n_words": pa.array([len(t) for t in texts], pa.int64()),
                "spans": pa.array(spans, _SPANS),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def contamination_digest(found: DataFrame) -> DataFrame:
    """Counts per document of what ``find_contamination`` found."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_spans(text: bytes, spans: list[dict[str, int]]) -> bytes:
    """``text`` without the words of ``spans`` and what stands between them; the rest as it is."""
    cut = {k for s in spans for k in range(s["begin"], s["end"])}
    kept, at = [], 0
    for number, word in enumerate(_WORD.finditer(plain_spaced(text))):
        if number in cut:
            if number - 1 not in cut:
                kept.append(text[at : word.start()])
            at = word.end()
    kept.append(text[at:])
    return b"".join(kept)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without the benchmark passages in their ``text``.

    Clean documents stay as they are, null texts too; n_chars, if there is such a
    column, follows a changed text.  A document of which no word is left goes.
    """
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "text")
    found = find_contamination(rows, items, "row", window=window, with_text=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            spans = part.column("spans").to_pylist()
            cleaned = [without_spans(t, s) if s else t for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_pydict(
                {
                    "row": part.column("row"),
                    "text": pa.array(cleaned, pa.binary()),
                    "changed": pa.array([bool(s) for s in spans]),
                    "empty": pa.array([bool(s) and not plain_words(c) for c, s in zip(cleaned, spans)]),
                }
            )

    row = rows.schema["row"].dataType.simpleString()
    cleaned = found.mapInArrow(cut, f"row {row}, text binary, changed boolean, empty boolean")
    text = F.col("text").cast("string")
    columns = {c: F.col(f"row.`{c}`") for c in rest} | {"text": text}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("changed"), F.length(text).cast(kind)).otherwise(columns["n_chars"])
    return cleaned.filter(~F.col("empty")).select(*[columns[c].alias(c) for c in docs.columns])
