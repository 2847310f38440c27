"""Links between the tokens of two tokenizers, counted over the corpus (operator 11).

Tasks cut every text into groups of tokens at the byte offsets where tokens of
both tokenizers end, and write one inverted index: per pair of token ids a
compressed bitmap of the texts that hold it linked, and multiplicity planes,
bitmaps of the texts whose number of further links has that binary digit.
Popcounts of the bitmaps are the document counts of the pairs; the postings then
carry these counts back to the texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType
from sentencepiece import SentencePieceProcessor

from rebasket.llm.text import slices, with_bytes
from rebasket.llm.tokens import PRE_TOKENS, _byte_letters, _library
from rebasket.session import hand_over

CHUNK_TEXTS = 1 << 16
"""Texts of one chunk: its bitmaps have that many places."""
CHUNK_POSTINGS = 1 << 21
"""A chunk is closed at the first slice of texts beyond so many postings."""
ARRAY_MOST = 4096
"""Bitmaps of fewer texts list their places, the others have a bit per place."""
SLICE_BYTES = 1 << 20
"""Text that is encoded at once."""
CACHE_UNITS = 150_000
"""Units whose links a task remembers before it starts afresh; longer ones are not kept."""
CACHED_LETTERS = 100
_ID_BITS = 20  # of a token id in a pair's code

# A unit ends where a visible character meets white space.  Neither tokenizer has
# a token across such a place (for the second, `whole_units` proves it), so units
# are encoded alone.  Texts with white space that libraries class differently are
# encoded whole.
_BREAKS = " \t\n\x0b\x0c"
_UNITS = re.compile(f"[{_BREAKS}]*[^{_BREAKS}]+|[{_BREAKS}]+")
_ODD_SPACE = re.compile(
    "[\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff]"
)
_LAST_PLAIN = "\u024f"  # letters up to here are classed alike by all libraries
_SPACE_MARK = "▁"
_BEFORE = "a"  # one token of its own, put before units without a leading space


def whole_units(pieces: SentencePieceProcessor) -> bool:
    """Whether no piece reaches from a visible character into white space."""
    breaks = set(_BREAKS + _SPACE_MARK)
    for k in range(pieces.get_piece_size()):
        if pieces.is_byte(k) or pieces.is_control(k) or pieces.is_unknown(k):
            continue
        piece = pieces.id_to_piece(k)
        if any(second in breaks and first not in breaks for first, second in zip(piece, piece[1:])):
            return False
    return len(pieces.encode(_BEFORE)) == 1


def _piece_bytes(pieces: SentencePieceProcessor, k: int) -> bytes:
    if pieces.is_byte(k):
        return bytes([int(pieces.id_to_piece(k)[3:-1], 16)])
    return pieces.id_to_piece(k).replace(_SPACE_MARK, " ").encode()


def _expanded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``counts`` elements: the run of every element, and its place in it."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Side:
    """What is needed of one tokenizer's ids: bytes, their number, decimal text and its length."""

    def __init__(self, contents: list[bytes]):
        if len(contents) >= 1 << _ID_BITS:
            raise ValueError(f"more than {1 << _ID_BITS} token ids")
        self.contents = contents
        self.lengths = [len(c) for c in contents]
        self.sizes = np.array(self.lengths, np.int64)
        self.names = [str(k).encode() for k in range(len(contents))]
        self.widths = np.array([len(n) for n in self.names], np.int64)


@dataclass
class Units:
    """Groups and links of a list of units (or texts), one entry or run each."""

    sizes: np.ndarray  # per unit: tokens of both sides, groups, links
    groups: list[bytes]  # per unit: the groups as text
    starts: np.ndarray  # where the links of a unit start
    codes: np.ndarray  # per link: the pair of ids
    times: np.ndarray  # and how often it occurs


class Aligner:
    """Encodes texts with both tokenizers and links their tokens."""

    def __init__(self, description: str, model: bytes):
        self.left = _library(description)
        self.left.encode_special_tokens = True
        self.right = SentencePieceProcessor(model_proto=model)
        letters = {c: bytes([b]) for b, c in _byte_letters().items()}
        vocabulary = json.loads(description)["model"]["vocab"]
        contents = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            contents[k] = b"".join(letters.get(c, c.encode()) for c in entry)
        self.a = _Side(contents)
        self.ranks = self._ranks(json.loads(description)["model"])
        self.b = _Side([_piece_bytes(self.right, k) for k in range(self.right.get_piece_size())])
        self.cut = whole_units(self.right)
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def _ranks(self, model: dict) -> tiktoken.Encoding | None:
        """The same merges as ranks, if each merge makes the next id: much faster on short units."""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [model["vocab"][x + y] for x, y in pairs]
        ranks = {c: k for k, c in enumerate(self.a.contents) if c and k not in self.left.get_added_tokens_decoder()}
        if made != sorted(made) or len(made) + 256 != len(ranks):
            return None
        return tiktoken.Encoding("left", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def _encode_left(self, units: list[str]) -> list[list[int]]:
        if not self.ranks:
            return [e.ids for e in self.left.encode_batch_fast(units, add_special_tokens=False)]
        found = list(map(self.ranks.encode_ordinary, units))
        odd = [k for k, u in enumerate(units) if not u.isascii() and max(u) > _LAST_PLAIN]
        for k, e in zip(odd, self.left.encode_batch_fast([units[k] for k in odd], add_special_tokens=False)):
            found[k] = e.ids
        return found

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both sides for units of a text."""
        bare = [u[0] == " " and len(u) > 1 for u in units]  # the second side adds the space
        given = [u[1:] if b else _BEFORE + u for u, b in zip(units, bare)]
        right = self.right.encode(given, num_threads=1) if given else []
        return self._encode_left(units), [ids if b else ids[1:] for ids, b in zip(right, bare)]

    def encode_whole(self, text: str) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both sides for a whole text."""
        left = self.left.encode(" " + text, add_special_tokens=False).ids
        return [left], [self.right.encode(text)]

    def _joins(self, units: list[bytes], left: list[list[int]], right: list[list[int]]) -> bool:
        """Whether the tokens of both sides, joined, are the units."""
        whole = b"".join(units)
        return all(
            b"".join(map(side.contents.__getitem__, chain.from_iterable(ids))) == whole
            and [sum(map(side.lengths.__getitem__, i)) for i in ids] == list(map(len, units))
            for side, ids in ((self.a, left), (self.b, right))
        )

    def link(self, units: list[bytes], left: list[list[int]], right: list[list[int]]) -> Units:
        """The groups and links of units whose joined tokens equal them on both sides."""
        a = np.fromiter(chain.from_iterable(left), np.int64)
        b = np.fromiter(chain.from_iterable(right), np.int64)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        unit_ends = np.cumsum([len(u) for u in units])
        first = np.searchsorted(common, unit_ends - [len(u) for u in units], "right")  # group per unit
        n = len(common)
        count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)

        def per_unit(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, first) if len(values) else np.zeros(0, np.int64)

        sizes = np.stack(
            [per_unit(v) for v in (count_a, count_b, np.ones(n, np.int64), count_a * count_b)], 1
        )
        # Groups as text: all ids in order, each with the sign that follows it.
        key = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(key, kind="stable")
        names = [*map(self.a.names.__getitem__, a.tolist()), *map(self.b.names.__getitem__, b.tolist())]
        step = np.diff(key[order], append=-1)
        same_group = (step == 1) & (key[order] % 2 == 0)
        signs = np.where(step == 0, 0, np.where(same_group, 1, 2)).tolist()
        text = b"".join(
            chain.from_iterable(zip(map(names.__getitem__, order.tolist()), map((b",", b"|", b";").__getitem__, signs)))
        )
        widths = np.concatenate([self.a.widths[a], self.b.widths[b]])[order] + 1
        stops = np.cumsum(widths)[np.cumsum(sizes[:, 0] + sizes[:, 1]) - 1] if len(units) else widths
        begins = np.concatenate([[0], stops[:-1]]).astype(np.int64)
        groups = [text[x : y - 1] for x, y in zip(begins.tolist(), stops.tolist())]
        # Links: the distinct ids of a group's two sides, with the product of their counts.
        mask = (1 << _ID_BITS) - 1
        pairs_a, times_a = np.unique(group_a << _ID_BITS | a, return_counts=True)
        pairs_b, times_b = np.unique(group_b << _ID_BITS | b, return_counts=True)
        of_a = pairs_a >> _ID_BITS
        partners = np.bincount(pairs_b >> _ID_BITS, minlength=n)
        x, place = _expanded(partners[of_a])
        y = (np.cumsum(partners) - partners)[of_a[x]] + place
        codes = (pairs_a[x] & mask) << _ID_BITS | (pairs_b[y] & mask)
        starts = np.append(np.searchsorted(of_a[x], first), len(x))
        return Units(sizes, groups, starts, codes, times_a[x] * times_b[y])

    def records(self, units: list[str], left: list[list[int]], right: list[list[int]]) -> list[tuple | None]:
        """Per unit: sizes, groups, codes and times as bytes; None where joined tokens differ from it."""
        plain = [u.encode() for u in units]
        good = range(len(units))
        if not self._joins(plain, left, right):
            good = [k for k in good if self._joins([plain[k]], [left[k]], [right[k]])]
            plain, left, right = ([side[k] for k in good] for side in (plain, left, right))
        found: list[tuple | None] = [None] * len(units)
        if not plain:
            return found
        made = self.link(plain, left, right)
        codes, times = made.codes.tobytes(), made.times.tobytes()
        bounds = (made.starts * 8).tolist()
        for k, sizes, groups, x, y in zip(good, made.sizes.tolist(), made.groups, bounds, bounds[1:]):
            found[k] = (sizes, groups, codes[x:y], times[x:y])
        return found

    def remember(self, units: dict[str, None]) -> list[tuple | None]:
        """The records of ``units``, each encoded once per task while it is remembered."""
        if len(self.known) > CACHE_UNITS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = [u for u in units if u not in known]
        for unit in new:
            if unit in older:
                known[unit] = older[unit]
        new = [u for u in new if u not in known]
        kept_not = []
        for unit, record in zip(new, self.records(new, *self.encode(new))):
            known[unit] = record
            if len(unit) > CACHED_LETTERS:
                kept_not.append(unit)
        found = list(map(known.__getitem__, units))
        for unit in kept_not:
            del known[unit]
        return found

    def texts(self, texts: list[bytes | None]) -> Units:
        """Sizes, groups (hashed) and links of whole texts; nothing for texts without tokens."""
        strings = [_string(t) for t in texts]
        cut = [bool(s) and self.cut and not _ODD_SPACE.search(s) and _SPACE_MARK not in s for s in strings]
        units = [_UNITS.findall(" " + s) if c else [] for s, c in zip(strings, cut)]
        distinct = dict.fromkeys(chain.from_iterable(units))
        records = self.remember(distinct)
        number = dict(zip(distinct, range(len(distinct))))
        lost = {u for u, r in zip(distinct, records) if r is None}
        rows = []
        for string, own, alone in zip(strings, units, cut):
            if alone and not (lost and lost.intersection(own)):
                rows.append(list(map(number.__getitem__, own)))
            elif string:
                record = self.records([" " + string], *self.encode_whole(string))[0]
                rows.append([len(records)] if record else [])
                records += [record] if record else []
            else:
                rows.append([])
        records = [r or ([0] * 4, b"", b"", b"") for r in records]
        flat = np.fromiter(chain.from_iterable(rows), np.int64)
        ends = np.cumsum([len(r) for r in rows])

        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([np.zeros_like(values[:1], shape=(1, *values.shape[1:])), np.cumsum(values, 0)])
            return np.diff(total[np.concatenate([[0], ends])], axis=0)

        sizes = np.array([r[0] for r in records], np.int64).reshape(-1, 4)
        named = [r[1] for r in records]
        groups = [
            hashlib.sha256(b";".join(map(named.__getitem__, r))).hexdigest() if r else "" for r in rows
        ]
        codes = np.frombuffer(b"".join([r[2] for r in records]), np.int64)
        times = np.frombuffer(b"".join([r[3] for r in records]), np.int64)
        links = np.array([len(r[2]) // 8 for r in records], np.int64)
        first = np.cumsum(links) - links
        run, place = _expanded(links[flat])
        taken = first[flat][run] + place
        starts = np.concatenate([[0], np.cumsum(per_text(links[flat]))])
        return Units(per_text(sizes[flat]), groups, starts, codes[taken], times[taken])


def _string(text: bytes | None) -> str:
    """The text; nothing for null, and for bytes that are no UTF-8, which no token gives back."""
    try:
        return (text or b"").decode()
    except UnicodeDecodeError:
        return ""


# --- the inverted index ---


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their times: partial postings merged."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _bitmaps(codes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per code: its compressed bitmap of slots.  Codes and slots ascend."""
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    held = np.diff(np.append(first, len(codes)))
    dense = np.flatnonzero(held >= ARRAY_MOST)
    places = slots.astype("<u2")
    lengths = np.where(held >= ARRAY_MOST, CHUNK_TEXTS // 8, held * 2)
    parts, last = [], 0
    for k in dense.tolist():  # at most one of 4,096 postings
        x, y = first[k], first[k] + held[k]
        bits = np.zeros(CHUNK_TEXTS, np.uint8)
        bits[slots[x:y]] = 1
        parts += [places[last:x].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
        last = y
    parts.append(places[last:].tobytes())
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    bitmaps = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(parts))]
    )
    return codes[first], held, bitmaps


def _places(bits: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all bitmaps and the bitmap each belongs to."""
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    dense = lengths == CHUNK_TEXTS // 8
    listed = data.view("<u2") if not dense.any() else data[np.repeat(~dense, lengths)].copy().view("<u2")
    slots, owners = [listed.astype(np.int64)], [np.repeat(np.flatnonzero(~dense), lengths[~dense] // 2)]
    for k in np.flatnonzero(dense):
        start = offsets[k] - offsets[0]
        found = np.flatnonzero(np.unpackbits(data[start : start + lengths[k]], bitorder="little"))
        slots.append(found)
        owners.append(np.full(len(found), k))
    return np.concatenate(slots), np.concatenate(owners)


_INDEX = (
    "kind string, chunk long, slot int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, weight long, held long, bits binary"
)


class _Chunk:
    """The texts and postings that one chunk of a task has gathered."""

    def __init__(self, number: int):
        self.number, self.texts, self.postings = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, units: Units) -> np.ndarray:
        """Takes up texts and returns their slots."""
        n = len(units.groups)
        slots = np.arange(self.texts, self.texts + n)
        keys = units.codes << 16 | np.repeat(slots, np.diff(units.starts))
        self.parts.append(_summed(keys, units.times))
        self.texts += n
        self.postings += len(self.parts[-1][0])
        return slots

    def rows(self) -> Iterator[dict[str, object]]:
        """The bitmaps of the texts per pair, and of every digit of further links."""
        keys = np.concatenate([k for k, _ in self.parts])
        keys, times = _summed(keys, np.concatenate([t for _, t in self.parts]))
        further, plane = times - 1, -1
        chosen = np.ones(len(keys), bool)
        while chosen.any():
            codes, held, bits = _bitmaps(keys[chosen] >> 16, keys[chosen] & 0xFFFF)
            yield {
                "a": (codes >> _ID_BITS).astype(np.int32),
                "b": (codes & ((1 << _ID_BITS) - 1)).astype(np.int32),
                "plane": np.full(len(codes), plane, np.int32),
                "weight": np.full(len(codes), 1 << max(plane, 0), np.int64),
                "held": held.astype(np.int64),
                "bits": bits,
            }
            plane += 1
            if not (further >> plane).any():
                break
            chosen = (further >> plane & 1).astype(bool)
            while not chosen.any():
                plane += 1
                chosen = (further >> plane & 1).astype(bool)


def _filled(schema: pa.Schema, n: int, columns: dict[str, object]) -> pa.RecordBatch:
    """A batch with the given columns, the others null."""
    arrays = []
    for field in schema:
        value = columns.get(field.name)
        if value is None:
            arrays.append(pa.nulls(n, field.type))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def build_index(docs: DataFrame, description: str, model: bytes, keep: tuple[str, ...]) -> DataFrame:
    """Rows of kind ``text`` (counts of one text) and ``posting`` (a bitmap of one chunk), stored.

    Both kinds come out of the same attempt of a task, so slots always mean the
    same text.  The columns ``keep`` are called keep_0, keep_1 and so on.
    """
    names = [f"keep_{k}" for k in range(len(keep))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text"))
    schema = StructType([*renamed.select(*names).schema, *StructType.fromDDL(_INDEX)])
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast((description, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, base = None, TaskContext.get().partitionId() << 24
        chunk = _Chunk(base)

        def close(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
            for columns in chunk.rows() if chunk.parts else ():
                n = len(columns["a"])
                columns |= {"kind": ["posting"] * n, "chunk": np.full(n, chunk.number)}
                whole = _filled(arrow, n, columns)
                for start in range(0, n, 20_000):
                    yield whole.slice(start, 20_000)

        for batch in batches:
            for part in slices([batch], SLICE_BYTES):
                aligner = aligner or Aligner(*sent.value)
                if chunk.texts + part.num_rows > CHUNK_TEXTS or chunk.postings > CHUNK_POSTINGS:
                    yield from close(chunk)
                    chunk = _Chunk(chunk.number + 1)
                units = aligner.texts(part.column("text").to_pylist())
                n = part.num_rows
                yield _filled(
                    arrow,
                    n,
                    {name: part.column(name) for name in names}
                    | {"kind": ["text"] * n, "chunk": np.full(n, chunk.number)}
                    | {"slot": chunk.add(units).astype(np.int32), "groups_sha256": units.groups}
                    | {c: units.sizes[:, k] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                )
        yield from close(chunk)

    found = with_bytes(renamed, *names).mapInArrow(run, schema)
    return hand_over(found, "alignment", partition_by="kind").read(docs.sparkSession)


def pair_counts(index: DataFrame) -> DataFrame:
    """Per linked pair of ids: a, b, count (texts that hold it linked), links, and best.

    Bitmaps of different chunks have no text in common, so their popcounts add
    up; the planes weigh 1, 2, 4 and so on.  ``best``: no other pair of this a
    has a higher count.
    """
    held = F.when(F.col("plane") < 0, F.col("held")).otherwise(0)
    counts = (
        index.filter("kind = 'posting'")
        .groupBy("a", "b")
        .agg(F.sum(held).alias("count"), F.sum(F.col("weight") * F.col("held")).alias("links"))
    )
    stored = hand_over(counts, "pair-counts").read(index.sparkSession)
    highest = stored.groupBy("a").agg(F.max("count").alias("_highest"))
    joined = stored.join(highest, "a").withColumn("best", F.col("count") == F.col("_highest"))
    return hand_over(joined.drop("_highest"), "pairs").read(index.sparkSession)


_TEXT_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


def _carry_back(index: DataFrame, pairs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The text rows with n_best and count_sum, summed over the postings of their chunk."""
    names = [f"keep_{k}" for k in range(len(keep))]
    texts = index.filter("kind = 'text'").select(*names, "chunk", "slot", *_TEXT_COLUMNS, "groups_sha256")
    best = F.when(F.col("best"), F.col("weight")).otherwise(0).cast("long")
    postings = (
        index.filter("kind = 'posting'")
        .join(pairs.select("a", "b", "count", "best"), ["a", "b"])
        .select("chunk", "bits", (F.col("weight") * F.col("count")).alias("add"), best.alias("add_best"))
    )
    both = texts.unionByName(postings, allowMissingColumns=True)
    schema = StructType(
        [
            *texts.select(*names, *_TEXT_COLUMNS, "groups_sha256").schema,
            StructField("n_best", LongType()),
            StructField("count_sum", LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums, rows = None, None, []

        def finished() -> Iterator[pa.RecordBatch]:
            for texts in rows:
                slots = texts.column("slot").to_numpy()
                columns = [texts.column(c) for c in kept] + [pa.array(s[slots]) for s in sums]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            borders = np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1 if len(chunks) else 0))
            for x, y in zip(borders, [*borders[1:], len(chunks)]):
                if chunks[x] != current:
                    yield from finished()
                    current, sums, rows = chunks[x], np.zeros((2, CHUNK_TEXTS), np.int64), []
                part = batch.slice(x, y - x)
                is_text = part.column("bits").is_null()
                if pc.any(is_text).as_py():
                    rows.append(part.filter(is_text))
                part = part.filter(pc.invert(is_text))
                if part.num_rows:
                    slots, owners = _places(part.column("bits"))
                    for total, column in zip(sums, ("add_best", "add")):
                        np.add.at(total, slots, part.column(column).to_numpy()[owners])
        yield from finished()

    dealt = both.repartition(F.col("chunk")).sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))


def align_texts(docs: DataFrame, tokenizer_file: str, piece_file: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Texts with their groups and links, and the pairs of token ids with their counts.

    The first table has ``keep`` (doc_id), n_a, n_b, n_groups, n_links,
    groups_sha256, n_best and count_sum for every row of ``docs``; the second is
    that of ``pair_counts``.  Null and empty texts, and texts that either
    tokenizer does not give back byte by byte, have zeros and an empty
    groups_sha256.  Every row counts as a text, repeated rows and ids too; the id
    is only carried along and may be null.  An empty table gives two empty ones;
    other columns do not matter.

    A posting is shuffled twice, compressed: to the count of its pair (unless the
    counts are small enough for Spark to broadcast) and back to its chunk.  A
    task holds one chunk of bounded texts and postings; a pair that occurs in
    every text has one bounded bitmap per chunk.
    """
    keep = keep or ("doc_id",)
    with open(tokenizer_file, encoding="utf-8") as file:
        description = file.read()
    with open(piece_file, "rb") as file:
        model = file.read()
    index = build_index(docs, description, model, keep)
    pairs = pair_counts(index)
    return _carry_back(index, pairs, keep), pairs
