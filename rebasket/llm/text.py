"""Words, shingles and bounded batches, shared by the operators of this package.

Texts reach Python as UTF-8 bytes.  ``bytes.lower`` maps A-Z only and
``bytes.split`` splits at the space and 0x09-0x0D only, so both follow the
contracts to the letter without any regular expression.
"""

from __future__ import annotations

import ctypes
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.session import spread_rows

BATCH_BYTES = 4 << 20
"""Text that one Python step holds as words; a longer document stands alone."""
ARROW_BYTES = 8 << 20
"""Text that travels between the JVM and Python at a time; both sides hold a few such batches."""

_SEPARATORS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b for b in _SEPARATORS)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def spaced_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between white space; none for a null text."""
    return text.lower().split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters and digits and of all non-ASCII characters."""
    return text.translate(_LETTERS).split() if text else []


def plain_spaced(text: bytes) -> bytes:
    """As the text, byte by byte, with every character outside plain words a space."""
    return text.translate(_LETTERS)


def with_bytes(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """``columns`` and the text as bytes, over enough partitions for every core."""
    _bound_batches(docs)
    return spread_rows(docs.select(*columns, F.col(text).cast("binary").alias("text")))


def _bound_batches(docs: DataFrame) -> None:
    """Arrow batches of bounded bytes: ten thousand rows may be ten thousand books."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def give_back() -> None:
    """Returns the memory this process has freed to the system.

    Python workers outlive their tasks; what one task freed and the next one
    does not need would otherwise add up over the workers of an executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of text, rows whole."""
    batch = sizes = ends = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("text").cast(pa.large_binary())
        ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    del batch, sizes, ends
    give_back()


def per_text(
    docs: DataFrame, schema: str, work: Callable[[list[bytes | None]], dict[str, object]], *keep: str
) -> DataFrame:
    """One row per document: the columns ``keep`` and what ``work`` makes of the texts.

    ``work`` gets the texts of a slice and returns one list or array per column.
    """
    head = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = work(part.column("text").to_pylist())
            columns = {k: part.column(k) for k in keep} | {
                k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in made.items()
            }
            yield pa.RecordBatch.from_pydict(columns)

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head)
    return with_bytes(docs, *keep).mapInArrow(run, f"{keys}, {schema}" if keys else schema)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All words as numbers in one array, where each text starts, and the distinct words."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    # A word that is looked up for the first time gets the next number.
    index = defaultdict(count().__next__)
    codes = np.fromiter(map(index.__getitem__, chain.from_iterable(texts)), np.int64, starts[-1])
    return codes, starts, list(index)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[list[bytes]], width: int) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, ascending.

    A text of fewer words than ``width`` has one shingle, its whole sequence; a
    text without words has none.
    """
    codes, starts, distinct = numbered(texts)
    hashes = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.full(max(len(hashes) - width + 1, 0), width, np.uint64)
    for k in range(width):
        rolled = mixed(rolled * _STEP + hashes[k : k + len(rolled)])
    sets = []
    for begin, end in zip(starts[:-1], starts[1:]):
        if end - begin >= width:
            sets.append(np.unique(rolled[begin : end - width + 1]))
        elif end > begin:
            value = np.full(1, end - begin, np.uint64)
            for h in hashes[begin:end]:
                value = mixed(value * _STEP + h)
            sets.append(value)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
