"""Token counts by a whole-token shortcut (operator 9)."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rebasket.llm.text import per_text

CACHE_UNITS = 500_000
"""Units whose count a task remembers before it starts afresh."""

# The pre-token pattern of byte-level BPE.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A piece never reaches from a visible character into white space, so a text may
# be cut there.  Characters that libraries class differently as white space send
# the whole text to the library.
_UNITS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_ODD_SPACE = re.compile(
    "[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff]"
)


def proven_strings(tokenizer: Tokenizer) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and encode alone as one token."""
    pattern = regex.compile(PRE_TOKENS)
    strings = {tokenizer.decode([i], skip_special_tokens=False): i for i in range(tokenizer.get_vocab_size())}
    alone = [s for s in strings if s and "\ufffd" not in s and pattern.fullmatch(s) and pattern.findall(s) == [s]]
    encoded = tokenizer.encode_batch(alone, add_special_tokens=False)
    return frozenset(s for s, e in zip(alone, encoded) if e.ids == [strings[s]])


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level BPE writes each byte."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


class Counter:
    """Counts the tokens of texts in one task.

    Counts of units are remembered in two generations, so memory stays bounded
    and frequent units are not counted again when the older one is dropped.
    """

    def __init__(self, description: str, proven: frozenset[str]):
        self.tokenizer = _library(description)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.pattern = regex.compile(PRE_TOKENS)
        self.proven = proven
        self.units: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def pieces(self, piece: str) -> int:
        if piece in self.proven:
            return 1
        return len(self.merge(piece.encode().decode("latin-1").translate(self.letters)))

    def learn(self, units: set[str]) -> None:
        older, find, pieces = self.older, self.pattern.findall, self.pieces
        for unit in units:
            known = older.get(unit)
            self.units[unit] = sum(map(pieces, find(unit))) if known is None else known

    def count(self, text: bytes | None) -> int:
        if not text:
            return 0
        string = text.decode("utf-8", "replace")
        if _ODD_SPACE.search(string) or any(s in string for s in self.special):
            return len(self.tokenizer.encode(string, add_special_tokens=False).ids)
        if len(self.units) > CACHE_UNITS:
            self.older, self.units = self.units, {}
        units = _UNITS.findall(string)
        try:
            return sum(map(self.units.__getitem__, units))
        except KeyError:
            self.learn(set(units).difference(self.units))
        return sum(map(self.units.__getitem__, units))


def _library(description: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    parts = json.loads(description)
    before = parts.get("pre_tokenizer") or {}
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or parts.get("normalizer"):
        raise ValueError("a byte-level BPE file without normalizer or prefix space is needed")
    tokenizer = Tokenizer.from_str(description)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = 1024, *keep: str) -> DataFrame:
    """``keep``, n_bytes, n_tokens and over_limit of every row's whole ``text``.

    The driver proves once which vocabulary strings encode alone as one token.
    Tasks cut texts into pre-tokens, count the proven ones directly and give only
    the other pre-tokens to the library, each once per task.  Null and empty
    texts have no bytes and no tokens.  Repeated rows and other columns do not
    matter; the proof and the vocabulary are the size of the tokenizer file.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        description = file.read()
    proven = proven_strings(_library(description))
    sent = docs.sparkSession.sparkContext.broadcast((description, proven))
    state: list[Counter] = []

    def work(texts: list[bytes | None]) -> dict[str, object]:
        if not state:
            state.append(Counter(*sent.value))
        return {
            "n_bytes": np.array([len(t or b"") for t in texts], np.int64),
            "n_tokens": np.array([state[0].count(t) for t in texts], np.int64),
        }

    counted = per_text(docs, "n_bytes long, n_tokens long", work, *(keep or ("doc_id",)))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
