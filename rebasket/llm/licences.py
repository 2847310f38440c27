"""Licence notices, exact and with bounded errors (operator 4)."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rebasket.llm.text import per_text, plain_words

# The phrases whose exact places are counted, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Short notices that are also found with errors, and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "general public license": "gpl",
    "gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc",
    "all rights reserved": "proprietary",
}

ERROR_SHARE = 0.1
"""Edits allowed per character of a notice, rounded down."""


@dataclass(frozen=True)
class Match:
    label: str
    begin: int  # of the matched characters in the words joined by spaces
    end: int
    edits: int
    length: int


class NoticeSearch:
    """Finds notices in words joined by single spaces, with at most k edits each.

    A notice is split into k + 1 pieces, so k edits leave one piece untouched.
    All pieces are sought together; around each, the bounded-error matcher
    verifies the notice and reports its best span.  Of spans of one notice that
    overlap the one with the fewest edits stays; neighbours share a space.
    """

    def __init__(self, notices: Mapping[str, str], error_share: float):
        self.labels = list(notices.values())
        self.texts = [f" {n} " for n in notices]
        self.errors = [int(len(n) * error_share) for n in notices]
        self.patterns = [
            regex.compile(f"(?b)(?: {regex.escape(n, literal_spaces=True)} ){{e<={k}}}")
            for n, k in zip(notices, self.errors)
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (text, k) in enumerate(zip(self.texts, self.errors)):
            cuts = np.linspace(0, len(text), k + 2).astype(int)
            for begin, end in zip(cuts[:-1], cuts[1:]):
                seeds.setdefault(text[begin:end], []).append((number, int(begin)))
        self.seeds = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.seeds.add_word(seed, (len(seed), owners))
        self.seeds.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Parts of the text that may hold a notice: number, begin and end, one per place of a piece."""
        found = set()
        for last, (length, owners) in self.seeds.iter(text):
            for number, offset in owners:
                found.add((number, last + 1 - length - offset))
        for number, begin in sorted(found):
            k = self.errors[number]
            yield number, max(begin - k, 0), begin + len(self.texts[number]) + k

    def matches(self, text: str) -> list[Match]:
        spans: dict[int, set[tuple[int, int, int]]] = {}
        for number, begin, end in self.windows(text):
            hit = self.patterns[number].search(text, begin, min(end, len(text)))
            if hit:
                spans.setdefault(number, set()).add((sum(hit.fuzzy_counts), hit.start(), hit.end()))
        found = []
        for number, own in spans.items():
            begins: list[int] = []
            ends: list[int] = []
            for edits, begin, end in sorted(own):
                at = bisect_left(begins, begin)
                if (at and ends[at - 1] - begin > 1) or (at < len(begins) and end - begins[at] > 1):
                    continue
                begins.insert(at, begin)
                ends.insert(at, end)
                found.append(Match(self.labels[number], begin, end, edits, len(self.texts[number])))
        return found


def phrase_places(text: bytes, phrases: Sequence[bytes]) -> dict[bytes, list[int]]:
    """First word of every place of each phrase; ``text`` is words between single spaces."""
    places = {}
    for phrase in phrases:
        at, starts = text.find(phrase), []
        while at >= 0:
            starts.append(at)
            at = text.find(phrase, at + 1)
        if starts:
            words, before, passed = [], 0, 0
            for s in starts:
                passed += text.count(b" ", before, s)
                before = s
                words.append(passed)
            places[phrase] = words
    return places


def scan_licences(
    docs: DataFrame,
    *keep: str,
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, str] = NOTICES,
    error_share: float = ERROR_SHARE,
) -> DataFrame:
    """``keep`` and the licence notices of every row's whole ``text``.

    n_words; n_base, first_word, last_word and base_labels of the exact phrases
    (words counted from 0, null without a place); labels, which also holds what
    the search with errors found; ``spans`` (label, first_word, n_words, edits)
    of its matches; and score, the best match's share of characters without
    edits, 1 for an exact phrase and 0 without any.  Null and empty texts have
    no words and no labels.  A row is judged alone, whatever its length, so
    repeated rows get the same result; no row leaves its task.
    """
    marks = {f" {p} ".encode(): label for p, label in phrases.items()}
    state: list[NoticeSearch] = []

    def work(texts: list[bytes | None]) -> dict[str, object]:
        if not state:
            state.append(NoticeSearch(notices, error_share))
        rows = [_scan(t, marks, state[0]) for t in texts]
        n_words, n_base, first, last, base, labels, score, spans = zip(*rows)
        return {
            "n_words": pa.array(n_words, pa.int64()),
            "n_base": pa.array(n_base, pa.int64()),
            "first_word": pa.array(first, pa.int64()),
            "last_word": pa.array(last, pa.int64()),
            "base_labels": pa.array(base, pa.string()),
            "labels": pa.array(labels, pa.string()),
            "score": pa.array(score, pa.float64()),
            "spans": pa.array(spans, pa.list_(_SPAN)),
        }

    return per_text(
        docs,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "spans array<struct<label: string, first_word: bigint, n_words: bigint, edits: int>>",
        work,
        *(keep or ("doc_id",)),
    )


_SPAN = pa.struct(
    [("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())]
)


def _scan(text: bytes | None, marks: Mapping[bytes, str], search: NoticeSearch) -> tuple:
    words = plain_words(text)
    joined = b" " + b" ".join(words) + b" " if words else b""
    places = phrase_places(joined, list(marks))
    starts = [s for found in places.values() for s in found]
    base = {marks[p] for p in places}
    letters = joined.decode("utf-8", "surrogateescape")  # an edit is a character, not a byte
    matches = search.matches(letters)
    spans, passed, before = [], 0, 0
    for m in sorted(matches, key=lambda m: (m.begin, m.end, m.label)):
        passed += letters.count(" ", before, m.begin + 1)
        before = m.begin + 1
        first_word = passed - (m.begin < len(letters) and letters[m.begin] == " ")
        inside = len(letters[m.begin : m.end].strip(" ").split(" "))
        spans.append({"label": m.label, "first_word": first_word, "n_words": inside, "edits": m.edits})
    score = max([1.0 - m.edits / m.length for m in matches] + [1.0] * bool(base), default=0.0)
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {m.label for m in matches})),
        score,
        spans,
    )
