"""Links between the tokens of two tokenizers, against counting them pair by pair."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import no_documents, odd_documents, odd_rows
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rebasket.llm import align
from rebasket.llm.align import Aligner, align_texts, whole_units
from rebasket.llm.tokens import _byte_letters

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


class Plain:
    """Both tokenizers over whole texts, one pair of tokens at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=FILES[1])
        letters = {c: b for b, c in _byte_letters().items()}
        self.letters = {
            k: bytes(letters[c] for c in s) for s, k in self.a.get_vocab().items() if s != "<|endoftext|>"
        }

    def piece(self, k: int) -> bytes:
        text = self.b.id_to_piece(k)
        return bytes([int(text[3:-1], 16)]) if self.b.is_byte(k) else text.replace("\u2581", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        parts = [self.letters[k] for k in ids[0]], [self.piece(k) for k in ids[1]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return []
        ends = [{e: k for k, e in enumerate(np.cumsum([len(x) for x in p]).tolist(), 1)} for p in parts]
        found, last = [], [0, 0]
        for end in sorted(ends[0].keys() & ends[1].keys()):
            stops = [e[end] for e in ends]
            found.append(tuple(ids[s][last[s] : stops[s]] for s in (0, 1)))
            last = stops
        return found

    def rows(self, texts: list[tuple]) -> tuple[list[tuple], dict]:
        grouped = [(k, self.groups(t)) for k, t in texts]
        links = [Counter((x, y) for g in gs for x in g[0] for y in g[1]) for _, gs in grouped]
        held, total = Counter(), Counter()
        for own in links:
            held.update(own.keys())
            total.update(own)
        highest = defaultdict(int)
        for (x, _), n in held.items():
            highest[x] = max(highest[x], n)
        rows = []
        for (key, gs), own in zip(grouped, links):
            text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in gs)
            rows.append(
                (
                    key,
                    sum(len(g[0]) for g in gs),
                    sum(len(g[1]) for g in gs),
                    len(gs),
                    sum(own.values()),
                    hashlib.sha256(text.encode()).hexdigest() if gs else "",
                    sum(m for p, m in own.items() if held[p] == highest[p[0]]),
                    sum(m * held[p] for p, m in own.items()),
                )
            )
        return rows, {p: (n, total[p]) for p, n in held.items()}


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
ODD = [
    "a ", " a", "  ", "\n", " \n x", "x\r\n y", "tab\tand  two", "\u2581x", "a\u2581", "\x00", "<s> <unk> <0x41>",
    "x" * 5000, "ab " * 3000, "\u6f22\u5b57" * 40, "e\u0301\u00a0z \u3000 q", "\U0001f600 \U0001f600", "it's  'll", "\x1c x", "a\n\n\nb",
]


def ordered(rows) -> list:
    return sorted(rows, key=repr)


@pytest.mark.parametrize("postings", [align.CHUNK_POSTINGS, 200])
def test_links_are_those_counted_one_by_one(spark, monkeypatch, postings):
    monkeypatch.setattr(align, "CHUNK_POSTINGS", postings)  # many chunks
    monkeypatch.setattr(align, "SLICE_BYTES", 8 * postings)
    texts, pairs = align_texts(odd_documents(spark), *FILES)
    rows, counts = Plain().rows([r[:2] for r in odd_rows()])
    assert tuple(texts.columns) == COLUMNS
    assert ordered(map(tuple, texts.collect())) == ordered(rows)
    found = {(r.a, r.b): (r["count"], r.links) for r in pairs.collect()}
    assert found == counts
    for r in pairs.filter("best").collect():
        assert r["count"] == max(n for (x, _), (n, _) in counts.items() if x == r.a)


def test_odd_texts(spark):
    texts = list(enumerate([*ODD, None, ""]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows, _ = Plain().rows(texts)
    assert ordered(map(tuple, align_texts(docs, *FILES)[0].collect())) == ordered(rows)


def test_bitmaps(monkeypatch):
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 9, 40_000) ** 4 << 16 | rng.integers(0, 1 << 16, 40_000))
    for most in (align.ARRAY_MOST, 3, 50_000):
        monkeypatch.setattr(align, "ARRAY_MOST", min(most, 4096))
        codes, held, bits = align._bitmaps(keys >> 16, keys & 0xFFFF)
        for part in (slice(0, None), slice(2, 5)):
            slots, owners = align._places(bits[part])
            back = np.sort(codes[part][owners] << 16 | slots)
            assert back.tolist() == keys[np.isin(keys >> 16, codes[part])].tolist()
        assert held.sum() == len(keys)


def test_units_encode_as_the_whole_text(monkeypatch):
    monkeypatch.setattr(align, "CACHE_UNITS", 20)  # dropped again and again
    rng = random.Random(5)
    with open(FILES[0], encoding="utf-8") as file:
        aligner = Aligner(file.read(), open(FILES[1], "rb").read())
    assert aligner.cut and whole_units(aligner.right)
    plain, letters = Plain(), [*"ab cd   \n\t.,'1e\u00e9\u6f22", "the", " of", "\x0b", "\x0c", "\r", "it's", "--"]
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(1500)]
    made = [aligner.texts([t.encode() for t in texts[k : k + 50]]) for k in range(0, 1500, 50)]
    sizes = np.concatenate([m.sizes for m in made])
    for k, text in enumerate(texts):
        groups = plain.groups(text)
        assert sizes[k, :3].tolist() == [sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups)]


def test_no_texts(spark):
    texts, pairs = align_texts(no_documents(spark), *FILES)
    assert tuple(texts.columns) == COLUMNS and texts.count() == 0 and pairs.count() == 0


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF' AS STRING) AS text")
    assert tuple(align_texts(docs, *FILES)[0].first()) == (1, 0, 0, 0, 0, "", 0, 0)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "x y", "k", 2)], "doc_id long, text string, kind string, chunk int")
    texts, _ = align_texts(docs, *FILES, "chunk", "doc_id", "kind")
    assert texts.columns[:3] == ["chunk", "doc_id", "kind"] and texts.first()[:3] == (2, 1, "k")
