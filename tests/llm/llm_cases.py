"""Awkward tables and brute-force answers for the training-data operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "n_words long, score double, row string, node long, bucket long, size long, shard string, spans string, body string, gone long"

WORDS = [f"w{k}" for k in range(400)]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choices(WORDS, k=n)).capitalize() + "."


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties and repeated rows, near and exact copies."""
    rng = random.Random(11)
    passage = " ".join(sentence(rng, n) for n in (14, 12, 9, 20))
    base = [sentence(rng, 12) for _ in range(12)]
    text = " ".join(base)
    near = " ".join([*base[:11], base[11].replace("w", "v", 1)])
    rows = [
        (1, text, "en", "a", 10),
        (2, text, "en", "b", 10),
        (3, near, "de", "a", 10),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \t\n ", None, "b", 4),
        (7, "word", "en", "c", 4),
        (8, "idiot " + sentence(rng, 30) + " moron", "en", "c", 4),
        (9, sentence(rng, 40) + " " + passage, "en", "a", 4),
        (10, passage + "\n" + sentence(rng, 33), "en", None, 4),
        (11, " ".join(rng.choices(WORDS, k=60_000)), "en", "a", 4),
        (12, "Ünï çödé\x00 <|endoftext|> it's 漢字  x", "fr", "d", 4),
        (None, sentence(rng, 25), None, None, None),
        (13, sentence(rng, 25), "en", "\U0001f600", 4),
        (13, sentence(rng, 25), "en", "￿", 4),
        (14, "the mit license. Apache   License, MIT-license; general public licence", "en", "a", 4),
    ]
    rows += [(15, "same same row", "en", "a", 4)] * 3
    rows += [(20 + k, "copy of one text " * 20, "en", "hot", 4) for k in range(40)]
    return rows


def odd_documents(spark):
    extra = (1, 0.5, "r", 3, 4, 5, "s", "x", "y", 6)
    return spark.createDataFrame([r + extra for r in odd_rows()], f"{DOCUMENTS}, {EXTRA}")


def no_documents(spark):
    return spark.createDataFrame([], f"{DOCUMENTS}, {EXTRA}")


def plain_table(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


def spaced(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None, width: int) -> set:
    words = spaced(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def classes(sets: dict[int, set], percent: int = 80) -> dict[int, int]:
    """The smallest reachable id of every id, comparing all pairs."""
    parent = {k: k for k in sets}

    def root(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in ids}
