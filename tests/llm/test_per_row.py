"""Operators that judge each row alone: tokens, licences, decontamination, toxicity."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from llm_cases import no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rebasket.llm import decontaminate, toxicity
from rebasket.llm.decontaminate import clean, contamination_digest, find_contamination, phrases_of, search_texts
from rebasket.llm.fm_index import FmIndex
from rebasket.llm.licences import ERROR_SHARE, NOTICES, NoticeSearch, scan_licences
from rebasket.llm.text import plain_words
from rebasket.llm.tokens import Counter, count_tokens, proven_strings

FILE = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


def rows_of(frame, *key):
    return sorted((tuple(r) for r in frame.select(*key).collect()), key=repr)


# Tokens


def test_token_counts_are_those_of_the_library(spark):
    tokenizer = Tokenizer.from_file(FILE)
    expected = []
    for doc_id, text, *_ in odd_rows():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 1024))
    got = count_tokens(odd_documents(spark), FILE)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert count_tokens(no_documents(spark), FILE).count() == 0


def test_token_counts_of_random_strings(monkeypatch):
    from rebasket.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_UNITS", 50)
    tokenizer = Tokenizer.from_file(FILE)
    counter = Counter(Path(FILE).read_text(encoding="utf-8"), proven_strings(tokenizer))
    rng = random.Random(4)
    letters = [*"ab cd  \n\t.,'1é漢", " ", "　", "\x1c", "\x85", "​", " ", "<|endoftext|>", "it's", "\r\n", "  x"]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 25)))
        assert counter.count(text.encode()) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_proven_strings_are_single_tokens():
    tokenizer = Tokenizer.from_file(FILE)
    strings = sorted(proven_strings(tokenizer))
    assert len(strings) > 40_000
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(strings[::97], add_special_tokens=False))


# Licences


def test_base_places_and_labels(spark):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    expected = []
    for doc_id, text, *_ in odd_rows():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        at = [(k, l) for p, l in phrases.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        places = [k for k, _ in at]
        labels = ",".join(sorted({l for _, l in at}))
        expected.append((doc_id, len(words), len(at), min(places, default=None), max(places, default=None), labels))
    got = scan_licences(odd_documents(spark))
    assert rows_of(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(expected, key=repr)
    assert scan_licences(no_documents(spark)).count() == 0


def test_notices_with_errors_are_found(spark):
    rows = [
        (1, "This is under the MIT licence."),
        (2, "Permission is hereby granted, fre of charge, to any persn obtaining a copy"),
        (3, "Licensed under teh Apache License, Version 2.0"),
        (4, "permission to walk the dog, and a commit licence"),
        (5, "general public transport"),
    ]
    got = {r["doc_id"]: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and 0 < got[1]["score"] < 1
    assert got[1]["spans"][0]["first_word"] == 4 and got[1]["spans"][0]["n_words"] == 2
    assert got[2]["labels"] == "mit" and got[2]["spans"][0]["edits"] == 2
    assert got[3]["labels"] == "apache" and got[3]["base_labels"] == "apache" and got[3]["score"] == 1
    assert got[5]["labels"] == "" and got[5]["score"] == 0


def test_notices_with_errors_are_found_beside_better_ones():
    search = NoticeSearch(NOTICES, ERROR_SHARE)
    notice = list(NOTICES)[1]
    wrong = notice.replace("hereby", "herby")
    twice = wrong.replace("obtaining", "obtainin")
    for parts, label in (
        (["mit licence", "mit license"], "mit"),
        ([wrong, notice], "mit"),
        ([wrong, twice, notice], "mit"),
        ([notice, wrong, notice, twice], "mit"),
        (["all rights reservd", "all rights reserved", "all right reserved"], "proprietary"),
    ):
        text, expected = " ", []
        for part in parts:
            expected.append((label, len(text) - 1, len(text) + len(part) + 1))
            text += part + " "
        found = sorted(search.matches(text), key=lambda m: m.begin)
        assert [(m.label, m.begin, m.end) for m in found] == expected
        assert [m.edits == 0 for m in found] == [p in NOTICES for p in parts]


def test_edits_are_characters_and_words_are_counted_once(spark):
    many = "MIT license, " * 3000
    rows = [(1, "é mit licénse ü"), (2, many), (3, "mit\u00a0license"), (4, "漢字 all rights resérved")]
    got = {r["doc_id"]: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[1]["spans"]] == [("mit", 1, 2, 1)] and got[1]["n_base"] == 0
    assert [s["first_word"] for s in got[2]["spans"]] == list(range(0, 6000, 2)) and got[2]["n_base"] == 3000
    assert got[3]["labels"] == "mit" and got[3]["n_words"] == 1
    assert [tuple(s) for s in got[4]["spans"]] == [("proprietary", 1, 3, 1)]


def _fewest_edits(notice: str, text: str) -> int:
    """Of ``notice`` against any part of ``text``, by the plain table of distances."""
    above = [0] * (len(text) + 1)
    for k, c in enumerate(notice, 1):
        row = [k]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def test_notices_are_found_by_edit_distance():
    rng = random.Random(11)
    search = NoticeSearch(NOTICES, ERROR_SHARE)
    for notice, k in zip(NOTICES, search.errors):
        for edits in range(k + 3):
            letters = list(notice)
            for _ in range(edits):
                at = rng.randrange(len(letters))
                letters[at : at + 1] = rng.choice(["", "é", "x", letters[at] + "q"])
            words = "".join(letters).split()
            text = f" some words {' '.join(words)} stand here "
            found = {(m.label, m.length) for m in search.matches(text)}
            for other, bound in zip(NOTICES, search.errors):
                near = _fewest_edits(f" {other} ", text) <= bound
                assert near == ((NOTICES[other], len(other) + 2) in found), (text, other)


# Decontamination


def brute_hits(words, items, window):
    hit, names = set(), set()
    for name, text in items:
        own = plain_words(text)
        for k in range(max(len(own) - window + 1, min(len(own), 1))):
            part = own[k : k + window]
            for i in range(len(words) - len(part) + 1):
                if words[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    names.add(name)
    return sorted(hit), sorted(names)


def test_index_finds_every_place():
    rng = np.random.default_rng(3)
    for _ in range(30):
        symbols = np.append(rng.integers(1, 5, rng.integers(1, 200)), 0)
        index = FmIndex(symbols, 5)
        for width in (1, 2, 5):
            patterns = rng.integers(1, 5, (6, width))
            low, high = index.search(patterns, np.full(6, width))
            for p, a, b in zip(patterns, low, high):
                want = [k for k in range(len(symbols) - width) if (symbols[k : k + width] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_windows_against_brute_force(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 13)
    rng = random.Random(5)
    for _ in range(120):
        words = [b"a", b"b", b"c", b"dd", b"e1"][: rng.randint(1, 5)]
        items = [(str(i), b" ".join(rng.choices(words, k=rng.randint(0, 7)))) for i in range(rng.randint(0, 4))]
        docs = [rng.choices([*words, b"z"], k=rng.randint(0, 40)) for _ in range(rng.randint(1, 5))]
        for doc, (spans, names) in zip(docs, search_texts(docs, phrases_of(items, 4))):
            hit = sorted({k for s in spans for k in range(s["begin"], s["end"])})
            assert (hit, names) == brute_hits(doc, items, 4)


@pytest.mark.parametrize("block_words", [1_000_000, 2])
def test_contamination_of_odd_tables(spark, block_words):
    items = [
        (1, "same same row"),
        (2, "Copy of one text copy of one text copy of one text copy"),
        (3, None),
        (4, ""),
        (None, "word"),
        (2, "ünï çödé"),
        (30, "IT'S"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination_digest(find_contamination(odd_documents(spark), table, block_words=block_words))
    named = [("" if i is None else str(i), (t or "").encode()) for i, t in items]
    expected = []
    for doc_id, text, *_ in odd_rows():
        words = plain_words((text or "").encode())
        if len(words) > 50_000:
            hit, names = [], []
        else:
            hit, names = brute_hits(words, named, 10)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        expected.append((doc_id, len(words), len(hit), len(names), sha, bool(hit)))
    assert rows_of(got, *got.columns) == sorted(expected, key=repr)
    assert find_contamination(no_documents(spark), table).count() == 0
    assert find_contamination(odd_documents(spark), table.limit(0)).filter("size(spans) > 0").count() == 0


def test_clean_cuts_passages_and_keeps_the_rest(spark):
    items = spark.createDataFrame([(1, "same same row"), (2, "of one text copy of one text copy of one")], "item_id long, text string")
    docs = odd_documents(spark)
    left = clean(docs, items)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 15 not in ids and {1, 4, 5, 6, 12}.issubset(ids) and ids.count(13) == 2 and None in ids
    found = {r["doc_id"]: r for r in left.collect()}
    assert found[1]["text"] == odd_rows()[0][1] and found[4]["text"] is None
    assert found[20]["text"].split() == ["copy", "text"] and found[20]["n_chars"] == len(found[20]["text"])
    again = find_contamination(left, items).filter("size(spans) > 0")
    assert again.count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    assert 0 < len(model["index"]) < 50_000
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter(toxicity.held_out())
    rows = scored.select("score", "predicted", "toxic").toPandas()
    order = rows["score"].rank()
    toxic = rows["toxic"] == 1
    area = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.95
    assert rows["toxic"][rows["predicted"] == 1].mean() > 0.9
    assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame(
        [(k, int(k == 8)) for k in range(1, 40)] + [(None, 1), (3, None), (8, 0)], "doc_id long, toxic int"
    )
    docs = odd_documents(spark)
    for known in (labels, labels.limit(0)):
        model = toxicity.fit(docs, known, ~toxicity.held_out())
        scored = toxicity.score_toxicity(docs, model)
        assert scored.count() == docs.count()
        assert scored.filter("score between 0 and 1 and predicted in (0, 1)").count() == docs.count()
        kept = toxicity.accepted(docs, model, 2.0)
        assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 and kept.count() == docs.count()
    assert toxicity.score_toxicity(no_documents(spark), model).count() == 0


def test_learning_equals_plain_ftrl():
    rng = random.Random(3)
    rows = [np.array([0, *sorted(rng.sample(range(1, 60), rng.randrange(8)))], np.int32) for _ in range(200)]
    marks = [int(7 in r or rng.random() < 0.1) for r in rows]
    settings = toxicity.Ftrl(l1=0.5, l2=0.1, epochs=2)
    z, n = toxicity.learn(rows, marks, settings)
    plain_z, plain_n = [0.0] * 60, [0.0] * 60

    def weight(i):
        if abs(plain_z[i]) <= settings.l1:
            return 0.0
        rate = (settings.beta + math.sqrt(plain_n[i])) / settings.alpha + settings.l2
        return -(plain_z[i] - math.copysign(settings.l1, plain_z[i])) / rate

    for _ in range(settings.epochs):
        for row, mark in zip(rows, marks):
            weights = {int(i): weight(i) for i in row}
            gradient = 1 / (1 + math.exp(-sum(weights.values()))) - mark
            for i, w in weights.items():
                sigma = (math.sqrt(plain_n[i] + gradient**2) - math.sqrt(plain_n[i])) / settings.alpha
                plain_z[i] += gradient - sigma * w
                plain_n[i] += gradient**2
    assert np.allclose(z[:60], plain_z) and np.allclose(n[:60], plain_n) and not n[60:].any()


def test_one_text_per_id_and_a_worker_without_rows(spark):
    docs = spark.createDataFrame([(1, "so bad"), (1, "a fine day")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    settings = toxicity.Ftrl(l1=0.01)
    model = toxicity.fit(docs, labels, F.lit(True), settings)
    z, n = toxicity.learn(toxicity.features([b"a fine day"]), [1], settings)
    index = np.flatnonzero(np.abs(z) > settings.l1)
    assert model["index"].tolist() == index.tolist()
    assert np.allclose(model["weight"], settings.weights(z[index], n[index]))


def test_held_out_is_the_checksum_of_the_id(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    got = {r[0]: r[1] for r in ids.select("doc_id", toxicity.held_out()).collect()}
    assert all(v == (zlib.crc32(str(k).encode()) % 4 == 2) for k, v in got.items())
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(toxicity.held_out()).first()[0] is False
