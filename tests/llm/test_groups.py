"""Operators that bring rows together: mixes, classes, passages, shards, searches, language model."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import classes, no_documents, odd_documents, odd_rows, plain_table, shingles, spaced
from pyspark.sql import functions as F

from rebasket.llm import gru, links, lm, minhash, paragraphs, topk
from rebasket.llm.components import components
from rebasket.llm.membership import holds, membership
from rebasket.llm.mixing import Permutation, mix, mixed_documents, mixed_words, targets
from rebasket.llm.prefix import with_offset
from rebasket.llm.sharding import shard_documents, sharded_rows


def rows_of(frame, *key):
    return sorted((tuple(r) for r in frame.select(*key).collect()), key=repr)


# Helpers


def test_components_of_random_links(spark):
    rng = random.Random(2)
    for size, count in ((30, 12), (40, 60), (200, 199)):
        pairs = [(rng.randrange(size), rng.randrange(size)) for _ in range(count)]
        if size == 200:
            pairs = [(k, k + 1) for k in range(199)]  # one long path
        parent = list(range(size))

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in pairs:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        linked = {k for a, b in pairs if a != b for k in (a, b)}
        got = components(spark.createDataFrame(pairs, "a long, b long"))
        assert rows_of(got, "node", "component") == sorted(((k, root(k)) for k in linked), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("few", [0, 6])
def test_link_rounds_lose_no_link_of_a_bucket(spark, monkeypatch, few):
    """Numbers are linked if they differ by one; classes are runs of numbers, whatever the buckets."""
    monkeypatch.setattr(links, "FEW", few)
    monkeypatch.setattr(links, "PIVOTS", (1, 2, 4))
    rng = random.Random(3)
    buckets = {b: rng.sample(range(60), rng.randint(2, 25)) for b in range(4)}
    rows = [(b, n) for b, own in buckets.items() for n in own]
    got = links.link_classes(
        spark.createDataFrame(rows, "bucket long, node long").withColumn("size", F.lit(1)), lambda pairs: pairs.filter("b = a + 1")
    )
    sets = {n: set() for own in buckets.values() for n in own}
    parent = {n: n for n in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for own in buckets.values():
        for n in own:
            if n + 1 in own:
                x, y = root(n), root(n + 1)
                parent[max(x, y)] = min(x, y)
    found = {r["node"]: r["component"] for r in got.collect()}
    assert {n: found.get(n, n) for n in sets} == {n: root(n) for n in sets}


def test_membership_never_says_no_to_a_member(spark):
    inside = spark.range(500).select(F.xxhash64("id").alias("hash"))
    found = membership(inside, 500)
    assert holds(spark.range(500), found, F.xxhash64("id")).count() == 500
    assert holds(spark.range(10_000, 20_000), found, F.xxhash64("id")).count() < 1000
    assert holds(spark.range(100), membership(inside.limit(0), 0), F.xxhash64("id")).count() == 0


def test_offsets_are_running_sums(spark):
    rows = [(k % 3 or None, k, 5) for k in range(100)] + [(1, 7, 2)] * 3
    frame = spark.createDataFrame(rows, "g long, id long, size long")
    placed = with_offset(frame, "g", F.col("size"), ["id", "size"], "at", buckets=4)
    by_group = defaultdict(list)
    for r in placed.collect():
        by_group[r["g"]].append((r["at"], r["size"]))
    for own in by_group.values():
        ends = list(itertools.accumulate(s for _, s in sorted(own)))
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1]]


# Mixing


def test_targets_share_what_capped_sources_leave():
    assert targets([100, 100], [3, 1], 1.0, 2) == [150.0, 50.0]
    assert targets([10, 100], [3, 1], 1.5, 2) == [20.0, 145.0]
    assert targets([0, 10], [3, 1], 1.5, 2) == [0.0, 15.0]
    assert targets([], [], 1.5, 2) == []


def test_permutations():
    for n in (1, 2, 3, 7, 1000):
        p = Permutation(n, 5, n)
        image = p(np.arange(n))
        assert sorted(image.tolist()) == list(range(n)) and (p.inverse(image) == np.arange(n)).all()


@pytest.mark.parametrize("block_words, shard_slots", [(256, 65_536), (3, 10)])
def test_mix_meets_its_targets(spark, block_words, shard_slots):
    docs = odd_documents(spark)
    made = mix(docs, "doc_id", block_words=block_words, shard_slots=shard_slots)
    rows = mixed_words(made).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in rows) == sorted(
        (i is None, i, len(spaced(t))) for i, t, *_ in odd_rows()
    )
    sizes = Counter()
    for _, text, _, source, _ in odd_rows():
        sizes[source] += len(spaced(text))
    names = sorted(n for n in sizes if n is not None) + [None]
    assert names[-3:] == ["￿", "\U0001f600", None]
    wanted = targets([sizes[n] for n in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2)
    by_target = dict(zip(names, wanted))
    assert {s.name: s.target for s in made.sources} == by_target
    taken = Counter()
    for r in made.pieces.collect():
        taken[names[r["source"]]] += r["n_words"]
    assert all(abs(taken[n] - by_target[n]) <= 0.5 for n in names)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == sum(taken.values())
    slots = made.pieces.groupBy("shard", "slot").agg(
        F.sum("n_words").alias("n"), F.countDistinct("source").alias("s"), F.countDistinct("begin").alias("b"), F.count("*").alias("c")
    )
    assert slots.filter(f"n > {block_words} or s > 1 or b < c").count() == 0
    again = mix(docs, "doc_id", block_words=block_words, shard_slots=shard_slots)
    key = ["shard", "slot", "begin", "source", "pass", "offset", "first_word", "n_words"]
    assert rows_of(again.pieces, *key) == rows_of(made.pieces, *key)
    assert mixed_words(mix(no_documents(spark), "doc_id")).count() == 0


def test_mixed_documents_hold_the_words_of_the_mix(spark):
    docs = odd_documents(spark)
    made = mixed_documents(docs, block_words=5, shard_slots=10)
    assert made.columns == docs.columns
    got = Counter()
    texts = defaultdict(set)
    for i, t, *_ in odd_rows():
        texts[i].update(spaced(t))
    for r in made.collect():
        got[r["doc_id"]] += len(spaced(r["text"]))
        assert set(spaced(r["text"])) <= texts[r["doc_id"]]
    want = Counter()
    for r in mixed_words(mix(docs, "doc_id", block_words=5, shard_slots=10)).collect():
        want[r["doc_id"]] += r["taken"]
    assert got == +want
    assert mixed_documents(no_documents(spark)).count() == 0


# Near duplicates


@pytest.mark.parametrize("width", [2, 5])
def test_classes_against_all_pairs(spark, width):
    docs = odd_documents(spark)
    got = minhash.near_duplicates(docs, width)
    assert got.count() == docs.count()
    named = [(i, t) for i, t, *_ in odd_rows() if i is not None]
    sets: dict[int, set] = {}
    for i, t in named:
        sets[i] = sets.get(i, set()) | shingles(t, width) if i != 13 else shingles(t, width)
    expected = classes(sets)
    for r in got.collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    counts = Counter((i, len(shingles(t, width))) for i, t, *_ in odd_rows())
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got.collect()) == counts
    assert minhash.near_duplicates(no_documents(spark), width).count() == 0


def test_chains_of_near_copies(spark, monkeypatch):
    """Each copy differs from the one before by a word, so far ones are linked by way of others only."""
    monkeypatch.setattr(links, "FEW", 2)
    rng = random.Random(8)
    words, rows = [f"t{k}" for k in range(60)], []
    for k in range(40):
        rows.append((1000 - k, " ".join(words)))
        words[rng.randrange(60)] = f"n{k}"
    rows += [(k, " ".join(f"x{rng.randrange(30)}" for _ in range(25))) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = classes({i: shingles(t, 2) for i, t in rows})
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame, 2).collect()}
    assert got == expected


def test_joint_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8, 0.95):
        found = []
        for _ in range(30):
            both = rng.integers(0, 2**63, 2000).astype(np.uint64)
            cut = int(2000 * share)
            half = (2000 - cut) // 2
            a, b = both[: cut + half], np.concatenate((both[:cut], both[cut + half :]))
            regs = [np.frombuffer(r, ">u2").astype(np.int32)[None, :] for r in minhash.registers([a, b])[0]]
            found.append(minhash.joint_estimate(*regs, np.array([len(a)]), np.array([len(b)]))[0])
        assert abs(np.mean(found) - share) < 0.03


def test_one_row_of_each_class_stays(spark):
    docs = odd_documents(spark)
    left = minhash.keep_one_per_class(docs, 5)
    assert left.columns == docs.columns
    ids = Counter(r["doc_id"] for r in left.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[20] == 1 and ids[21] == 0 and ids[15] == 1 and ids[None] == 1
    assert ids[4] == ids[5] == ids[6] == 1 and ids[13] == 1


# Passages


def test_passages_of_odd_tables(spark):
    got = paragraphs.repeated_passages(odd_documents(spark)).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    assert {1, 2, 3, 9, 10} <= set(by_doc) and not {4, 5, 6, 7, 8, 11, 12, 13, None} & set(by_doc)
    assert all(r["removed"] == (r["doc_id"] != r["kept_doc_id"]) for r in got)
    ten = by_doc[10][0]
    assert ten["first_word"] == 0 and ten["n_words"] == 55 and ten["kept_doc_id"] == 9
    assert by_doc[9][0]["first_word"] == 40 and by_doc[9][0]["n_words"] == 55
    assert paragraphs.repeated_passages(no_documents(spark)).count() == 0


def test_long_shared_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(21)

    def text(n):
        return " ".join(f"{''.join(rng.choices('abcdefgh', k=5))}{'.' if rng.random() < 0.08 else ''}" for _ in range(n))

    shared = [text(rng.randint(51, 90)) for _ in range(30)]
    rows, truth = [], set()
    for k in range(200):
        parts = [text(rng.randint(20, 120))]
        if k % 2:
            parts.insert(rng.randint(0, 1), rng.choice(shared))
            truth.add(k)
        rows.append((k, rng.choice([" ", "\n", ". "]).join(parts)))
    used = Counter(s for _, t in rows for s in shared if s in t)
    truth = {k for k, t in rows if any(used[s] > 1 and s in t for s in shared)}
    got = {r["doc_id"] for r in paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got - truth and len(truth - got) <= 0.05 * len(truth)


def test_passages_without_sentence_ends_are_found_whole(spark):
    rng = random.Random(22)

    def text(n):
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))

    rows, expected = [], set()
    for k in range(60):
        n = rng.randint(51, 60) if k % 2 else rng.randint(31, 50)
        shared, head = text(n), rng.randint(5, 90)
        rows.append((3 * k, f"{text(head)} {shared} {text(rng.randint(5, 90))}"))
        # In another stretch, or on a line of its own.
        other = f"{text(head + 9)} {shared} {text(40)}" if k % 3 else f"{text(head + 9)}\n{shared}\n{text(40)}"
        rows.append((3 * k + 1, other))
        rows.append((3 * k + 2, text(80)))
        expected |= {(3 * k, head, n, 3 * k, False), (3 * k + 1, head + 9, n, 3 * k, True)}
    got = paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r["doc_id"], r["kept_doc_id"], r["removed"]): r for r in got.collect()}
    assert set(got) == {(doc, kept, gone) for doc, _, _, kept, gone in expected}
    for doc, first, n, kept, gone in expected:  # a paragraph that is only alike may reach beyond
        r = got[doc, kept, gone]
        assert first - 12 <= r["first_word"] <= first and first + n <= r["first_word"] + r["n_words"] <= first + n + 12


def test_a_passage_of_which_a_part_is_removed_is_reported_whole(spark):
    rng = random.Random(23)

    def sentence(n):
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)) + "."

    one, two, three = (sentence(20) for _ in range(3))
    passage = f"{one} {two} {three}"
    rows = [(3, f"{sentence(15)} {two} {sentence(15)}"), (5, f"{sentence(10)} {passage}"), (9, f"{passage} {sentence(10)}")]
    got = paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "first_word", "n_words", "kept_doc_id", "removed") == [
        (5, 10, 20, 5, False), (5, 30, 20, 3, True), (5, 50, 20, 5, False), (9, 0, 60, 5, True)
    ]


def test_bands_keep_the_recall_they_are_tuned_for():
    bands = paragraphs.tuned_bands(80, 0.002, 3)
    assert (1 - 0.8**3) ** bands <= 0.002 < (1 - 0.8**3) ** (bands - 1)


# Shards


def test_shards_of_odd_tables(spark):
    docs = odd_documents(spark)
    for shards in (1, 4, 16):
        rows = shard_documents(docs, shards).collect()
        assert len(rows) == docs.count() and {r["shard"] for r in rows} <= set(range(shards))
        by_shard = defaultdict(list)
        for r in rows:
            by_shard[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    facts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == facts
    same = defaultdict(set)
    for r in rows:
        if r["doc_id"] == 15:
            same[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in same.values())
    whole = sharded_rows(docs.drop("row"), 4)
    assert whole.columns == [c for c in docs.columns if c not in ("row", "shard")] + ["shard", "slot"]
    assert whole.count() == docs.count()
    assert shard_documents(no_documents(spark), 16).count() == 0


@pytest.mark.parametrize("rows, shards", [(20, 16), (33, 16), (7, 3), (5, 16)])
def test_there_are_never_more_shards_than_asked_for(spark, rows, shards):
    """Equal documents, which have to be cut one by one."""
    docs = spark.createDataFrame([(k, "the same text") for k in range(rows)], "doc_id long, text string")
    placed = shard_documents(docs, shards).collect()
    sizes = Counter(r.shard for r in placed)
    assert len(placed) == rows and set(sizes) <= set(range(shards))
    assert max(sizes.values()) <= max(2, 2 * -(-rows // shards))
    for shard, n in sizes.items():
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(n))


def test_shards_are_of_equal_bytes_although_a_text_is_hot(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot " * 50)).otherwise(F.repeat(F.col("id").cast("string"), (F.col("id") % 37).cast("int"))).alias("text"),
    )
    placed = shard_documents(docs, 16)
    sizes = [r[0] for r in placed.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 16 and max(sizes) < 1.05 * min(sizes)
    split = placed.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count()
    assert split <= 3
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


# Searches


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.normal(size=4).round(2)]) for k in range(300)]
    rows += [(1000 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(100)] + [(50, [1.0, 2.0]), (51, [1.0, 2.0])]
    rows += [(400, None), (401, [None, 1.0, 1.0, 1.0]), (402, [math.nan, 0.0, 0.0, 0.0]), (403, []), (None, [1.0] * 4)]
    rows += [(7, [9.0, 9.0, 9.0, 9.0])] * 2 + [(600, [1000.0, -1e5, 1e5, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    whole = [
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    expected = []
    for q, v in sorted({(i, v) for i, v in whole if i % 50 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    for rows_in_shard in (8192, 40):
        topk.SHARD_ROWS = rows_in_shard
        got = topk.top_k(frame, F.col("vec_id") % 50 == 0, 5)
        if rows_in_shard == 8192:
            twice = {q for q, *_ in expected if sum(1 for e in expected if e[0] == q) > 5}
        assert [r for r in rows_of(got, "query_id", "rank", "vec_id", "score") if r[0] not in twice] == sorted(
            (e for e in expected if e[0] not in twice), key=repr
        )
    topk.SHARD_ROWS = 8192
    large = [(100, [3e15, -1.0]), (150, [-2e6, 0.25]), (200, [2e6, 1.0]), (1, [5.5, 1e-3]), (2, [2e6, 7.0])]
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in large]
    with pytest.raises(Exception, match="does not fit"):
        frame_of_all = spark.createDataFrame(large, "vec_id long, embedding array<double>")
        topk.top_k(frame_of_all, F.col("vec_id") > 140, 9).collect()
    fine = topk.top_k(
        spark.createDataFrame([r for r in large if r[0] != 100], "vec_id long, embedding array<double>"),
        F.col("vec_id") > 140,
        9,
    )
    expected = [(q, k + 1, i, s) for q, v in whole[1:3] for k, (i, s) in enumerate(sorted(
        ((i, sum(a * b for a, b in zip(v, w))) for i, w in whole if i not in (q, 100)), key=lambda x: (-x[1], x[0])
    ))]
    assert rows_of(fine, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)
    assert topk.products(np.array([[2.0**40, 1.0]]), np.array([[2.0**21, 3.0]])).tolist() == [[2**61 + 3]]
    assert topk.products(np.array([[2.0**31, 1.0]]), np.array([[2.0**31, 3.0]])).tolist() == [[2**62 + 3]]
    assert topk.top_k(frame.limit(0), F.lit(True), 5).count() == 0


# Language model


def brute_base(rows):
    counts = Counter()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows}
    for i, t, *_ in rows:
        if not held[i]:
            counts.update([*spaced(t), b""])
    total, distinct = sum(counts.values()), len(counts)
    for i, t, *_ in rows:
        words = [*spaced(t), b""]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        yield i, held[i], len(words), sum(counts[w] > 0 for w in words), total, base


@pytest.mark.parametrize("head", [200_000, 5])
def test_base_scores_of_odd_tables(spark, monkeypatch, head):
    monkeypatch.setattr(lm.vocabulary, "__defaults__", (head,))
    got = lm.score_texts(odd_documents(spark)).collect()
    want = sorted(brute_base(odd_rows()), key=lambda r: (repr(r[0]), r[2], r[5]))
    got = sorted(got, key=lambda r: (repr(r["doc_id"]), r["n_tokens"], r["base_score"]))
    for r, (i, held, tokens, known, total, base) in zip(got, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, held, tokens, known, total)
        assert r["base_score"] == pytest.approx(base) and -1e9 < r["score"] < 0
    if head == 5:
        assert lm.score_texts(no_documents(spark)).count() == 0
        only = spark.createDataFrame([(6, "a b")], "doc_id long, text string").filter(lm.held_out())
        assert all(math.isfinite(r["score"]) for r in lm.score_texts(only).collect())


def test_chances_of_all_tokens_add_up_to_one():
    share = np.random.default_rng(2).dirichlet(np.ones(gru.WORDS))
    model = gru.fresh(np.log(share))
    state = np.random.default_rng(3).normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = gru.log_chance(model, np.repeat(state, gru.WORDS, axis=0), np.arange(gru.WORDS))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_state_runs_through_whole_texts_whatever_the_lanes():
    rng = np.random.default_rng(4)
    model = gru.fresh(np.log(rng.dirichlet(np.ones(gru.WORDS))))
    model["state"] *= 5
    texts = [rng.integers(0, gru.WORDS, n).astype(np.int16) for n in (1, 700, 3, 40, 41, 2)]
    together, alone = gru.score(model, texts), [gru.score(model, [t])[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)
    h, total = np.zeros((1, gru.HIDDEN), np.float32), 0.0
    for before, token in zip([gru.END, *texts[1][:-1]], texts[1]):
        h, _ = gru._step(model, h, np.array([before]))
        total += gru.log_chance(model, h, np.array([token]))[0]
    assert together[1] == pytest.approx(total, rel=1e-4)


def test_gradients_against_differences():
    rng = np.random.default_rng(6)
    model = {k: v.astype(np.float64) for k, v in gru.fresh(np.log(rng.dirichlet(np.ones(gru.WORDS)))).items()}
    texts = [rng.integers(0, gru.WORDS, 12).astype(np.int16) for _ in range(3)]
    seen = {}

    class Probe(gru.Trainer):
        def _apply(self, grads, given, into, tokens):
            seen.update(grads)

    Probe(model).learn(texts)
    for name, place in (("state", (3, 5)), ("state", (7, 70)), ("class", (2, 4)), ("word_bias", (1, 3))):
        both = []
        for step in (1e-4, -1e-4):
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][place] += step
            both.append(-gru.score(moved, texts).sum())
        assert seen[name][place] == pytest.approx((both[0] - both[1]) / 2e-4, rel=0.02, abs=2e-3)


def test_scores_do_not_depend_on_how_rows_are_spread(spark, monkeypatch):
    """Several workers, averaged in a tree of several levels."""
    monkeypatch.setattr(lm, "WORKER_SEGMENTS", 40)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    docs = odd_documents(spark)
    known = lm.vocabulary(lm.token_counts(docs))
    weights = [lm.fit(d, known) for d in (docs.repartition(2), docs.repartition(7).orderBy(F.desc("text")))]
    assert weights[0] == weights[1] != gru.packed(gru.fresh(known.log_share))



def test_every_segment_of_the_training_texts_is_learned_from(spark, monkeypatch):
    docs = plain_table(spark).filter(lm.training())
    known = lm.vocabulary(lm.token_counts(docs))
    tokens = sum(len(spaced(r["text"])) + 1 for r in docs.collect())
    learned, train = [], lm._trained
    segments = lm._segments(docs, known)
    assert segments.agg(F.sum(F.octet_length("tokens")) / 2).first()[0] == tokens

    def counted(*args):
        learned.append(train(*args))
        return learned[-1]

    monkeypatch.setattr(lm, "_trained", counted)
    lm.fit(docs, known)
    assert learned[-1].agg(F.sum("n")).first()[0] == tokens


def test_learning_beats_the_shares_of_words():
    rng = np.random.default_rng(7)
    texts = [np.tile(rng.permutation(np.arange(2, 12)), 8).astype(np.int16) for _ in range(3)] * 40
    share = np.full(gru.WORDS, 1e-9)
    share[2:12] = 0.1
    model = gru.fresh(np.log(share))
    trainer = gru.Trainer(model)
    for _ in range(5):
        trainer.learn(texts)
    assert gru.score(trainer.model, texts).sum() > 0.6 * gru.score(model, texts).sum()


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from rebasket.llm import toxicity

    docs = plain_table(spark)
    labels = spark.createDataFrame([(k, int(k == 8)) for k in range(1, 60)], "doc_id long, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([(1, "copy of one text copy of one text copy of one")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    stages = dict(corpus_pipeline.STAGES)
    one = stages["toxicity"](spark, docs, str(tmp_path))
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    bad = toxicity.score_toxicity(docs, model).filter("predicted = 1").count()
    assert one.columns == docs.columns and one.count() == docs.count() - bad
    two = stages["near_duplicates"](spark, docs, str(tmp_path))
    ids = Counter(r["doc_id"] for r in two.collect())
    assert ids[2] == 0 and ids[20] == 1 and ids[15] == 1
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == [*docs.columns, "shard", "slot"]
    texts = [r["text"] for r in result.collect()]
    assert texts and not any("copy of one text copy of one" in t for t in texts)
    assert result.filter("shard < 0 or shard > 15").count() == 0
