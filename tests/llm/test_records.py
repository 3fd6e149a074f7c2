"""Duplicates, percentiles, packing, leakage and reading level on small cases."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import duplicates, leakage, packing, queries, rankcompactors, reading

# duplicates -----------------------------------------------------------------------------------------------------------------


def test_blocks(spark):
    schema = "block_id long, page_id long, idx int, box array<int>, text string, class_label string, is_picture boolean, reading_order_index int, id string, raw string"
    rows = [
        (1, 1, 0, [1, 2], "Old  Rope.", "Text", False, 0),
        (5, 1, 0, [1, 2], "old rope", "Text", False, 0),
        (5, 1, 0, [1, 2], "old rope", "Text", False, 0),  # delivered twice
        (2, 1, 0, [1, 2], "(OLD)\nrope!", "Text", False, 0),
        (3, 1, 0, [1, 2], "old röpe", "Text", False, 0),
        (4, 1, 0, None, "old rope", "Text", False, 0),
        (6, 1, 0, None, None, "Text", False, 0),
        (7, 1, 0, None, "", "Text", False, 0),
        (8, 1, 0, None, " .", "Text", False, 0),
        (9, None, None, None, None, None, None, None),
        (10, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    out = {tuple(r)[1:] for r in duplicates.collapse(duplicates.block_records(df)).collect()}
    assert out == {(1, 2), (1, 5), (7, 8), (9, 10)}
    sizes = {r.kept_id: r.n_copies for r in duplicates.copies(duplicates.block_records(df)).collect()}
    assert sizes == {1: 3, 3: 1, 4: 1, 6: 1, 7: 2, 9: 2}
    assert duplicates.collapse(duplicates.block_records(df.limit(0))).count() == 0


def test_json(spark):
    one = {"a": [1, 2.0], "b": {"t": "Old Rope.", "n": None}}
    texts = [json.dumps(one), json.dumps({"b": {"n": None, "t": "old rope"}, "a": [1, 2]}, indent=3), json.dumps({"a": [2, 1], "b": one["b"]}), json.dumps({"a": [1, 2], "b": {"t": "old rope"}}), "{bad", "{bad", None]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts, 1)], "rec_id long, payload string, pairs string")
    assert [tuple(r) for r in duplicates.collapse(duplicates.json_records(df)).collect()] == [("record", 1, 2)]


def test_copies_of_all_kinds(spark, tmp_path):
    spark.createDataFrame([(k, 1, 0, [1, 2], "Old Rope", "Text", False, 0) for k in (3, 4)], "block_id long, page_id long, idx int, box array<int>, text string, class_label string, is_picture boolean, reading_order_index int").write.parquet(f"{tmp_path}/blocks.parquet")
    notes = "ann_id long, page_id long, image string, block_boxes array<array<int>>, block_classes array<string>, block_text array<string>, reading_order array<int>, block_relations array<struct<source:int,target:int,relation:string>>, annotation_quality string, lang string"
    spark.createDataFrame([(k, 1, "i", None, ["Text"], [t], [0], None, None, "en") for k, t in ((5, "Old Rope"), (6, "old  rope."), (7, "new"))], notes).write.parquet(f"{tmp_path}/page_annotations.parquet")
    spark.createDataFrame([(8, '{"a": 1, "b": "x"}'), (9, '{"b": "X.", "a": 1}'), (9, '{"b": "X.", "a": 1}'), (10, "{bad")], "rec_id long, payload string").write.parquet(f"{tmp_path}/annotation_records.parquet")
    out = [tuple(r) for r in queries.QUERIES["p7_copies"](spark, str(tmp_path)).collect()]
    assert sorted(out) == [("block", 3, 2), ("page", 5, 2), ("page", 7, 1), ("record", 8, 2)]


def test_a_hot_group(spark):
    df = spark.range(6000).selectExpr("'b' as src", "id", "array(named_struct('field','t','value',if(id % 3 = 0, 'same', cast(id as string)),'fold',true)) as pairs")
    out = duplicates.collapse(df)
    assert out.count() == 1999 and out.where("kept_id <> 0").count() == 0


# percentiles ----------------------------------------------------------------------------------------------------------------


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 40_000), st.integers(1, 9), st.sampled_from(["even", "heavy", "ties", "falling"]), st.integers(0, 99))
def test_rank_error_of_merged_sketches(n, parts, shape, seed):
    rng = np.random.default_rng(seed)
    values = {"even": rng.random(n), "heavy": rng.lognormal(3, 2, n), "ties": np.rint(rng.normal(50, 3, n)), "falling": np.arange(n)[::-1].astype(float)}[shape]
    total = rankcompactors.Sketch()
    for chunk in np.array_split(values, parts):
        s = rankcompactors.Sketch()
        s.add(chunk)
        total.merge(s.n, s.levels, s.states)
    assert total.n == n and sum(len(v) << h for h, v in enumerate(total.levels)) == n
    ordered = np.sort(values)
    for q, found in zip(rankcompactors.PERCENTILES, total.percentiles()):
        low, high = np.searchsorted(ordered, found, "left") / n, np.searchsorted(ordered, found, "right") / n
        off = 0 if low <= q <= high else min(abs(low - q), abs(high - q))
        assert off <= rankcompactors.error_bound(q) + 1.5 / n


def test_groups(spark):
    rng = random.Random(5)
    rows = [("a", None, float(rng.randint(0, 50))) for _ in range(5000)] + [(None, "f", 1.0), (None, "f", None), ("b", "f", float("nan")), ("c", "f", -2.0), ("c", "f", 4.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "provider string, file string, v double, n string").repartition(5)
    keys = ["provider", "file"]
    parts = rankcompactors.sketches(df, keys, "v")
    out = {(r.provider, r.file): r for r in rankcompactors.merge(parts, keys).collect()}
    assert {k: r.n for k, r in out.items()} == {("a", None): 5000, (None, "f"): 1, ("c", "f"): 2}
    exact = np.sort([r[2] for r in rows if r[0] == "a"])
    assert abs(out["a", None].p50 - exact[2500]) <= 1 and out["c", "f"].p50 == -2.0 and out["c", "f"].p99 == 4.0
    assert rankcompactors.merge(rankcompactors.merge(parts, keys), ["file"]).where("file is null").first().n == 5000
    assert rankcompactors.merge(rankcompactors.sketches(df.limit(0), keys, "v"), keys).count() == 0


def test_a_key_with_all_sketches_is_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(rankcompactors, "FAN_IN", 4)
    df = spark.range(6000).selectExpr("id % 60 as d", "'hot' as g", "if(id = 7, double('infinity'), double(id)) as v").repartition(6)
    daily = rankcompactors.merge(rankcompactors.sketches(df, ["g", "d"], "v"), ["g", "d"])
    out = rankcompactors.merge(daily, ["g"]).collect()
    assert [(r.g, r.n) for r in out] == [("hot", 6000)]
    assert abs(out[0].p50 - 3000) <= 6000 * rankcompactors.error_bound(0.5) + 2


def test_infinite_values_and_repeated_runs():
    values = np.concatenate([np.full(3000, -np.inf), np.arange(3000.0), np.full(3000, np.inf)])
    sketches = []
    for _ in range(2):
        s = rankcompactors.Sketch()
        s.add(np.random.default_rng(1).permutation(values))
        sketches.append(s)
    assert all(np.array_equal(a, b) for a, b in zip(*(s.levels for s in sketches)))
    assert sketches[0].percentiles()[1:] == [np.inf] * 3 and abs(sketches[0].percentiles()[0] - 1500) < 9000 * rankcompactors.error_bound(0.5) + 2


# packing --------------------------------------------------------------------------------------------------------------------


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=120))
def test_packing_keeps_every_item(sizes):
    sizes = np.array(sizes)
    container, place, capacity = packing.best_packing(sizes, (30, 60, 100), 2)
    used = np.bincount(container, weights=sizes, minlength=len(capacity))
    assert (used <= capacity).all() and len({*zip(container, place)}) == len(sizes)
    smaller = {30: 0, 60: 30, 100: 60}
    assert all(u > smaller[c] for u, c in zip(used, capacity))
    assert len(capacity) <= 2 * -(-sizes.sum() // 100) + 1


def test_token_counts_equal_the_tokenizer():
    count, encode = packing.counter(), packing._encoder(packing.VOCABULARY).encode_ordinary
    for text in ("", " a", "Two  spaces\n\n and\ttabs it's 12,5", "नमस्ते दुनिया । क्‍ष", "x   y\x1c z", "a b a b"):
        assert count(text) == len(encode(text))


def test_documents(spark):
    texts = ["word " * 10, None, "", "word " * 5000, "short"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    out = packing.pack(packing.token_counts(df)).collect()
    assert {r.doc_id for r in out if r.container is None} == {1, 2}
    pieces = sorted((r.start_token, r.n_tokens) for r in out if r.doc_id == 3)
    assert pieces[0] == (0, 2048) and sum(n for _, n in pieces) == next(r.n_tokens for r in packing.token_counts(df).collect() if r.id == 3)
    for c in {r.container for r in out if r.container is not None}:
        mine = [r for r in out if r.container == c]
        assert sum(r.n_tokens for r in mine) + mine[0].unused == mine[0].capacity
    assert packing.pack(packing.token_counts(df.limit(0))).count() == 0


# leakage --------------------------------------------------------------------------------------------------------------------

rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(160)]


def sentence(n, r):
    return [r.choice(VOCABULARY) for _ in range(n)]


def test_leaks(spark):
    r = random.Random(9)
    passages = [sentence(50, r) for _ in range(12)]
    items = spark.createDataFrame([(k, "s", " ".join(p), " ".join(p[:2]) if k else None, "x") for k, p in enumerate(passages)] + [(99, "s", None, None, "x")], "item_id long, suite string, passage string, answer string, cosine string")
    quote = passages[3][10:30]
    wrong = list(quote)
    wrong[4], wrong[11] = wrong[4][:-1] + "x", wrong[11] + "q"
    other = list(quote)
    other[5] = "completelyother"
    broken = " ".join(quote[:6]) + " " + quote[6][:2] + "-\n" + quote[6][2:] + ", " + " ".join(quote[7:]).upper() + "!"
    docs = {
        1: sentence(200, r),
        2: sentence(70, r) + quote + sentence(70, r),
        3: sentence(5, r) + wrong[:13] + sentence(90, r),
        4: sentence(40, r) + quote[:11] + ["zzzz"] + sentence(60, r),  # a shorter quotation
        5: sentence(40, r) + other[:12] + sentence(60, r),  # another word, not a misread one
        6: sentence(30, r) + r.sample(quote, len(quote)) + sentence(30, r),
        7: quote[:12],
    }
    rows = [(k, " ".join(d), "x") for k, d in docs.items()] + [(8, broken, "x"), (9, None, "x"), (10, "", "x"), (8, broken, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string")
    assert {tuple(x) for x in leakage.leaked(df, items).collect()} == {(d, 3) for d in (2, 3, 7, 8)}
    report = {x.item_id: x.n_documents for x in leakage.reports(df, items).collect()}
    assert report[3] == 4 and report[99] == 0
    assert leakage.leaked(df.limit(0), items).count() == 0 and leakage.leaked(df, items.limit(0)).count() == 0


def test_leaks_across_breaks_after_marks(spark):
    passage = "পুরানো নিবন্ধীকরণ দপ্তরের সাংস্কৃতিক শাখা নদীর ধারে একটি বড় বাজার ও বিদ্যালয় দেখেছিল गाँव की किताब".split()
    quote = " ".join(passage[1:13])
    broken = quote.replace("নিবন্ধীকরণ", "নি-\nবন্ধীকরণ").replace("সাংস্কৃতিক", "সাং-\n  স্কৃতিক").replace("দপ্তরের", "দপ্\u200d-\nতরের")
    items = spark.createDataFrame([(1, "s", " ".join(passage), None)], "item_id long, suite string, passage string, answer string")
    df = spark.createDataFrame([(1, quote), (2, broken), (3, broken.replace("-\n", " "))], "doc_id long, text string")
    assert {tuple(x) for x in leakage.leaked(df, items).collect()} == {(1, 1), (2, 1)}
    assert leakage.words("कि-\nताब क्-\nषेत्र") == ["किताब", "क्षेत्र"] and leakage.words("12-\nबाज़ार —-\nend") == ["12", "बाज़ार".replace("ज़", "ज़"), "end"]


def test_paraphrases_as_long_as_the_passage(spark):
    r = random.Random(11)
    long, middle = sentence(80, r), sentence(50, r)
    items = spark.createDataFrame([(k, "s", " ".join(p), p[0]) for k, p in ((1, long), (2, middle))], "item_id long, suite string, passage string, answer string")
    half = lambda p: " ".join(w if k % 4 < 2 else f"other{k}" for k, w in enumerate(p))
    less = " ".join(w if k % 4 < 2 and k < 60 else f"other{k}" for k, w in enumerate(long))
    before = " ".join(f"before{k}" for k in range(29))
    df = spark.createDataFrame([(1, f"{before} {half(long)}"), (2, f"{before} {half(middle)} {before}"), (3, less)], "doc_id long, text string")
    assert {x.item_id: (x.n_documents, x.n_paraphrases) for x in leakage.reports(df, items).collect()} == {1: (0, 1), 2: (0, 1)}
    assert leakage.leaked(df, items).count() == 0 and [leakage.least_pairs(k) for k in (12, 42, 80)] == [2, 10, 19]


def test_low_ranks_keep_leaks_and_planted_paraphrases(spark):
    r = random.Random(21)
    passages = [sentence(40, r) for _ in range(30)]
    items = spark.createDataFrame([(k, "s", " ".join(p), p[0]) for k, p in enumerate(passages)], "item_id long, suite string, passage string, answer string")
    rows = [(k, " ".join(sentence(60, r) + p[5:17] + sentence(60, r))) for k, p in enumerate(passages)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for share, kept in ((0.8, 0.8), (0.3, 0.8), (0.3, 0.0)):
        found = leakage.leaks(df, items, rank_share=share, kept=kept).where("run").select("doc_id", "item_id").collect()
        assert {(k, k) for k in range(30)} <= {tuple(x) for x in found}
    planted = []
    for k, p in enumerate(passages):
        words = list(p)
        for i in r.sample(range(1, 40), 14):
            words[i] = r.choice(VOCABULARY)
        planted.append((k, " ".join(sentence(50, r) + words)))
    found = leakage.leaks(spark.createDataFrame(planted, "doc_id long, text string"), items, reworded=True).where("run or common >= 0.5 and answer")
    assert len({x.doc_id for x in found.where("doc_id = item_id").collect()}) >= 27


def test_latent_space_is_an_svd(spark):
    matrix = np.random.default_rng(1).random((6, 15)) * (np.random.default_rng(2).random((6, 15)) > 0.5)
    rows = [(j, [int(i) for i in np.flatnonzero(matrix[:, j])], [float(x) for x in matrix[:, j][matrix[:, j] != 0]]) for j in range(15)]
    postings = spark.createDataFrame([r for r in rows if r[1]], "pair int, items array<int>, weights array<double>")
    u, s, vectors = leakage.latent_space(postings, 6)
    v = np.zeros((15, len(s)))
    for x in vectors.collect():
        v[x.pair] = x.v
    assert np.allclose(s, np.linalg.svd(matrix)[1][: len(s)]) and np.allclose(u * s @ v.T, matrix, atol=1e-4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_length(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    assert leakage.common_length(np.array(a, int), np.array(b, int)) == t[-1, -1]


# reading level --------------------------------------------------------------------------------------------------------------

EASY, HARD = ["ox", "rope", "clay", "hill", "milk", "red", "sat", "by"], ["administration", "jurisdictional", "documentation", "chronological", "irrigation"]


def graded_text(band, r, words=60):
    out, size, share = [], {1: 6, 2: 12, 3: 25}[band], {1: 0.05, 2: 0.35, 3: 0.7}[band]
    while len(out) < words:
        s = [r.choice(HARD) if r.random() < share else r.choice(EASY) for _ in range(size)]
        s[-1] += "."
        out += s
    return " ".join(out)


def test_bands(spark):
    r = random.Random(4)
    docs = [(k, graded_text(k % 3 + 1, r), ["en", None, "en-IN"][k % 2], "x") for k in range(240)] + [(900, "short text.", "en", "x"), (901, None, None, "x"), (902, "12 " * 40, "en", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, features string")
    labels = spark.createDataFrame([(k, k % 3 + 1, "d") for k in range(0, 90)] + [(5000, 2, "d"), (0, 1, "e"), (3, None, "e")], "doc_id long, band int, labelled_by string")
    out = {x.doc_id: x.band for x in reading.reading_bands(df, labels).collect()}
    assert set(out) == set(range(240))
    held_out = [out[k] == k % 3 + 1 for k in range(90, 240)]
    assert np.mean(held_out) > 0.95
    assert reading.reading_bands(df, labels.limit(0)).count() == 0 and reading.reading_bands(df.limit(0), labels).count() == 0


def test_isotonic():
    at, level = reading.isotonic(np.array([3.0, 1.0, 2.0, 4.0]), np.array([2, 1, 3, 3]))
    assert at.tolist() == [1, 2, 3, 4] and level == pytest.approx([1, 2.5, 2.5, 3])
