"""Learned operators: exact parts against brute force, learned parts by held-out accuracy."""

import itertools
import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from abstractmill.llm import langid, lm_score, quality

SF = "/root/testdata/sf0.01"


def checksum(modulus):
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def test_base_scores_and_counts(odd):
    docs, ids, texts = odd
    rows = lm_score.document_scores(docs, checksum(10) == 0, buckets=5).collect()
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d in ids]
    tokens = [[*brute.words(t, lower=True), 0] for t in texts]
    count = Counter(w for t, h, d in zip(tokens, held, ids, strict=True) if not h and d is not None for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted(
        (-1 if d is None else d, len(t), sum(count[w] > 0 for w in t), sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        for d, t in zip(ids, tokens, strict=True)
    )
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert {r["train_tokens"] for r in rows} == {n}
    assert all(np.isfinite(r["score"]) for r in rows)


def test_model_beats_counts_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [r for r in lm_score.document_scores(docs, checksum(10) == 0).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_network_learns_from_every_training_document(spark):
    cycle = [f"word{i}" for i in range(40)]
    rows = [(i, " ".join((cycle * 12)[i % 40 : i % 40 + 400])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    # Without a sample for the start, the order of the words can be learned in the rounds over all blocks only.
    held = [r for r in lm_score.document_scores(docs, checksum(10) == 0, fit_docs=0).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_rounds_train_on_all_symbols_once(spark, monkeypatch):
    trained = []
    train = lm_score._train
    monkeypatch.setattr(lm_score, "_train", lambda *x: trained.append(train(*x)))
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 2000)
    docs = spark.createDataFrame([(i if i % 7 else None, brute.prose(i, 1 + i)) for i in range(120)], "doc_id long, text string")
    rows = lm_score.document_scores(docs.repartition(3), checksum(10) == 0, fit_docs=5).collect()
    learned = [r for r in rows if r["doc_id"] is not None and not r["held_out"]]
    assert trained == [sum(r["n_tokens"] for r in learned)] == [rows[0]["train_tokens"]]


def test_lm_without_rows_or_training(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.document_scores(docs, checksum(10) == 0).count() == 0
    one = spark.createDataFrame([(3, "some words")], "doc_id long, text string")
    row = lm_score.document_scores(one, F.lit(True)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


@pytest.fixture(scope="module")
def small_gru():
    vocabulary = lm_score.Vocabulary(50, {t: (40, 9) for t in range(lm_score.TAIL)}, [(i * 7919, 100 - i, i % 64) for i in range(90)])
    return lm_score.GatedUnit(vocabulary)


def test_state_is_carried_across_windows(small_gru):
    rng = np.random.default_rng(1)
    size = lm_score.SHORT + lm_score.TAIL
    docs = [np.append(rng.integers(1, size, n), 0) for n in (0, 1, 5, 300, 64, 63)]
    got = small_gru.score(np.concatenate(docs), np.concatenate([[0], np.cumsum([len(d) for d in docs])]))
    for d, g in zip(docs, got, strict=True):
        h, total, before = np.zeros((1, lm_score.STATE), np.float32), 0.0, 0
        for x in d:
            h = small_gru.step(small_gru.inputs[[before]], h)
            total += small_gru.outputs(h, np.array([x]))[0]
            before = x
        assert math.isclose(total, g, rel_tol=1e-4)


def test_class_factored_probabilities_sum_to_one(small_gru):
    h = np.random.default_rng(2).standard_normal((1, lm_score.STATE)).astype(np.float32)
    every = np.arange(lm_score.SHORT + lm_score.TAIL)
    assert abs(np.exp(small_gru.outputs(np.repeat(h, len(every), 0), every)).sum() - 1) < 1e-3


def test_gradients_of_the_truncated_window(small_gru):
    rng = np.random.default_rng(3)
    source, target = (rng.integers(0, lm_score.SHORT + lm_score.TAIL, (6, 3)) for _ in range(2))
    target[:] = np.where(target < 90, target, lm_score.SHORT + target % lm_score.TAIL)

    def loss():
        h, total = np.zeros((3, lm_score.STATE), np.float32), 0.0
        for x, y in zip(source, target, strict=True):
            h = small_gru.step(small_gru.inputs[x], h * (x != 0)[:, None])
            total -= small_gru.outputs(h, y).astype(float).sum()
        return total / target.size

    slopes, _ = small_gru._slopes(source, target, np.zeros((3, lm_score.STATE), np.float32))
    for p, g in zip(small_gru.params(), slopes, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = p[at], 1e-2
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert math.isclose((up - down) / (2 * step), g[at], rel_tol=0.05, abs_tol=1e-4)


def test_chain_marginals(monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", 3)
    rng = np.random.default_rng(0)
    emit, move, rows = rng.random((17, 3)) + 0.1, rng.random((3, 3)) + 0.1, np.array([0, 0, 1, 8, 17])
    moves, expected = np.zeros((3, 3)), np.zeros((3, 3))
    got = langid.chain_marginals(emit, move, rows, moves)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        total, pairs = np.zeros((b - a, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=int(b - a)):
            if not y:
                continue
            p = move.sum(axis=0)[y[0]] * emit[a, y[0]]
            for t in range(1, b - a):
                p *= move[y[t - 1], y[t]] * emit[a + t, y[t]]
            for t in range(b - a):
                total[t, y[t]] += p
                pairs[y[t - 1], y[t]] += p if t else 0
        if b > a:
            assert np.allclose(total / total.sum(axis=1, keepdims=True), got[a:b])
            expected += pairs / total[0].sum()
    assert np.allclose(moves, expected)


def test_transition_gradient_by_finite_differences(monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", 4)
    rng = np.random.default_rng(6)
    emit, weights, rows = rng.random((30, 3)) + 0.1, rng.standard_normal((3, 3)), np.array([0, 1, 14, 30])

    def log_partition(w):
        total = 0.0
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            x = np.exp(w).sum(axis=0) * emit[a]
            for t in range(a + 1, b):
                x = (x @ np.exp(w)) * emit[t]
            total += math.log(x.sum())
        return total

    moves = np.zeros((3, 3))
    first = langid.chain_marginals(emit, np.exp(weights), rows, moves)[rows[:-1]]
    for i, j in itertools.product(range(3), repeat=2):
        d = np.zeros((3, 3))
        d[i, j] = 1e-5
        slope = (log_partition(weights + d) - log_partition(weights - d)) / 2e-5
        # Before the first word stands any label, which adds a transition into it.
        start = (first[:, j] * np.exp(weights[i, j]) / np.exp(weights[:, j]).sum()).sum()
        assert math.isclose(slope, moves[i, j] + start, rel_tol=1e-6)


@pytest.fixture(scope="module")
def crf(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, langid.fit(docs, checksum(4) != 2)


def test_language_accuracy(crf):
    docs, model = crf
    got = langid.languages(docs, model, checksum(4) == 2).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_code_switched_words(crf):
    docs, model = crf
    by = {r["lang"]: r["text"].split()[:30] for r in docs.filter("length(text) > 1000").select("lang", "text").collect()}
    mixed = by["en"] + by["de"] + by["en"]
    words = langid.Words(pa.array([" ".join(mixed)]), lower=True)
    number, distinct = langid._distinct(words)
    weights = model.word_weights(distinct)
    seen = langid.chain_marginals(np.exp(weights)[number], np.exp(model.moves), words.rows)
    label = [model.languages[i] for i in seen.argmax(axis=1)]
    assert sum(x == "de" for x in label[32:58]) >= 20 and sum(x == "en" for x in label[:28] + label[62:]) >= 45


def test_language_of_odd_texts(odd, crf):
    docs, ids, texts = odd
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.languages(docs, crf[1], checksum(4) == 2).collect()}
    for i, text in enumerate(texts):
        if text is None or not any(c.isalpha() for c in text):
            assert (ids[i], "und") in got
    learned = langid.fit(docs.filter("lang is null"), F.lit(True))
    assert {r["lang_pred"] for r in langid.languages(docs, learned, F.lit(False)).collect()} == {"und"}
    assert langid.languages(docs.limit(0), crf[1], F.lit(False)).count() == 0


def test_features_by_hand():
    names = quality.FEATURES
    rows = quality.features(pa.array(["Ab cd cd\nAb cd cd\nx!! 12", None, ""]))
    got = dict(zip(names, rows[0], strict=True))
    assert not rows[1:].any()
    assert math.isclose(got["log words"], math.log(9)) and math.isclose(got["mean word bytes"], 17 / 8)
    assert math.isclose(got["upper share"], 2 / 17) and math.isclose(got["same word twice running"], 2 / 8)
    assert math.isclose(got["words ending in a symbol"], 1 / 8) and math.isclose(got["words without letters"], 1 / 8)
    assert math.isclose(got["repeated words"], 4 / 8) and math.isclose(got["share of the commonest word"], 4 / 8)
    assert math.isclose(got["lines per word"], 3 / 8) and math.isclose(got["repeated lines"], 1 / 3)


def test_quality_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels, checksum(4) != 2)
    got = quality.scores(docs, model, checksum(4) == 2).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.95 * len(got)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()


def test_quality_fit_and_quantile_against_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    twice = labels.union(labels.filter("doc_id % 7 = 0"))
    model = quality.fit(docs, twice, checksum(4) != 2, fit_rows=60, fit_pairs=500)
    rows = docs.join(twice.filter(checksum(4) != 2), "doc_id").select("text", "quality").collect()
    x = quality.features(pa.array([r["text"] for r in rows], pa.large_string()))
    u = np.sort(model.utilities(x))
    share = sum(r["quality"] for r in rows) / len(rows)
    assert math.isclose(model.share, share) and len(rows) > 60
    # The threshold is the utility below which the share of label 0 lies, of all rows and not of the sample.
    assert abs(np.searchsorted(u, model.threshold) - (1 - share) * len(u)) <= 1.5
    # The weights are where the likelihood of the pairs has no slope.
    rng = np.random.default_rng(0)
    x, label = rng.standard_normal((80, 4)), rng.integers(0, 2, 80)
    fitted = quality.PairModel(x, label, 0.7, 300)
    z, draw = (x - x.mean(axis=0)) / x.std(axis=0), np.random.default_rng(7)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    d = z[draw.choice(good, 300)] - z[draw.choice(bad, 300)]

    def loss(w):
        return np.log1p(np.exp(-(d @ w))).sum() + 0.5 * (w @ w)

    for j in range(4):
        step = np.eye(4)[j] * 1e-4
        assert abs(loss(fitted.weights + step) - loss(fitted.weights - step)) / 2e-4 < 1e-2
        assert loss(fitted.weights + 100 * step) > loss(fitted.weights) < loss(fitted.weights - 100 * step)


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    rows = [(1, f"text {i} of one id", "en") for i in range(50)] + [(1, "the same text", "en")] * 50 + [(2, "ein anderer Text", "de")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    seen = []
    monkeypatch.setattr(langid.Crf, "learn", lambda self, texts, languages: seen.append(Counter(languages)))
    langid.fit(docs, F.lit(True), fit_rows=8)
    assert seen[0]["en"] <= 8 and seen[0]["de"] == 1
    sample = lm_score._sample(docs.withColumn("train", F.lit(True)), 10, lm_score.Vocabulary(1, {}, []))
    assert 1 <= len(sample) <= 10
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    sizes = []
    init = quality.PairModel.__init__
    monkeypatch.setattr(quality.PairModel, "__init__", lambda self, x, *a, **k: (sizes.append(len(x)), init(self, x, *a, **k))[1])
    quality.fit(docs, labels, F.lit(True), fit_rows=5)
    assert sizes[0] <= 5


def test_quality_of_odd_texts(odd, spark):
    docs, ids, texts = odd
    labels = spark.createDataFrame([(9, 1, "x"), (20, 0, "y"), (20, 0, "y"), (99, 1, "z"), (None, 1, "z"), (3, None, "z")], "doc_id long, quality int, text string")
    got = quality.scores(docs, quality.fit(docs, labels, F.lit(True)), F.lit(False)).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    none = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.scores(docs, none, F.lit(False)).collect()} == {0.5}
    assert quality.scores(docs.limit(0), none, F.lit(False)).count() == 0
