"""Operators on document texts against brute force on odd texts and real tables."""

import os
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from abstractmill.llm import containment, jaccard, packing, rlz, token_count
from abstractmill.llm.bpe import merges
from abstractmill.llm.components import components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_substring_dedup(odd):
    docs, ids, texts = odd
    got = rlz.remove_repeats(docs, buckets=5).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256), "lang", "score", "block"
    )
    want = Counter((d, *x) for d, x in zip(ids, brute.cut_repeats(texts), strict=True))
    rows = got.collect()
    assert Counter(tuple(r[:4]) for r in rows) == want
    assert {r["score"] for r in rows} == {-1.0} and {r["block"] for r in rows} == {"b"}


def test_substring_dedup_keeps_layout_of_clean_texts(odd):
    docs, _, texts = odd
    rows = rlz.remove_repeats(docs, keep_layout=True).collect()
    clean = Counter(t for t, (_, removed, _) in zip(texts, brute.cut_repeats(texts), strict=True) if not removed)
    assert Counter(r["text"] for r in rows if not r["n_removed"]) == clean


def test_factors_cover_what_is_removed(odd):
    docs, _, texts = odd
    spans = defaultdict(set)
    for r in rlz.repeated_spans(docs.filter("doc_id <> 7")).collect():
        assert r["n_words"] >= 35
        spans[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    kept = [(i, t) for i, t in enumerate(texts) if i not in (4, 7, 8)]
    for (i, _), (_, removed, _) in zip(kept, brute.cut_repeats([t for _, t in kept]), strict=True):
        assert len(spans[i]) == removed


def test_windows_at_factor_boundaries(spark):
    a, b = brute.prose(21, 50), brute.prose(22, 50)
    # The last text holds a's end and b's start; the windows across that seam come once more elsewhere.
    texts = [a, b, a + " " + b, "x " + " ".join((a + " " + b).split()[30:70])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rlz.remove_repeats(docs).orderBy("doc_id").select("n_words", "n_removed").collect()
    assert [tuple(r) for r in got] == [x[:2] for x in brute.cut_repeats(texts)]


def test_hot_window_is_sent_once_a_block(spark):
    cycle = "one two three " * 4000
    texts = [cycle, "x " + cycle + "y", brute.prose(60, 50), " ".join(["z"] * 36), " ".join(["z"] * 34)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    words = rlz.Words(batch.column("text"), lower=False)
    h, _, group = rlz._windows(words, 35, 7)
    held, bounds, entry, twice = rlz._distinct(h, group, 7)
    assert len(held) < 70 and len(entry) == len(h) and bounds[-1] == len(held)
    assert (held[entry] == h & np.uint64((1 << 56) - 1)).all() and twice.sum() >= 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = rlz.remove_repeats(docs, buckets=3).orderBy("doc_id").select("n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256)).collect()
    assert [tuple(r) for r in got] == brute.cut_repeats(texts)


def test_jaccard_components(odd, spark):
    docs, ids, texts = odd
    base, small = brute.prose(31, 60), brute.prose(32, 12)
    more = [brute.edited(base, s, s % 5) for s in range(40)] + [brute.edited(small, s, 1) for s in range(5)]
    more += [small, small + " tail", "start " + small, small + " tail end"] + [brute.prose(33, n) for n in range(5, 30)]
    texts, ids = texts + more, ids + list(range(100, 100 + len(more)))
    extra = spark.createDataFrame(list(zip(ids[-len(more) :], more, strict=True)), "doc_id long, text string")
    got = jaccard.shingle_components(docs.select("doc_id", "text").union(extra), buckets=7).collect()
    place, sizes = brute.components(texts)
    least = defaultdict(list)
    for i, p in enumerate(place):
        least[p].append(ids[i])
    want = Counter((ids[i], sizes[i], min((x for x in least[p] if x is not None), default=None)) for i, p in enumerate(place))
    # A row without words is its own component, also one with a null id.
    assert Counter(tuple(r) for r in got) == want


def test_light_sets_alone_give_the_same(spark, monkeypatch):
    texts = [brute.prose(s, n) for s in range(3) for n in range(5, 28)]
    texts += [brute.edited(t, 1, 1) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute.components(texts)[0]
    for boundary in (0, 9, 14):
        monkeypatch.setattr(jaccard, "light_boundary", lambda by_size, x=boundary: x)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.shingle_components(docs, buckets=3).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_one_per_component_keeps_columns(odd):
    docs, ids, texts = odd
    got = jaccard.one_per_component(docs)
    assert got.columns == docs.columns
    assert {1, 2, 3, 9} <= {r["doc_id"] for r in got.collect()} and 10 not in {r["doc_id"] for r in got.collect()}


def test_one_per_component_of_repeated_and_null_ids(spark):
    a, b, c, d, e = (brute.prose(70 + i, 80) for i in range(5))
    rows = [(5, a), (5, a), (5, a), (None, b), (None, b), (1, c), (2, c), (2, d), (None, e), (9, e), (None, None), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    want = Counter([(5, a), (None, b), (1, c), (2, d), (9, e), (None, None), (None, None), (3, ""), (3, "")])
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want
    # What stays is no other row's copy, so the next stage cuts nothing out of it.
    assert {r["n_removed"] for r in rlz.remove_repeats(kept, window=35).collect()} == {0}


def test_columns_named_like_added_ones_stay(spark):
    a, b = brute.prose(70, 80), brute.prose(71, 80)
    rows = [(5, a, 77, 1, "x"), (6, a, 88, 2, "y"), (7, b, 99, 3, "z"), (7, b, 99, 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, same int, row string").repartition(2)
    kept = jaccard.one_per_component(docs)
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]] and kept.columns == docs.columns
    items = spark.createDataFrame([(1, b)], "item_id long, text string")
    for most in (0, 1 << 20):
        left = containment.without_items(docs, items, broadcast_bytes=most)
        assert sorted(map(tuple, left.collect())) == rows[:2] and left.columns == docs.columns


def test_very_many_tiny_items_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(containment, "ITEMS", 50)
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(0, 400, 7)], "doc_id long, text string")
    items = spark.range(300).select(F.col("id").alias("item_id"), F.concat(F.lit("word"), "id").alias("text"))
    assert containment._index(spark, items, "item_id", "text", 0.8, 1 << 24) is None
    blank = items.withColumn("text", F.lit(" "))  # items without words are no items
    assert containment._index(spark, blank, "item_id", "text", 0.8, 1 << 24) is not None
    found = {(r["doc_id"], r["item_id"]) for r in containment.contained_items(docs, items).collect()}
    assert found == {(i, i) for i in range(0, 300, 7)}


def test_linked_sets_leave_no_large_table(spark, odd):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    jaccard.one_per_component(odd[0]).count()
    assert {x.split("-")[1] for x in set(os.listdir(folder)) - before} <= {"judged"}


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {200 + i: 100 for i in range(30)}


def test_contained_items(odd, spark):
    docs, ids, texts = odd
    passage = brute.prose(2, 60)
    items = [(1, passage), (2, passage + " and more"), (3, brute.prose(99, 20)), (4, None), (5, ""), (6, "ONE two"), (1, passage)]
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = Counter()
    for d, t in zip(ids, texts, strict=True):
        for i, item in items:
            a, b = brute.shingles(item), brute.shingles(t)
            if a and 5 * len(a & b) >= 4 * len(a):
                want[(d, i, len(a), len(a & b))] += 1
    for most in (1 << 20, 0):  # broadcast, then joined
        got = containment.contained_items(docs, table, broadcast_bytes=most).collect()
        if most:
            assert Counter(tuple(r[:4]) for r in got) == want
        else:
            assert {tuple(r[:4]) for r in got} == set(want)
        kept = containment.without_items(docs, table, broadcast_bytes=most)
        assert kept.columns == docs.columns
        clean = [t for d, t in zip(ids, texts, strict=True) if not any(brute.shingles(i) and 5 * len(brute.shingles(i) & brute.shingles(t)) >= 4 * len(brute.shingles(i)) for _, i in items)]
        assert Counter(r["text"] for r in kept.collect()) == Counter(clean)


def test_token_counts(odd, tokenizer):
    docs, ids, texts = odd
    got = token_count.token_counts(docs, VOCABULARY).collect()
    n = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    want = Counter((d, len((t or "").encode()), k, k > 512) for d, t, k in zip(ids, texts, n, strict=True))
    assert Counter(tuple(r) for r in got) == want


def test_pre_tokens_as_the_library(tokenizer):
    rng = np.random.default_rng(5)
    parts = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "\t", "a", "re", "Ab", "é", "1", "23", "!", "<|endoftext|>", "<|end", "\xa0", "　", "\x1c", "\x85", "日本", "😀", "aaaa", "ing", "́", "²", "_"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)]
    number, rows, ids, at = merges(VOCABULARY).encode(pa.array(texts))
    for r, text in enumerate(texts):
        got = [t for k in number[rows[r] : rows[r + 1]] for t in ids[at[k] : at[k + 1]].tolist()]
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing(odd, tokenizer):
    docs, ids, texts = odd
    got = packing.pack(docs, VOCABULARY, capacity=256).collect()
    want = Counter()
    for d, t in zip(ids, texts, strict=True):
        tokens = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(tokens) % 256 or 256
        cuts = [0, *range(first, len(tokens) + 1, 256)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[(d, k, a, b - a, zlib.crc32(np.array(tokens[a:b], "<u4").tobytes()))] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 256) + 1


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_on_histograms(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5, 1 + seed / 4, 3000).astype(int) + 1, 1, 512)
    if seed == 3:
        lengths[:1000] = 200  # a third of one length
    histogram = np.bincount(lengths, minlength=513)
    runs = packing.plan_runs(histogram, 512)
    fill = Counter()
    for length, a, b, sequence, offset in runs.tolist():
        for k in range(b - a):
            fill[sequence + k] += length
    assert max(fill.values()) <= 512 and sum(fill.values()) == lengths.sum()
    rooms = Counter()  # best-fit decreasing, one piece after the other
    for n in sorted(lengths.tolist(), reverse=True):
        room = min((r for r in rooms if r >= n and rooms[r]), default=0)
        if room:
            rooms[room] -= 1
        rooms[(room or 512) - n] += 1
    assert len(fill) <= 1.005 * sum(n for room, n in rooms.items() if n > 0) + 1
    for length in np.unique(lengths):
        own = sorted((a, b) for n, a, b, _, _ in runs.tolist() if n == length)
        assert own[0][0] == 0 and own[-1][1] == histogram[length] and all(x[1] == y[0] for x, y in zip(own, own[1:]))


@pytest.mark.parametrize("empty", ["doc_id long, text string, n_chars long"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([], empty)
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (
        rlz.remove_repeats(docs), rlz.repeated_spans(docs), jaccard.shingle_components(docs), containment.contained_items(docs, items),
        containment.contained_items(docs.withColumn("doc_id", F.lit(1).cast("long")), items.limit(0)),
        containment.without_items(docs, items), token_count.token_counts(docs, VOCABULARY), packing.pack(docs, VOCABULARY),
    ):
        assert df.count() == 0
