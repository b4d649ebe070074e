"""Vector codes, filter audit and line dedup against brute force and on odd tables."""

import random
from collections import Counter
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abstractmill.llm import filter_audit, line_index, vector_codes
from abstractmill.llm.line_index import LineIndex
from abstractmill.llm.stored import discard, shared_folder, stored

VECTORS = "vec_id long, embedding array<float>, label int, row long, part string, code double"


def vectors(n, dim, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (7, dim))
    x = (centres[rng.integers(0, 7, n)] + rng.normal(0, 0.2, (n, dim))).astype(np.float32)
    return [[float(c) for c in v] for v in x]


@pytest.mark.parametrize("spread", [1.0, 3000.0])
def test_vector_codes(spark, spread):
    held = vectors(300, 8, spread=spread)
    held += [held[0]] * 60 + [held[3]]  # a hot vector, repeated rows
    ids = [3 * i - 50 for i in range(len(held))]
    ids[5], ids[9], ids[300] = ids[4], None, ids[0]
    labels = [None if i % 4 == 0 else i % 3 for i in range(len(held))]
    rows = [(i, v, c, 5, "x", 0.5) for i, v, c in zip(ids, held, labels, strict=True)]
    odd = [(1, None, 1, 5, "x", 0.5), (2, [1.0] * 7, 1, 5, "x", 0.5), (3, [float("nan")] * 8, 1, 5, "x", 0.5)]
    odd += [(4, [None] + [1.0] * 7, 1, 5, "x", 0.5), (5, [float("inf")] * 8, 1, 5, "x", 0.5)]
    df = spark.createDataFrame(rows + odd, VECTORS).repartition(3)
    codes, books = vector_codes.compressed(df, dim=8, parts=2, entries=20, rounds=3)
    want, want_books = brute.vector_codes(list(zip(ids, held, strict=True)), 2, 20, 3)
    assert [b.entries.tolist() for b in books] == want_books
    got = vector_codes.with_label_errors(codes).collect()
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in got) == Counter(want)
    by_label = codes.groupBy("label").agg(F.sum("error").alias("e")).collect()
    assert {r["label_error"] for r in got} == {r["e"] for r in by_label} and len(by_label) == 4


def test_vector_codes_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(9, [0.5, -0.25], 1, 0, "", 0.0), (2, [0.5, -0.25], None, 0, "", 0.0)], VECTORS)
    codes, books = vector_codes.compressed(few, dim=2, parts=2)
    assert vector_codes.codebook_text(books) == "512,512,-256,-256"
    assert sorted(tuple(r) for r in vector_codes.with_label_errors(codes).collect()) == [(2, "0000", 0, 0), (9, "0000", 0, 0)]
    codes, books = vector_codes.compressed(few.limit(0), dim=2, parts=2)
    assert vector_codes.with_label_errors(codes).count() == 0 and vector_codes.codebook_text(books) == ""
    with pytest.raises(Exception, match="too large"):
        vector_codes.compressed(spark.createDataFrame([(1, [1e30, 0.0], 1, 0, "", 0.0)], VECTORS), dim=2, parts=2)


def test_shortlists_keep_the_nearest_entry_and_ties():
    rng = np.random.default_rng(5)
    for size in (3, 400, 1 << 27):
        entries = rng.integers(-size, size, (40, 4))
        entries[7] = entries[31]
        book = vector_codes.Codebook(entries)
        x = rng.integers(-size, size, (64, 4)) // rng.integers(1, 50)
        code, error = book.nearest(x, book.shortlist(x.min(axis=0), x.max(axis=0)))
        far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)) for e in entries] for v in x]
        assert error.tolist() == [min(f) for f in far] and code.tolist() == [f.index(min(f)) for f in far]


def test_block_of_one_entry_uses_its_sums(spark):
    near = [[c + 0.001 * i, float(c)] for c in (0, 500) for i in range(400)]
    rows = [(i, v, 0, 0, "", 0.0) for i, v in enumerate([[0.0, 0.0], [500.0, 500.0], *near])]
    usable = vector_codes.usable(spark.createDataFrame(rows, VECTORS), 2)
    books = vector_codes.first_codebooks(usable, 2, 1, 2, 1024)
    blocks = vector_codes.sorted_blocks(usable, books, 2, 1024)
    boxes = [(r["low"], *(np.frombuffer(r[c], np.int64)[None] for c in ("low", "high"))) for r in blocks.collect()]
    alone = blocks.filter(F.col("low").isin([low for low, *box in boxes if len(books[0].shortlist(*box)) == 1]))
    # The parts themselves are overwritten: only boxes and sums can answer.
    hidden = alone.withColumn("x", F.expr("cast(repeat('~', length(x)) as binary)"))
    got = [sorted(map(tuple, vector_codes.entry_sums(t, books, 2).collect())) for t in (alone, hidden)]
    assert got[0] == got[1] and sum(n for _, _, n, *_ in got[0]) >= 400
    discard(blocks)


def test_hilbert_neighbours_touch():
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), axis=-1).reshape(-1, n)
        key = vector_codes.hilbert_keys(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def audit_rows():
    long_a, long_b = brute.prose(50, 150, 90000), brute.prose(51, 150, 90000)
    texts = [None, "", " ", long_a, long_a, long_a.upper(), long_b + " #", brute.prose(52, 300, 3), "É日本 $ 😀", long_b, "A" * 200, "", long_a]
    texts += ["word " * 99, " ".join(f"w{i}" for i in range(100)), "x" * 5000 + " " + "x" * 5000 + " tail", long_a + "\x1f|"]
    langs = ["en", None, "", "de", "en", "de"]
    ids = [None if i in (3, 11) else 4 if i == 6 else 40 - i for i in range(len(texts))]
    return [(d, langs[i % 6], t) for i, (d, t) in enumerate(zip(ids, texts, strict=True))]


def test_filter_audit(spark):
    rows = audit_rows()
    labels = [(d, i % 2, int(i % 3 == 0)) for i, (d, _, _) in enumerate(rows)] + [(40, 1, 1), (None, 1, 1), (4, None, None), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, lang string, text string, failures int, part string").repartition(3)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labelled = [x for x in labels if x[0] is not None]
    got = filter_audit.audit(docs, said).collect()
    assert Counter(tuple(r) for r in got) == brute.filter_counts(rows, labelled)
    assert filter_audit.audit(docs.limit(0), said).count() == 0
    none = filter_audit.audit(docs, said.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)


def test_transducer_counts_and_verified_words():
    texts = [t or "" for _, _, t in audit_rows()] + brute.odd_texts()[:-6]
    column = pa.array(texts, pa.string())
    got = filter_audit.text_counts(column, filter_audit.byte_classes())
    for i, t in enumerate(texts):
        w = brute.words(t)
        want = (len(w), len(set(w)), len(t or ""), sum("A" <= c <= "Z" for c in t or ""), sum(c in "#$%&*|" for c in t or ""))
        assert tuple(int(got[c][i]) for c in ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")) == want


def test_distinct_words_when_all_hashes_collide():
    data = b"aa bb aa aaaaaaaaab aaaaaaaaac aaaaaaaaab bb" + b" " + b"z" * 80 + b" " + b"z" * 80 + b" " + b"z" * 79 + b"y"
    flat = np.frombuffer(data, np.uint8)
    starts = np.array([0, *(i + 1 for i, c in enumerate(data) if c == 32)])
    ends = np.array([*(i for i, c in enumerate(data) if c == 32), len(data)])
    rows = np.array([0] * 5 + [1] * (len(starts) - 5))
    want = [len(set(data[a:b] for a, b, r in zip(starts, ends, rows, strict=True) if r == n)) for n in (0, 1)]
    for hashes in (np.zeros(len(starts), np.uint64), None):
        assert filter_audit.distinct_words(flat, starts, ends, rows, 2, hashes).tolist() == want


def line_rows():
    rng = random.Random(3)
    common = [f"line {n} of a notice that many pages carry" for n in range(6)]
    rows = [(None, None), (1, ""), (2, "\n"), (3, "short\nshort\nshort")]
    for i in range(4, 40):
        lines = [rng.choice(common) for _ in range(rng.randrange(4))] + [f"own line of {i} with many words"] * rng.randrange(3)
        lines += [rng.choice(["", "  ", "\tLINE 0 of a Notice that many PAGES carry \r", "É" * 19, "É" * 20, "x" * 19])]
        rng.shuffle(lines)
        rows.append((None if i in (10, 11) else 7 if i in (20, 39) else i, "\n".join(lines) + rng.choice(["", "\n"])))
    rows += [(200, "only rows without id\n" * 2)] + [(None, "a line of rows without any id")] * 3 + [(50, rows[6][1])] * 2
    return rows


def test_line_dedup(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, n_dropped int, shard string").repartition(3)
    got = line_index.drop_repeated_lines(docs, shards=5).select("doc_id", "n_lines", "n_dropped", "text", "shard").collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(brute.drop_lines(rows))
    assert {r["shard"] for r in got} == {"s"}
    assert line_index.drop_repeated_lines(docs.limit(0)).count() == 0


def test_line_index_holds_repeated_lines_and_no_others(spark):
    rng = np.random.default_rng(8)
    h = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    h[1, 0] = h[0, 0]  # equal halves must not meet for ever
    h[3, 1] = h[2, 1]
    index = LineIndex.from_bytes(LineIndex.build(h, np.arange(5000), np.arange(5000) * 7).to_bytes())
    entry = index.look_up(h)
    assert sorted(entry.tolist()) == list(range(5000))
    assert (index.counts[entry] == np.arange(5000)).all() and (index.ids[entry] == np.arange(5000) * 7).all()
    assert (index.look_up(rng.integers(0, 1 << 63, (20000, 2), dtype=np.uint64)) == -1).all()
    empty = LineIndex.build(h[:0], np.zeros(0), np.zeros(0))
    assert (empty.look_up(h) == -1).all()
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = [LineIndex.from_bytes(r["parts"]) for r in line_index.line_indexes(docs, shards=3).collect()]
    keys = {}
    for i, (_, t) in enumerate(rows):
        for x in {y.strip(" \t\n\v\f\r").lower().replace("é", "É") for y in (t or "").split("\n")}:
            if len(x) >= 20:
                keys.setdefault(x, set()).add(i)
    assert sorted(c for p in parts for c in p.counts.tolist()) == sorted(len(v) for v in keys.values() if len(v) >= 3)


def test_stored_needs_a_shared_folder_and_discard_deletes(spark):
    table = stored(spark.range(3), "kept")
    assert table.count() == 3
    path = table.inputFiles()[0]
    discard(table, spark.range(2))
    with pytest.raises(Exception):  # noqa: B017
        spark.read.schema(T.StructType([T.StructField("id", T.LongType())])).parquet(path).count()
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset)
