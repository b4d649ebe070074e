"""Chat formatting, nearest neighbours, SQL of the queries and the pipeline."""

import hashlib
import os
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from abstractmill.llm import ann, chat_format, queries

SMALL = "/root/testdata/sf0.001"


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "a\\b \\ \\\\", "<|start|>user\nx<|end|>\n", None, "", "<<SYS>> [INST", "é😀\n\n", "<|endoftext|>"]
    rows = [(c, t, role, said[(c + t) % len(said)], "x") for c in range(8) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", "user"][: c + 1])]
    rows += [(50, 0, None, "no role", "x"), (51, 1, "user", "b", "x"), (51, 1, "assistant", "a", "x"), (51, 1, "assistant", "a", "x"), (None, 0, "user", "q", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, example string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.prefix_examples(table)).collect()}
    turns = defaultdict(list)
    for c, t, role, text, _ in rows:
        turns[c].append((t, role or "", text or ""))
    assert set(got) == set(turns)
    for c, held in turns.items():
        held.sort()
        loss = "".join(x for _, role, x in held if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for _, role, x in held)
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(held), len(loss))
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    examples = chat_format.prefix_examples(table).collect()
    for r in examples:  # controls are only those of the template
        assert r["text"].count("<|start|>") == r["text"].count("<|end|>") and "[/INST]" not in r["text"] and "<|endoftext|>" not in r["text"]
    assert Counter(r["conv_id"] for r in examples)[4] == 2  # two replies, of which the last ends it
    assert chat_format.read_back(chat_format.prefix_examples(table.limit(0))).count() == 0


@pytest.mark.parametrize("blocks", [(1, 1), (2, 3)])
def test_nearest(spark, blocks):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((120, 8))
    v[10:40] = v[0]  # many equal vectors
    v[50] = 3 * v[0]
    rows = [(i, x.tolist(), "s") for i, x in enumerate(v)]
    rows += [(200, None, "s"), (210, [0.0] * 8, "s"), (220, [1.0] * 7 + [float("nan")], "s"), (230, [1.0] * 7 + [None], "s"), (240, [1.0] * 3, "s"), (250, [float("inf")] + [1.0] * 7, "s"), (None, [1.0] * 8, "s")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 10 == 0, 5, 8, query_blocks=blocks[0], row_blocks=blocks[1]).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 120, 10))
    for q, found in got.items():
        score = [(-float(ann.exact_cosine(v[[q]], v[[i]])[0]), i) for i in range(120) if i != q]
        assert found == [(i, -s) for s, i in sorted(score)[:5]]
    few = ann.nearest(table.filter("vec_id < 3"), F.col("vec_id") == 0, 5, 8).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert ann.nearest(table.limit(0), F.col("vec_id") == 0, 5, 8).count() == 0


def test_repeated_query_ids_and_hot_ids(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((60, 8))
    ids = [50, 50, 0, 0, *range(1, 9), *[7] * 48]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    got = Counter(tuple(r) for r in ann.nearest(table, F.col("vec_id") % 50 == 0, 5, 8, query_blocks=2, row_blocks=3).select("query_id", "rank", "vec_id", "score").collect())
    want = Counter()
    for q in range(4):
        score = sorted((-float(ann.exact_cosine(v[[q]], v[[i]])[0]), ids[i]) for i in range(60) if i != q)[:5]
        want.update((ids[q], n, i, -s) for n, (s, i) in enumerate(score, 1))
    assert got == want


def test_hot_vector_adds_few_survivors():
    rng = np.random.default_rng(9)
    v = rng.standard_normal((500, 16))
    v[:400] = v[0]
    batch = next(ann._coded(16)(iter([pa.RecordBatch.from_pydict({"row": pa.array(range(500)), "vec_id": pa.array(range(500)), "query": pa.array([True] * 500), "v": pa.array(v.tolist(), pa.list_(pa.float64()))})])))
    block = next(ann._pack(iter([batch.append_column("block", pa.array([0] * 500, pa.int32()))])))
    table = pa.Table.from_batches([block])
    queries, rows = ann._side(table, 16), ann._side(table, 16, copies=6)
    assert len(rows[0]) == 106
    asked, found, low, high = ann._tile(queries, rows, 5)
    assert (np.bincount(asked) <= 60).all() and (low <= high).all()


def test_tiles_lose_nothing():
    rng = np.random.default_rng(2)
    q, v = rng.standard_normal((40, 64)), rng.standard_normal((900, 64)) * rng.lognormal(0, 9, (900, 1))
    numbers = np.arange(900)
    sides = [(n, n, *ann._codes(x)) for n, x in ((np.arange(1000, 1040), q), (numbers, v))]
    asked, rows, low, high = ann._tile(*sides, 5)
    for n in range(40):
        cosine = ann.exact_cosine(np.repeat(q[[n]], 900, 0), v)
        own = rows[asked == 1000 + n]
        assert set(np.argsort(-cosine)[:5]) <= set(own) and len(own) < 200
        assert ((low <= cosine[rows] + 1e-12) & (cosine[rows] - 1e-12 <= high))[asked == 1000 + n].all()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    names = sorted(got.columns)
    want = db.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want)


def test_every_operator_has_a_query():
    found = contract.queries()
    for n in range(1, 14):
        assert len([x for x in found if x.startswith(f"op{n}_")]) == 1
    assert found["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Small tables with copies, a shared passage, benchmark passages and junk among clean documents."""
    folder = str(tmp_path_factory.mktemp("tables"))
    passage, item = brute.prose(77, 60), brute.prose(78, 40)
    clean = [brute.prose(1000 + i, 80 + i) + "." for i in range(40)]
    junk = [" ".join(f"{w.upper()}!!" for w in brute.prose(2000 + i, 60).split()) for i in range(20)]
    texts = dict(enumerate(clean)) | {100 + i: t for i, t in enumerate(junk)}
    texts |= {200: clean[0], 201: brute.edited(clean[1], 1, 1), 202: clean[2] + " " + passage, 203: brute.prose(5000, 50) + " " + passage, 204: brute.prose(5001, 90) + " " + item, 205: None}
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item), (1, brute.prose(9999, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(0, 30)] + [(100 + i, 0, 0) for i in range(15)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, texts, passage


def test_pipeline_stages(spark, planted):
    folder, texts, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if k < 5 else {}
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == columns
            path = os.path.join(folder, f"stage{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            kept.append((before, {r["doc_id"]: r["text"] for r in docs.collect()}))
    assert all(i in kept[0][1] for i in range(40)) and not any(100 + i in kept[0][1] for i in range(20))
    before, after = kept[1]
    ids = sorted(before)
    place, _ = brute.components([before[i] for i in ids])
    assert set(after) == {ids[p] for p in place}
    before, after = kept[2]
    cut = brute.cut_repeats([before[i] for i in ids if i in before])
    assert set(after) == set(before)
    for i, (_, removed, digest) in zip([i for i in ids if i in before], cut, strict=True):
        assert after[i] == before[i] if not removed else hashlib.sha256(after[i].encode()).hexdigest() == digest
    assert passage not in (after[203] or "")
    assert set(kept[3][0]) - set(kept[3][1]) == {204}
    pieces = out.collect()
    assert {r["doc_id"] for r in pieces} == set(kept[3][1]) and {r["offset"] for r in pieces} >= {0}
    assert corpus_pipeline.run(spark, folder).count() == len(pieces)
