"""Many terms in one pass, against ``in`` and against the rules."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from abstractmill.functions import lexicon
from abstractmill.functions.lexicon import Automaton, labels_in, terms_in
from abstractmill.functions.rules import with_rule_record
from abstractmill.schemas import BIOMARKER_TERMS, TREATMENT_TERMS


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def brute(texts, terms):
    return [(r, i) for r, t in enumerate(texts) for i, x in enumerate(terms) if x in t]


@pytest.mark.parametrize("piece", [3, 512])
def test_matches_of_random_texts(monkeypatch, piece):
    monkeypatch.setattr(lexicon, "PIECE", piece)
    rng = random.Random(piece)
    for alphabet in ("ab", "abcé日 "):
        for _ in range(30):
            terms = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 25))})
            texts = ["".join(rng.choice(alphabet + "z") for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(12)]
            rows, found = Automaton(terms).matches(*flat(texts))
            assert list(zip(rows.tolist(), found.tolist(), strict=True)) == brute(texts, terms)


def test_no_terms_no_texts():
    assert [len(x) for x in Automaton([]).matches(*flat(["abc", ""]))] == [0, 0]
    assert [len(x) for x in Automaton(["a"]).matches(*flat([]))] == [0, 0]
    for bad in (["a", "a"], [""]):
        with pytest.raises(ValueError, match="distinct"):
            Automaton(bad)


def test_large_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(lexicon, "MOST_CELLS", 1000)
    with pytest.raises(ValueError, match="too large"):
        Automaton([f"term number {i}" for i in range(200)])


def test_time_does_not_grow_with_terms():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    texts = [" ".join(word() for _ in range(200)) for _ in range(300)]
    took = []
    for n in (30, 3000):
        automaton = Automaton(sorted({word() for _ in range(n)}))
        took.append(min(_timed(automaton, texts) for _ in range(3)))
    assert took[1] < 3 * took[0] + 0.05  # a hundred times the terms


def _timed(automaton, texts):
    start = time.perf_counter()
    automaton.matches(*flat(texts))
    return time.perf_counter() - start


def test_columns(spark):
    texts = ["cisplatin then imrt, ebv dna and pd-l1", None, "", "nothing", "surgery", "programmed death-ligand vegf her2 her2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    got = {r["i"]: r["x"] for r in df.select("i", terms_in(spark, F.col("t"), ["her2", "vegf", "ebv", "ebv dna"]).alias("x")).collect()}
    assert got == {0: ["ebv", "ebv dna"], 1: [], 2: [], 3: [], 4: [], 5: ["her2", "vegf"]}
    rules = {r["i"]: r["r"] for r in with_rule_record(df.withColumn("t", F.rpad("t", 80, " ")), "t", "r").collect()}
    for lists, field in ((TREATMENT_TERMS, "treatment_modality"), (BIOMARKER_TERMS, "biomarkers")):
        labels = {r["i"]: r["x"] for r in df.select("i", labels_in(spark, F.lower("t"), lists).alias("x")).collect()}
        assert all(labels[i] == (rules[i][field] or []) for i in labels)
