"""Marts from changes, decisions as a stream, distinct prompts, checks in a write, pages, key ranges."""

import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from abstractmill.operators import evaluation, keyed, quality, review
from abstractmill.operators.extraction import extract
from abstractmill.operators.inference import with_distinct_output, with_model_output
from abstractmill.operators.keyed_table import KeyedTable
from abstractmill.plans import mart_changes, models
from abstractmill.schemas import EXTRACTIONS, RECORD, VALIDATION_RUNS
from abstractmill.sources.tables import key_bounds, key_ranges
from abstractmill.streaming.decisions import DECISIONS, review_stream


@pytest.fixture
def folder(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/changes-{uuid.uuid4().hex}"


# --- marts ----------------------------------------------------------------------------


def cleaned(spark, keys, seed):
    rng = random.Random(seed)
    rows = []
    for k in keys:
        text = " ".join(rng.choice(["ebv", "p53", "cisplatin", "imrt", "nivolumab", "cohort"]) for _ in range(rng.randrange(6)))
        year = rng.choice([None, 2019, 2020])
        rows.append((str(k), "t", text, ["a"], f"{year}-05-01" if year else None, rng.choice([[], ["Lung Neoplasms"]]), rng.choice("xy")))
    df = spark.createDataFrame(rows, "pmid string, title string, abstract_text string, authors array<string>, d string, mesh_terms array<string>, journal string")
    return df.select("pmid", "title", "abstract_text", "authors", F.col("d").cast("date").alias("pub_date"), "mesh_terms", "journal",
                     F.lit("2024-06-01").cast("timestamp").alias("cleaned_at"))


def marts_of(marts):
    return {name: sorted(map(str, m.collect())) for name, m in marts.items()}


def rebuilt(rows):
    base = models.study_base(models.flagged(models.staged(rows)))
    return marts_of({"mart_cancer_studies": models.mart_cancer_studies(base), "mart_treatment_outcomes": models.mart_treatment_outcomes(base)})


def test_marts_follow_changes(spark, folder):
    table = KeyedTable.create(spark, f"{folder}/t", cleaned(spark, range(80), 1), buckets=6)
    ledger = mart_changes.MartLedger(spark, f"{folder}/m")
    assert marts_of(ledger.marts()) == {"mart_cancer_studies": [], "mart_treatment_outcomes": []}
    ledger.record("load", None, table.rows())
    assert marts_of(ledger.marts()) == rebuilt(table.rows())
    mart_changes.replace_rows(table, ledger, "a", cleaned(spark, range(60, 100), 2))
    assert marts_of(ledger.marts()) == rebuilt(table.rows())
    mart_changes.delete_rows(table, ledger, "b", cleaned(spark, range(0, 70), 3))
    assert table.rows().count() == 30 and marts_of(ledger.marts()) == rebuilt(table.rows())
    mart_changes.delete_rows(table, ledger, "c", cleaned(spark, range(100), 3))
    assert ledger.base().count() == 0


def test_interrupted_change_is_recorded_once(spark, folder, monkeypatch):
    table = KeyedTable.create(spark, f"{folder}/t", cleaned(spark, range(20), 1), buckets=3)
    ledger = mart_changes.MartLedger(spark, f"{folder}/m")
    ledger.record("load", None, table.rows())
    batch = cleaned(spark, range(10, 30), 2)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "replace", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            mart_changes.replace_rows(table, ledger, "a", batch)
    for _ in range(2):  # after the failure, and once more after the success
        mart_changes.replace_rows(table, ledger, "a", batch)
        assert marts_of(ledger.marts()) == rebuilt(table.rows())


def test_change_reads_touched_buckets_only(spark, folder):
    table = KeyedTable.create(spark, f"{folder}/t", cleaned(spark, range(60), 1), buckets=16)
    batch = cleaned(spark, [3, 4], 2)
    plan = mart_changes.base_change(table.matching(batch), batch)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and table.name in x)
    assert f"InMemoryFileIndex({len(table.touched(batch))} paths)" in scan


# --- decisions ------------------------------------------------------------------------


def records(spark, n):
    row = "named_struct('tnm_stage', 'S', 'treatment_modality', array('x'), 'biomarkers', array(), 'sample_size', 1L, 'cancer_type', null)"
    return spark.range(n).selectExpr(
        "cast(id as string) pmid", f"{row} extracted", f"{row} original", "0.5D confidence_score", "'v' model_version",
        "timestamp'2024-01-01' extracted_at", "false human_verified", "cast(null as string) reviewer_notes",
    ).select(*[F.col(f.name).cast(f.dataType) for f in EXTRACTIONS.fields])


def decision_rows(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        edited = (f"E{i}", ["y"], [], i, None) if rng.random() < 0.5 else None
        rows.append((str(rng.randrange(14)), rng.choice(["approve", "reject", "skip"]), edited, f"n{i}", rng.randrange(9), i))
    df = spark.createDataFrame(rows, f"pmid string, action string, edited {RECORD.simpleString()}, notes string, s int, seq bigint")
    return df.select("pmid", "action", "edited", "notes", F.timestamp_seconds("s").alias("decided_at"), "seq")


def test_stream_equals_batch_in_any_order_and_after_restarts(spark, folder):
    ext, decisions = records(spark, 12), decision_rows(spark, 90, 4)
    want = sorted(map(str, review.apply_reviews(ext, decisions, ["decided_at", "seq"]).collect()))
    table = KeyedTable.create(spark, f"{folder}/t", ext, buckets=4)
    shuffled = decisions.orderBy(F.xxhash64("seq"))
    thirds = [shuffled.where(F.pmod(F.hash("seq"), F.lit(3)) == i) for i in range(3)]
    for part in (*thirds, thirds[0]):  # the first decisions come once more at the end
        part.repartition(2).write.mode("append").parquet(f"{folder}/in")
        review_stream(spark, f"{folder}/in", table, f"{folder}/check", max_files=1).awaitTermination()
    assert sorted(map(str, table.rows().collect())) == want
    # Nothing new: nothing is written.
    before = sorted(glob.glob(f"{folder}/t/rows/*/*.parquet"))
    review_stream(spark, f"{folder}/in", table, f"{folder}/check").awaitTermination()
    assert sorted(glob.glob(f"{folder}/t/rows/*/*.parquet")) == before
    assert [f.name for f in DECISIONS.fields] == decisions.columns


# --- distinct prompts -----------------------------------------------------------------


def counting_predictor(where):
    def make():
        def predict(prompts):
            with open(os.path.join(where, f"{os.getpid()}-{id(prompts)}"), "a") as out:
                out.write("".join(f"{len(p)}\n" for p in prompts))
            return ['{"sample_size": %d}' % len(p) for p in prompts]

        return predict

    return make


def test_distinct_prompts_are_asked_once(spark, tmp_path):
    texts = [f"A study of many patients, number {i % 7} " + "x" * (i % 7) for i in range(40)] + [None, "tiny"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "pmid int, abstract_text string").repartition(4)
    got = with_distinct_output(df, counting_predictor(str(tmp_path)))
    rows = {tuple(r) for r in got.collect()}
    asked = [int(x) for f in tmp_path.iterdir() for x in f.read_text().split()]
    assert len(asked) == 7 and got.columns == ["pmid", "abstract_text", "model_output"]
    plain = with_model_output(df, counting_predictor(str(tmp_path)))
    assert rows == {tuple(r) for r in plain.collect()}
    assert got.where("model_output is null").count() == 6
    few = with_distinct_output(df, counting_predictor(str(tmp_path)), partitions=1, max_chars=20)
    assert few.where("model_output is not null").count() == 40


def test_rule_path_honours_partitions(spark):
    rows = spark.range(64).select(F.col("id").cast("string").alias("pmid"), F.lit("Stage II in 50 patients with lung cancer").alias("abstract_text"))
    one = extract(rows.coalesce(1), F.lit("2024-06-01"))
    spread = extract(rows.coalesce(1), F.lit("2024-06-01"), partitions=8)
    assert one.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == 8
    assert sorted(map(str, one.collect())) == sorted(map(str, spread.collect()))


# --- evaluation -----------------------------------------------------------------------


def test_pairs_need_unique_keys(spark):
    rows = spark.createDataFrame([("1", 1), ("2", 2)], "pmid string, record int")
    assert evaluation.pair_by_key(rows, rows).count() == 2
    for args in ((rows.union(rows), rows), (rows, rows.union(rows))):
        with pytest.raises(ValueError, match="more than once"):
            evaluation.pair_by_key(*args)


def test_run_log_replaces_a_run(spark, folder):
    def run(name, n):
        null = [f"cast(null as {f.dataType.simpleString()}) {f.name}" for f in VALIDATION_RUNS.fields[6:]]
        return spark.range(n).selectExpr(
            f"'{name}' run_id", "timestamp'2024-01-01' run_at", "'v' model_version", "cast(id as string) field", "1L tp", "2L fp", *null)

    evaluation.append_run(run("a", 3), folder)
    evaluation.append_run(run("b", 2), folder)
    evaluation.append_run(run("a", 4), folder)
    got = evaluation.read_runs(spark, folder)
    assert {r["run_id"]: r["n"] for r in got.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"a": 4, "b": 2}
    assert got.schema.fieldNames() == VALIDATION_RUNS.fieldNames()


# --- pages, caps, ranges --------------------------------------------------------------


def test_pages_united_are_the_queue(spark):
    rng = random.Random(7)
    rows = [(f"k{i:03d}", rng.choice([None, False, True]), rng.choice([None, 0.0, 0.2, 0.4])) for i in range(97)]
    queue = spark.createDataFrame(rows, "pmid string, human_verified boolean, confidence_score double").repartition(3)
    whole = [tuple(r) for r in review.in_review_order(queue).collect()]
    united, after = [], None
    while page := review.queue_page(queue, 10, after).collect():
        united += [tuple(r) for r in page]
        after = (page[-1]["human_verified"], page[-1]["confidence_score"], page[-1]["pmid"])
    assert united == whole
    plan = review.queue_page(queue, 10, after)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_cap(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (2, "a")], "n int, pmid string")
    assert [tuple(r) for r in keyed.capped(df, 2, [F.col("n").desc(), "pmid"]).collect()] == [(3, "c"), (2, "a")]
    assert keyed.capped(df, 9, ["pmid"]).count() == 4


@pytest.mark.parametrize("bounds", [[], ["5"], ["", "1", "10", "2", "O'Hara", "z", "é"]])
def test_key_ranges_meet_each_key_once(spark, bounds):
    keys = [None, "", "0", "1", "10", "1000", "2", "29", "O'Hara", "O", "y", "z", "zz", "é", "日本"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "pmid string, i int")
    found = [r["i"] for c in key_ranges(bounds) for r in df.where(c).collect()]
    assert sorted(found) == list(range(len(keys))) and len(key_ranges(bounds)) == len(bounds) + 1


def test_key_bounds_cut_evenly(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("pmid")).union(spark.createDataFrame([(None,)], "pmid string"))
    bounds = key_bounds(df, 4)
    sizes = [df.where(c).count() for c in key_ranges(bounds)]
    assert sum(sizes) == 1001 and len(sizes) == 4 and min(sizes) > 200
    assert key_bounds(df.where("pmid is null"), 4) == []
    with pytest.raises(ValueError, match="sorted"):
        key_ranges(["b", "a"])


# --- checks in a write ----------------------------------------------------------------


def test_observed_checks_equal_scanned_ones(spark, folder):
    rows = [("1", "x", 5), ("1", None, 50), (None, "y", 60), ("2", "z", None), ("2", "x", 70), ("3", "w", 80)]
    df = spark.createDataFrame(rows, "id string, kind string, n int")
    large = F.coalesce(F.col("n") > 10, F.lit(False))
    watched = quality.ObservedChecks(
        quality.row_checks("all", ["id", "kind"], {"kind": ["x", "y"]})
        + quality.row_checks("large", {"key": "id", "kind": "kind"}, {"kind": ["x", "y"]}, large)
    )
    watched.on(df.repartition(3)).write.parquet(folder)
    held = spark.read.parquet(folder)
    unique = quality.check_unique(held, "id", {"all": ("id", F.lit(True)), "large": ("key", large)})
    got = quality.report(watched.report(spark), unique)
    part = df.where(large).withColumnRenamed("id", "key")
    want = quality.report(
        quality.check_table(df, "all", ["id", "kind"], "id", {"kind": ["x", "y"]}),
        quality.check_table(part, "large", ["key", "kind"], "key", {"kind": ["x", "y"]}),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
