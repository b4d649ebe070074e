import pytest
from pyspark.sql import functions as F

from abstractmill.operators import keyed


def _kv(spark, rows, kind="pmid string, v string"):
    return spark.createDataFrame(rows, kind)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_if_absent_keeps_old_and_takes_the_first(spark):
    target = _kv(spark, [("1", "old"), ("2", "old")])
    batch = _kv(
        spark,
        [("2", "new", 1), ("3", "late", 9), ("3", "early", 2), ("4", None, 3)],
        "pmid string, v string, seq int",
    )
    got = keyed.insert_if_absent(target, batch, ["seq"])
    assert got.columns == ["pmid", "v"]
    assert _set(got.fillna("null")) == [("1", "old"), ("2", "old"), ("3", "early"), ("4", "null")]
    assert keyed.absent_rows(target, batch, ["seq"]).count() == 2


def test_hot_key_is_reduced_before_the_shuffle(spark):
    batch = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("pmid"),
        F.col("id").alias("seq"),
    )
    first = keyed.first_per_key(batch, ["seq"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert first.count() == 200_001
    assert first.where("pmid = 'hot'").first().seq == 0


def test_insert_shuffles_the_batch_once(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) pmid", "'x' v", "id s").write.parquet(
        str(tmp_path / "b")
    )
    batch = spark.read.parquet(str(tmp_path / "b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = keyed.absent_rows(batch.drop("s"), batch, ["s"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("hashpartitioning") == 2  # the batch and the known keys


def test_last_per_key(spark):
    batch = _kv(spark, [("1", "a", 1), ("1", "b", 3), ("1", "c", 2)], "pmid string, v string, s int")
    assert _set(keyed.last_per_key(batch, ["s"])) == [("1", "b", 3)]


def test_null_key_fails(spark):
    target = _kv(spark, [("1", "old")])
    with pytest.raises(Exception, match="null pmid"):
        keyed.insert_if_absent(target, _kv(spark, [(None, "x")]), ["v"]).collect()
    with pytest.raises(Exception, match="null pmid"):
        keyed.upsert_notes(target, _kv(spark, [(None, "x")])).collect()


def test_new_keys(spark):
    candidates = _kv(spark, [("3", "c"), ("1", "a"), ("2", "b")])
    assert _set(keyed.new_keys(candidates, _kv(spark, [("1", "x"), ("1", "y")]))) == [
        ("2", "b"), ("3", "c"),
    ]


def test_replace_and_cascade(spark):
    target = _kv(spark, [("1", "old"), ("2", "old")])
    batch = _kv(spark, [("2", "new"), ("3", "new")])
    assert _set(keyed.replace_by_key(target, batch)) == [("1", "old"), ("2", "new"), ("3", "new")]
    assert _set(keyed.delete_keys(target, batch)) == [("1", "old")]
    assert _set(keyed.replace_by_key(target, batch.limit(0))) == _set(target)


EXT = (
    "pmid string, extracted string, original string, confidence_score double, "
    "model_version string, human_verified boolean, reviewer_notes string"
)
BATCH = "pmid string, extracted string, original string, confidence_score double, model_version string"


def test_upsert_extractions(spark):
    target = spark.createDataFrame(
        [
            ("1", "e1", "o1", 0.2, "v0", True, "n1"),
            ("2", "e2", "o2", 0.2, "v0", True, "n2"),
            ("3", "e3", None, 0.2, "v0", None, None),
        ],
        EXT,
    )
    batch = spark.createDataFrame(
        [("2", "E2", "E2", None, "v1"), ("3", "E3", "E3", 0.4, "v1"), ("4", "E4", "E4", 0.6, "v1")],
        BATCH,
    )
    got = {r.pmid: tuple(r)[1:] for r in keyed.upsert_extractions(target, batch).collect()}
    assert got == {
        "1": ("e1", "o1", 0.2, "v0", True, "n1"),
        "2": ("E2", "o2", None, "v1", True, "n2"),
        "3": ("E3", "E3", 0.4, "v1", None, None),
        "4": ("E4", "E4", 0.6, "v1", False, None),
    }


def test_upsert_of_a_small_batch_moves_no_target_rows(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) pmid", "'x' v").write.parquet(
        str(tmp_path / "t")
    )
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = _kv(spark, [("5", "y")])
    batch.write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    plan = keyed.upsert_notes(target, batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_reset_and_backfill(spark):
    ext = spark.createDataFrame([("1", "e", None), ("2", "e", "o")], "pmid string, extracted string, original string")
    assert keyed.reset(ext).count() == 0 and keyed.reset(ext).columns == ext.columns
    assert _set(keyed.backfill_original(ext)) == [("1", "e", "e"), ("2", "e", "o")]


def test_repeated_keys_fail_or_the_last_counts(spark):
    target, batch = _kv(spark, [("1", "old")]), _kv(spark, [("1", "a"), ("1", "b"), ("2", "c")])
    for change in (keyed.replace_by_key, keyed.upsert):
        with pytest.raises(ValueError, match="'1' comes more than once"):
            change(target, batch)
        assert _set(change(target, batch, order_by=["v"])) == [("1", "b"), ("2", "c")]
