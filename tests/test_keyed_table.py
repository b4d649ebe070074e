"""Keyed tables laid out by buckets: same rows as the whole-table operators, few files written."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from abstractmill.operators import keyed
from abstractmill.operators.keyed_table import KeyedTable

SCHEMA = "pmid string, text string, score double, first string, flag boolean"


@pytest.fixture
def folder(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/keyed-{uuid.uuid4().hex}"


def rows(spark, keys, mark, n=60):
    values = [(str(k), f"{mark}{k}", k / 2, None if k % 3 else mark, k % 2 == 0) for k in keys]
    return spark.createDataFrame(values, SCHEMA)


def held(df):
    return sorted(tuple(r) for r in df.collect())


def files(table):
    """Bucket -> files."""
    out = {}
    for f in table.spark.read.parquet(f"{table.path}/rows").inputFiles():
        out.setdefault(int(re.search(r"__bucket=(\d+)", f)[1]), set()).add(f)
    return out


def test_replace_writes_touched_buckets_only(spark, folder):
    old, batch = rows(spark, range(200), "a"), rows(spark, [3, 5, 1000], "b")
    table = KeyedTable.create(spark, folder, old, buckets=16)
    before = files(table)
    touched = table.touched(batch)
    assert 1 <= len(touched) <= 3
    table.replace(batch)
    after = files(table)
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    assert all(len(f) == 1 for f in after.values())
    assert held(table.rows()) == held(keyed.replace_by_key(old, batch))
    table.replace(batch)  # once more: nothing changes
    assert held(KeyedTable.open(spark, folder).rows()) == held(keyed.replace_by_key(old, batch))


def exchanges_over_table(plan):
    """Whether a line of the plan above the table's scan, at a lower depth, is an exchange."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:+\-*()\d|]*", x)[0]) for x in lines]
    scans = [i for i, x in enumerate(lines) if "keyed_" in x and "FileScan" in x]
    assert scans
    found = []
    for i in scans:
        level = depth[i]
        for j in range(i, -1, -1):
            if depth[j] < level:
                level = depth[j]
                found += [lines[j]] if "Exchange" in lines[j] else []
    return found


def test_table_is_never_shuffled(spark, folder):
    table = KeyedTable.create(spark, folder, rows(spark, range(100), "a"), buckets=8)
    batch = rows(spark, range(50, 90), "b")
    same = {c: F.col("__new")[c] for c in table.schema.fieldNames()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (table.changed(batch, same), table.matching(batch), table.repeated_keys()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and exchanges_over_table(plan) == []
        # The same join of plain tables moves both sides, which the test would see.
        moved = table.rows().withColumn("pmid", F.concat("pmid", F.lit(""))).join(batch, "pmid")
        assert exchanges_over_table(moved._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_and_insert(spark, folder):
    old = rows(spark, range(40), "a")
    batch = rows(spark, range(20, 60), "b").select("score", "pmid", "first")
    table = KeyedTable.create(spark, folder, old, buckets=5)
    want = keyed.upsert(old, batch, first_wins=["first"], defaults={"flag": F.lit(False)})
    table.upsert(batch, first_wins=["first"], defaults={"flag": F.lit(False)})
    assert held(table.rows()) == held(want)
    more = rows(spark, [*range(50, 70), 65, 65], "c").withColumn("n", F.monotonically_increasing_id())
    want = keyed.insert_if_absent(table.rows(), more, ["n"]).collect()
    table.insert_if_absent(more, ["n"])
    assert held(table.rows()) == sorted(tuple(r) for r in want)


def test_nested_columns_of_any_nullability(spark, folder):
    old = spark.range(6).selectExpr("cast(id as string) pmid", "named_struct('a', array('x'), 'n', id) r")
    batch = spark.range(4, 8).selectExpr("cast(id as string) pmid", "named_struct('a', array(cast(null as string)), 'n', cast(null as bigint)) r")
    table = KeyedTable.create(spark, folder, old, buckets=3)
    table.upsert(batch, first_wins=["r"])
    table.replace(batch.limit(1))
    table.replace(batch)
    got = {r["pmid"]: r["r"]["n"] for r in KeyedTable.open(spark, folder).rows().collect()}
    assert got == {str(k): k if k < 4 else None for k in range(8)}


def test_update_ignores_unknown_keys(spark, folder):
    table = KeyedTable.create(spark, folder, rows(spark, range(10), "a"), buckets=3)
    batch = spark.createDataFrame([("4", "new"), ("99", "new")], "pmid string, said string")
    table.update(batch, {"text": F.col("__new.said")})
    got = {r["pmid"]: r["text"] for r in table.rows().collect()}
    assert got == {str(k): "new" if k == 4 else f"a{k}" for k in range(10)}


def test_delete_empties_buckets(spark, folder):
    table = KeyedTable.create(spark, folder, rows(spark, range(30), "a"), buckets=7)
    before = files(table)
    one = table.touched(rows(spark, [1], "x"))[0]
    full = [r["pmid"] for r in table._in([one]).collect()]
    some = rows(spark, [int(k) for k in full] + [2, 2, 500], "x")
    want = held(keyed.delete_keys(table.rows(), some))
    table.delete(some)
    after = files(table)
    assert one not in after and held(table.rows()) == want
    assert {b for b in before if before[b] != after.get(b)} <= set(table.touched(some))
    table.delete(rows(spark, range(30), "x"))
    assert held(table.rows()) == []
    table.replace(rows(spark, [8], "z"))
    assert [r["pmid"] for r in table.rows().collect()] == ["8"]


def test_keys_are_checked(spark, folder):
    twice = rows(spark, [1, 1], "a")
    with pytest.raises(ValueError, match="more than once"):
        KeyedTable.create(spark, folder, twice, buckets=2)
    table = KeyedTable.create(spark, folder + "b", rows(spark, [1], "a"), buckets=2)
    with pytest.raises(ValueError, match="more than once"):
        table.replace(twice)
    null = spark.createDataFrame([(None, "x", 1.0, "y", True)], SCHEMA)
    with pytest.raises(Exception, match="null pmid"):
        table.replace(null)
    table.replace(twice.unionByName(rows(spark, [2], "b")), order_by=["text"])
    assert table.rows().count() == 2 and table.repeated_keys().count() == 0
    assert held(table.matching(rows(spark, [2, 3], "q"))) == held(rows(spark, [2], "b"))
