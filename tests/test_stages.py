import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from abstractmill.operators.keyed import upsert
from abstractmill.plans import stages
from abstractmill.plans.stages import Run, compact_state, full_run, ingest_and_clean, open_state
from abstractmill.sources import files
from abstractmill.sources.archive import read_archive, shared_dir, write_archive

NOW = "2024-06-01"
LONG = "A study of 50 patients with Stage III lung cancer after surgery. "


def _raw(spark, rows):
    return spark.createDataFrame(
        [(k, json.dumps({"title": t, "abstract_text": a, "pub_date": "2024-01-01"})) for k, t, a in rows],
        "pmid string, raw_json string",
    ).withColumn("fetched_at", F.lit(NOW).cast("timestamp"))


def _run(spark, incoming, current=None, **kwargs):
    return full_run(
        spark, incoming, shared_dir(spark, "run"), F.lit(NOW), ["fetched_at", "raw_json"],
        shared_dir(spark, "archive"), "2024-06-01", current, **kwargs,
    )


def test_first_run(spark):
    run = _run(spark, _raw(spark, [("1", "a", LONG), ("1", "b", LONG), ("2", "c", "tiny")]))
    assert run.counts == {
        "ingested": 2, "archived": 2, "raw": 2, "cleaned": 1, "extracted": 1, "noted": 1,
    }
    ext = run.tables["extractions"].first()
    assert ext.extracted.tnm_stage == "Stage III" and ext.human_verified is False
    assert ext.original == ext.extracted
    assert run.tables["notes"].first().summary_text.startswith("This study examined 50 patients")
    assert {r.stage: r.n for r in run.counters().collect()} == run.counts


def test_rerun_wipes_edits_of_recleaned_keys(spark):
    first = _run(spark, _raw(spark, [("1", "a", LONG), ("2", "b", LONG)]))
    edited = dict(first.tables)
    edited["extractions"] = first.tables["extractions"].withColumn("human_verified", F.lit(True))
    orphan = first.tables["cleaned"].where("pmid = '1'").withColumn("pmid", F.lit("77"))
    edited["cleaned"] = edited["cleaned"].unionByName(orphan)
    again = _run(spark, _raw(spark, [("1", "z", LONG), ("3", "c", LONG)]), edited)
    assert again.counts["ingested"] == 1 and again.counts["raw"] == 3
    assert again.counts["extracted"] == 4 and again.counts["noted"] == 4
    assert again.tables["extractions"].where("human_verified").count() == 0
    titles = {r.pmid: r.title for r in again.tables["cleaned"].collect()}
    assert titles == {"1": "a", "2": "b", "3": "c", "77": "a"}


def test_only_new_keeps_edits(spark):
    first = _run(spark, _raw(spark, [("1", "a", LONG)]))
    edited = dict(first.tables)
    edited["extractions"] = first.tables["extractions"].withColumn("human_verified", F.lit(True))
    again = _run(spark, _raw(spark, [("2", "b", LONG)]), edited, only_new=True)
    assert again.counts == {
        "ingested": 1, "archived": 2, "raw": 1, "cleaned": 1, "extracted": 1, "noted": 1,
    }
    verified = {r.pmid: r.human_verified for r in again.tables["extractions"].collect()}
    assert verified == {"1": True, "2": False}
    assert again.tables["notes"].count() == 2


def test_older_rows_without_extraction_or_note_are_caught_up(spark):
    rows = [(str(i), "t", LONG + "x" * i) for i in range(6)]
    first = _run(spark, _raw(spark, rows))
    gaps = dict(first.tables)
    gaps["extractions"] = gaps["extractions"].where("pmid not in ('1', '2')")
    gaps["notes"] = gaps["notes"].where("pmid not in ('2', '3')")
    again = _run(spark, _raw(spark, [("9", "t", LONG)]), gaps, only_new=True)
    assert again.counts["extracted"] == 3  # 1, 2 and the new 9
    assert again.counts["noted"] == 3  # 2, 3 and the new 9; the note of 1 was there
    for name in ("extractions", "notes"):
        keys = [r.pmid for r in again.tables[name].collect()]
        assert sorted(keys) == ["0", "1", "2", "3", "4", "5", "9"]
    texts = {r.pmid: r.summary_text for r in again.tables["notes"].collect()}
    assert texts["2"] == texts["3"] == texts["9"]


def test_reset_redoes_everything(spark):
    first = _run(spark, _raw(spark, [("1", "a", LONG)]))
    again = _run(
        spark, _raw(spark, [("2", "b", LONG)]), first.tables, only_new=True, reset_first=True
    )
    assert (again.counts["cleaned"], again.counts["extracted"], again.counts["noted"]) == (1, 2, 2)
    assert again.tables["extractions"].count() == 2 and again.tables["notes"].count() == 2


def test_stored_tables_go_to_the_shared_folder(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_nothing_to_do(spark):
    run = _run(spark, _raw(spark, [("1", "a", "x")]).limit(0))
    assert set(run.counts.values()) == {0} and run.tables["notes"].count() == 0


def test_ingest_and_clean(spark):
    run = ingest_and_clean(
        spark, _raw(spark, [("1", "a", LONG)]), shared_dir(spark, "run"), F.lit(NOW), ["raw_json"]
    )
    assert run.counts == {"ingested": 1, "raw": 1, "cleaned": 1}


def test_archive_replaces_one_date(spark):
    path = shared_dir(spark, "archive")
    write_archive(_raw(spark, [("1", "a", LONG), ("2", "b", LONG)]), path, "2024-06-01")
    write_archive(_raw(spark, [("1", "a", LONG)]), path, "2024-06-02")
    write_archive(_raw(spark, [("3", "c", LONG)]), path, "2024-06-01")
    rows = sorted((str(r.archive_date), r.pmid) for r in read_archive(spark, path).collect())
    assert rows == [("2024-06-01", "3"), ("2024-06-02", "1")]
    day = read_archive(spark, path).where("archive_date = date'2024-06-02'")
    assert json.loads(day.first().raw_json)["title"] == "a"


def test_upsert_leaves_its_inputs_alone(spark):
    target = spark.createDataFrame([("1", "a")], "pmid string, v string")
    upsert(target, spark.createDataFrame([("1", "b")], "pmid string, v string")).collect()
    assert target.first().v == "a"


def test_no_shared_folder_is_an_error():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(bare, "x")


def _rows(tables):
    return {name: sorted(map(str, df.collect())) for name, df in tables.items()}


def test_state_is_opened_from_disk(spark):
    first = _run(spark, _raw(spark, [("1", "a", LONG), ("2", "b", LONG)]))
    assert _rows(open_state(spark, first.out)) == _rows(first.tables)
    second = _run(spark, _raw(spark, [("2", "z", LONG), ("3", "c", LONG)]), first.out, only_new=True)
    state = open_state(spark, second.out)
    assert _rows(state) == _rows(second.tables)
    assert {name: df.count() for name, df in state.items()} == dict.fromkeys(state, 3)
    again = _run(spark, _raw(spark, [("4", "d", LONG)]), second.out, only_new=True, reset_first=True)
    state = open_state(spark, again.out)
    assert _rows(state) == _rows(again.tables)
    assert state["extractions"].select("pmid").distinct().count() == state["extractions"].count() == 4
    whole = _run(spark, _raw(spark, []), again.out)
    assert _rows(open_state(spark, whole.out)) == _rows(whole.tables)
    handed = _run(spark, _raw(spark, [("5", "e", LONG)]), dict(whole.tables), only_new=True)
    assert {name: df.count() for name, df in open_state(spark, handed.out).items()} == dict.fromkeys(state, 5)


def test_interrupted_run_is_invisible(spark):
    run = Run(spark, shared_dir(spark, "run"), F.lit(NOW))
    run.ingest(_raw(spark, [("1", "a", LONG)]), ["raw_json"])
    with pytest.raises(Exception):
        open_state(spark, run.out)


def _rows_of(tables):
    return {name: sorted(map(str, t.collect())) for name, t in tables.items()}


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_state_after_many_runs_is_one_scan_and_compacts(spark):
    folder, rows = None, [(str(i), f"t{i}", LONG + "x" * i) for i in range(24)]
    for i in range(6):
        out = shared_dir(spark, "run")
        full_run(spark, _raw(spark, rows[4 * i : 4 * i + 4]), out, F.lit(NOW), ["fetched_at", "raw_json"],
                 shared_dir(spark, "archive"), "2024-06-01", folder, only_new=True)
        folder = out
    state = open_state(spark, folder)
    assert {name: _scans(t) for name, t in state.items()} == dict.fromkeys(state, 1)
    before = _rows_of(state)
    assert all(len(v) == 24 for v in before.values())
    packed = shared_dir(spark, "run")
    merged = compact_state(spark, folder, packed, fan_in=4)
    assert all(len(merged[name]) >= 4 for name in before)
    assert _rows_of(open_state(spark, packed)) == before == _rows_of(open_state(spark, folder))
    held = json.loads(spark.read.text(f"{packed}/manifest").first()[0])
    assert all(len(f) <= 3 for f in held.values())
    # Nothing is left to merge, and large folders stay where they are.
    assert compact_state(spark, packed, shared_dir(spark, "run"), fan_in=4) == {}
    again = _run(spark, _raw(spark, rows[:2] + [("90", "t", LONG)]), packed, only_new=True)
    assert again.counts["ingested"] == 1 and again.tables["notes"].count() == 25


@pytest.mark.parametrize("stops", ["clean_abstracts", "extract", "write_notes", "_write_manifest"])
def test_interrupted_run_goes_on(spark, monkeypatch, stops):
    start = shared_dir(spark, "run")
    first = [("1", "a", LONG), ("2", "b", LONG), ("3", "c", "tiny")]
    full_run(spark, _raw(spark, first), start, F.lit(NOW), ["fetched_at"], shared_dir(spark, "archive"), "2024-05-01")
    out, archive = shared_dir(spark, "run"), shared_dir(spark, "archive")
    incoming = _raw(spark, [("2", "z", LONG), ("4", "d", LONG), ("5", "e", LONG + "!")])

    def go(resume):
        return full_run(spark, incoming, out, F.lit(NOW), ["fetched_at"], archive, "2024-06-01", start, resume=resume)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(stages, stops, broken)
        with pytest.raises(RuntimeError, match="lost"):
            go(False)
    with pytest.raises(Exception):  # noqa: B017
        open_state(spark, out)
    written = spark.read.parquet(f"{out}/raw/part=new").inputFiles()
    run = go(True)
    assert spark.read.parquet(f"{out}/raw/part=new").inputFiles() == written
    assert run.counts == {"ingested": 2, "archived": 5, "raw": 5, "cleaned": 4, "extracted": 4, "noted": 4}
    whole = full_run(spark, incoming, shared_dir(spark, "run"), F.lit(NOW), ["fetched_at"], archive, "2024-06-01", start)
    assert _rows_of(open_state(spark, out)) == _rows_of(whole.tables) == _rows_of(run.tables)
    assert read_archive(spark, archive).count() == 5
    with pytest.raises(ValueError, match="started from"):
        Run(spark, out, F.lit(NOW), None, resume=True)
    fresh = go(False)  # without resume everything is written anew
    assert fresh.counts == run.counts and not files.exists(spark, f"{out}/log/0099")


def test_run_needs_a_folder_of_its_own(spark):
    run = _run(spark, _raw(spark, [("1", "a", LONG)]))
    with pytest.raises(ValueError, match="another folder"):
        Run(spark, run.out, F.lit(NOW), run.out)
