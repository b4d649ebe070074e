"""The batch run: ingest, archive, clean, extract, write notes."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_abstracts
from ..operators.extraction import RULES_VERSION, extract, note_rows, with_texts, write_notes
from ..operators.inference import PredictorFactory
from ..operators.keyed import absent_rows, delete_keys, new_keys, reset
from ..schemas import CLEANED, NOTES, RAW, TABLES, conform
from ..sources import files
from ..sources.archive import write_archive
from ..sources.tables import empty_table, read_table


STATE_TABLES = ("raw", "cleaned", "extractions", "notes")


def _manifest(spark: SparkSession, out: str) -> dict[str, list[str]]:
    return json.loads(spark.read.text(f"{out}/manifest", wholetext=True).first()[0])


def _scan(spark: SparkSession, name: str, folders: list[str]) -> DataFrame:
    """All folders of a table in one scan, however many runs have added to it."""
    if not folders:
        return empty_table(spark, name)
    return conform(spark.read.schema(TABLES[name]).parquet(*folders), TABLES[name])


def _write_manifest(spark: SparkSession, out: str, folders: dict[str, list[str]]) -> None:
    text = spark.createDataFrame([(json.dumps(folders),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{out}/manifest")


def open_state(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The four tables as the complete run under ``out`` left them.

    The folders are those that the run's manifest lists. It is written last, so a run that
    was interrupted has none and cannot be opened.
    """
    folders = _manifest(spark, out)
    return {name: _scan(spark, name, folders.get(name, [])) for name in STATE_TABLES}


def compact_state(
    spark: SparkSession, current: str, out: str, fan_in: int = 8, file_bytes: int = 128 << 20
) -> dict[str, list[str]]:
    """The state of ``current`` with its small folders merged, under a manifest in ``out``.

    Folders of a table whose sizes lie within a factor of ``fan_in`` form a tier; a tier of
    ``fan_in`` folders or more becomes one folder, of the next tier. A row is
    thus rewritten once per tier, not once per run, and a table keeps about ``fan_in`` folders a tier.
    Folders that stay are listed where they are; nothing is deleted, so a
    reader of the old manifest is not disturbed. Returns the merged folders by table.
    """
    folders = _manifest(spark, current)
    merged: dict[str, list[str]] = {}
    for name in STATE_TABLES:
        sizes = {f: files.total_bytes(spark, f) for f in folders.get(name, [])}
        tiers: dict[int, list[str]] = {}
        for folder, size in sizes.items():
            tiers.setdefault(int(math.log(size + 1, fan_in)), []).append(folder)
        for tier, members in tiers.items():
            if len(members) < fan_in:
                continue
            into = f"{out}/{name}/tier={tier}"
            n_files = -(-sum(sizes[f] for f in members) // file_bytes)
            _scan(spark, name, members).coalesce(max(1, n_files)).write.mode("overwrite").parquet(into)
            folders[name] = [f for f in folders[name] if f not in members] + [into]
            merged.setdefault(name, []).extend(members)
    _write_manifest(spark, out, folders)
    return merged


class Run:
    """One run over the four tables, whose next state ``open_state(spark, out)`` opens.

    ``current`` is the folder of the last complete run, or its tables; an incomplete run is
    repeated from the same ones. Each stage is called at most once, in the order of
    ``full_run``, and ``commit`` last: it writes the manifest, which lists the folders that
    make up each table. Folders of earlier runs stay in it where their rows did not change.

    Every stage reads stored tables and writes one, so a lost executor only repeats
    tasks of the current stage, and no stage is computed twice. A table's folder holds
    ``part=kept`` (old rows that survive) and ``part=new``. Rows are counted by the tasks
    that write them, which a repeated task does not count twice; ``counts`` maps stage to
    rows.

    Texts are read twice: once raw, to clean them, and once cleaned, for the record and
    its note. Joins that decide what is left to do carry keys; their result is stored,
    so the optimizer knows its size before it plans the join that fetches the texts.

    Each write that came to its end is logged under ``out/log``, with its counts. A run that
    was interrupted goes on with ``resume=True`` and the same arguments: what is logged is
    not written again, the rest is computed from the same stored tables.
    """

    def __init__(
        self,
        spark: SparkSession,
        out: str,
        now: Column,
        current: dict[str, DataFrame] | str | None = None,
        resume: bool = False,
    ):
        self.spark = spark
        self.out = out
        self.now = now
        #: what an interrupted run has written: folder -> counts of that write
        self._done: dict[str, dict[str, int]] = {}
        self._logged = 0
        start = current if isinstance(current, str) else None
        if start == out:
            raise ValueError("a run writes to another folder than the one it starts from")
        if resume:
            self._read_log(start)
        else:
            files.delete(spark, f"{out}/log")
            files.delete(spark, f"{out}/manifest")
        if not self._logged:
            self._log({"current": start})
        self.counts: dict[str, int] = {}
        self._open: list[tuple[str, Observation]] = []
        self.tables = {name: empty_table(spark, name) for name in STATE_TABLES}
        #: table -> folders of its rows; tables that were handed in have none until commit
        self._folders: dict[str, list[str]] = {name: [] for name in STATE_TABLES}
        self._handed: dict[str, DataFrame] = {}
        if isinstance(current, str):
            self._folders.update(_manifest(spark, current))
            self.tables = open_state(spark, current)
        elif current:
            self._handed = dict(current)
            self.tables.update(current)
        self._ingested = empty_table(spark, "raw")
        # Abstracts known to have no extraction, and those that must be looked up.
        self._due = empty_table(spark, "cleaned")
        self._unsure = self.tables["cleaned"]
        # Extractions that may lack a note and do not bring its text along.
        self._noteless = self.tables["extractions"]

    def ingest(self, incoming: DataFrame, order_by: list[str]) -> DataFrame:
        """Add raw rows with unknown keys. Old raw rows are neither read wide nor rewritten."""
        added = absent_rows(self.tables["raw"], incoming, order_by)
        self._write("raw", "new", conform(added, RAW), "ingested")
        self._ingested = self._read("raw", "new")
        self.tables["raw"] = self.tables["raw"].unionByName(self._ingested)
        return self.tables["raw"]

    def archive(self, path: str, date: str) -> None:
        rows = self._observed(self.tables["raw"], "archived")
        self._once(f"{path} {date}", lambda: write_archive(rows, path, date))

    def clean(self, only_new: bool = False) -> DataFrame:
        """Clean the raw table and replace by key, with the cascade to both child tables.

        By default every raw row is cleaned again, which also deletes the extractions,
        human edits and notes of all cleaned keys. ``only_new`` cleans what this run has
        ingested; nothing is deleted then, and no old row is read or rewritten.
        """
        raw = self._ingested if only_new else self.tables["raw"]
        batch = clean_abstracts(self._observed(raw, "raw"), self.now)
        self._write("cleaned", "new", conform(batch, CLEANED), "cleaned")
        fresh = self._read("cleaned", "new")
        if not only_new:
            for name in ("notes", "extractions", "cleaned"):
                self._write(name, "kept", delete_keys(self.tables[name], fresh))
                self.tables[name] = self._read(name, "kept")
                self._handed.pop(name, None)
        # Extractions refer to cleaned rows, so a key cleaned just now cannot have one.
        self._due, self._unsure = fresh, self.tables["cleaned"]
        self.tables["cleaned"] = self.tables["cleaned"].unionByName(fresh)
        return self.tables["cleaned"]

    def reset(self) -> None:
        """Forget all notes and extractions, reviewed ones too, so that all are redone."""
        for name in ("notes", "extractions"):
            self.tables[name] = reset(self.tables[name])
            self._folders[name] = []
            self._handed.pop(name, None)
        self._due, self._unsure = self.tables["cleaned"], empty_table(self.spark, "cleaned")

    def extract(
        self,
        make_predictor: PredictorFactory | None = None,
        model_version: str = RULES_VERSION,
        max_chars: int | None = None,
        partitions: int | None = None,
    ) -> DataFrame:
        """Extract every abstract that has no extraction. All keys are new: an append."""
        self._noteless = self.tables["extractions"]
        missing = new_keys(self._unsure.select("pmid"), self.tables["extractions"])
        missing = self._todo(missing, "extract")
        todo = self._due.unionByName(self._unsure.join(missing, "pmid", "left_semi"))
        batch = extract(todo, self.now, make_predictor, model_version, True, max_chars, partitions)
        batch = batch.withColumns(
            {"human_verified": F.lit(False), "reviewer_notes": F.lit(None).cast("string")}
        )
        self._write("extractions", "new", batch, "extracted")
        self._due, self._unsure = empty_table(self.spark, "cleaned"), self.tables["cleaned"]
        new = self._read("extractions", "new")
        self.tables["extractions"] = self.tables["extractions"].unionByName(new)
        return self.tables["extractions"]

    def notes(self) -> DataFrame:
        """Write a note for every extraction without one.

        Extractions of this run bring their note text along; older ones fetch the text.
        """
        older = new_keys(self._noteless.select("pmid", "extracted"), self.tables["notes"])
        older = self._todo(older, "notes")
        batch = write_notes(with_texts(older, self.tables["cleaned"]), self.now)
        if self._noteless is not self.tables["extractions"]:
            ready = self.spark.read.parquet(f"{self.out}/extractions/part=new")
            ready = new_keys(ready.select("pmid", "summary_text"), self.tables["notes"])
            batch = batch.unionByName(note_rows(ready, self.now))
        self._write("notes", "new", conform(batch, NOTES), "noted")
        self.tables["notes"] = self.tables["notes"].unionByName(self._read("notes", "new"))
        return self.tables["notes"]

    def commit(self) -> None:
        """Write the manifest: from now on the run's state can be opened."""
        for name, table in self._handed.items():
            folder = f"{self.out}/{name}/part=current"
            table.write.mode("overwrite").parquet(folder)
            self._folders[name].insert(0, folder)
        self._handed = {}
        _write_manifest(self.spark, self.out, self._folders)

    def counters(self) -> DataFrame:
        """Counts as a table of one row per stage."""
        return self.spark.createDataFrame(list(self.counts.items()), "stage string, n bigint")

    def _read(self, name: str, part: str) -> DataFrame:
        return read_table(self.spark, name, f"{self.out}/{name}/part={part}")

    def _write(self, name: str, part: str, df: DataFrame, stage: str | None = None) -> None:
        df = df if stage is None else self._observed(df, stage)
        folder = f"{self.out}/{name}/part={part}"
        self._once(folder, lambda: df.write.mode("overwrite").parquet(folder))
        held = [f for f in self._folders[name] if f != folder]
        if part == "kept":  # in place of all earlier rows, beside this run's new ones
            held = [f for f in held if f == f"{self.out}/{name}/part=new"]
        self._folders[name] = [*held, folder]

    def _todo(self, df: DataFrame, name: str) -> DataFrame:
        folder = f"{self.out}/todo/{name}"
        self._once(folder, lambda: df.write.mode("overwrite").parquet(folder))
        return self.spark.read.schema(df.schema).parquet(folder)

    def _once(self, folder: str, write: Callable[[], None]) -> None:
        """Write and log with the counts of the write, unless the interrupted run has done so."""
        if folder in self._done:
            self._open = []
            self.counts.update(self._done[folder])
            return
        write()
        seen = {stage: observed.get["n"] for stage, observed in self._open}
        self._open = []
        self.counts.update(seen)
        self._log({"folder": folder, "counts": seen})

    def _log(self, entry: dict) -> None:
        files.write_text(self.spark, self._entry(), json.dumps(entry))
        self._logged += 1

    def _entry(self) -> str:
        return f"{self.out}/log/{self._logged:04d}"

    def _read_log(self, start: str | None) -> None:
        while files.exists(self.spark, self._entry()):
            entry = json.loads(files.read_text(self.spark, self._entry()))
            if "folder" in entry:
                self._done[entry["folder"]] = entry["counts"]
            elif entry["current"] != start:
                raise ValueError(f"the interrupted run started from {entry['current']!r}, not {start!r}")
            self._logged += 1

    def _observed(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation(stage)
        self._open.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))


def ingest_and_clean(
    spark: SparkSession,
    incoming: DataFrame,
    out: str,
    now: Column,
    order_by: list[str],
    current: dict[str, DataFrame] | str | None = None,
    only_new: bool = False,
) -> Run:
    """Ingest, then clean."""
    run = Run(spark, out, now, current)
    run.ingest(incoming, order_by)
    run.clean(only_new)
    run.commit()
    return run


def full_run(
    spark: SparkSession,
    incoming: DataFrame,
    out: str,
    now: Column,
    order_by: list[str],
    archive_path: str,
    archive_date: str,
    current: dict[str, DataFrame] | str | None = None,
    make_predictor: PredictorFactory | None = None,
    model_version: str = RULES_VERSION,
    only_new: bool = False,
    reset_first: bool = False,
    max_chars: int | None = None,
    partitions: int | None = None,
    resume: bool = False,
) -> Run:
    """All stages. Archive and cleaning both start from the raw table.

    ``reset_first`` redoes every extraction and note, also where cleaning kept them.
    ``resume`` goes on where a run with the same arguments was interrupted.
    """
    run = Run(spark, out, now, current, resume)
    run.ingest(incoming, order_by)
    run.archive(archive_path, archive_date)
    run.clean(only_new)
    if reset_first:
        run.reset()
    run.extract(make_predictor, model_version, max_chars, partitions)
    run.notes()
    run.commit()
    return run
