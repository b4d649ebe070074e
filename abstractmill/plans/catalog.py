"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.agreement import parse_record
from ..functions.dates import publication_date
from ..functions.lexicon import labels_in, terms_in
from ..functions.model_output import build_prompt
from ..functions.plan import spread
from ..functions.rules import confidence
from ..functions.text import last_sentence, normalize
from ..operators import evaluation, keyed, quality, review
from ..operators.cleaning import MIN_ABSTRACT, clean_abstracts, parse_payload
from ..operators.extraction import (
    extract,
    needs_notes,
    unprocessed,
    with_model,
    with_rules,
    write_notes,
)
from ..operators.keyed_table import KeyedTable
from ..schemas import (
    BIOMARKER_TERMS,
    LIST_FIELDS,
    OTHER_CANCER_TYPE,
    RECORD_FIELDS,
    SUBJECT_CANCER_TYPES,
    TREATMENT_TERMS,
)
from ..sources.archive import read_archive, shared_dir, stored, write_archive
from ..sources.articles import article_lines, read_articles, rejected_articles
from ..sources.tables import key_bounds, key_ranges
from ..streaming.decisions import review_stream as start_review_stream
from . import fixtures as fx
from . import mart_changes, models
from .stages import compact_state, full_run, open_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def NOW() -> Column:
    """The clock of every query, fixed so that results repeat."""
    return F.lit(fx.STAMP).cast("timestamp")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("run_")] = fn
    return fn


def _joined(values: Column) -> Column:
    return F.array_join(F.coalesce(values, F.array().cast("array<string>")), "|")


def _flat(record: str, prefix: str = "") -> list[Column]:
    """A record as plain columns; lists as text."""
    r = F.col(record)
    return [
        (_joined(r[f]) if f in LIST_FIELDS else r[f]).alias(prefix + f) for f in RECORD_FIELDS
    ]


# --- scans, cleaning ---------------------------------------------------------------


def _article_files(spark, sf) -> str:
    path = shared_dir(spark, "xml")
    fx.article_xml(spark, sf).write.text(path)
    return path


@query
def xml_articles(spark, sf):
    return read_articles(spark, _article_files(spark, sf)).select(
        "pmid", "title", "abstract_text", _joined(F.col("authors")).alias("authors"),
        "journal", "pub_date", _joined(F.col("mesh_terms")).alias("mesh_terms"),
    )


@query
def xml_rejects(spark, sf):
    lines = article_lines(spark, _article_files(spark, sf))
    return rejected_articles(lines).select("pmid", F.col("xml").contains(" & ").alias("bare_ampersand"))


@query
def pub_dates(spark, sf):
    date = publication_date(F.col("year"), F.col("month"), F.col("day"))
    return fx.date_parts(spark, sf).select(
        "pmid", date.alias("pub_date"), F.try_to_date(date).alias("valid_date")
    )


@query
def parse_raw(spark, sf):
    return parse_payload(fx.raw_records(spark, sf)).select(
        "pmid", "title", "abstract_text", _joined(F.col("authors")).alias("authors"),
        "journal", "pub_date", _joined(F.col("mesh_terms")).alias("mesh_terms"),
    )


@query
def normalize_text(spark, sf):
    return fx.table(spark, sf, "pages").select(
        "page_id", normalize(F.col("html")).alias("clean_text")
    )


def _plain(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "pmid", "title", "abstract_text", _joined(F.col("authors")).alias("authors"),
        "pub_date", _joined(F.col("mesh_terms")).alias("mesh_terms"), "journal",
    )


@query
def run_clean_abstracts(spark, sf):
    return _plain(clean_abstracts(fx.raw_records(spark, sf), NOW()))


@query
def archive_readback(spark, sf):
    path = shared_dir(spark, "archive")
    raw = stored(fx.raw_records(spark, sf), shared_dir(spark, "raw"))
    write_archive(raw, path, "2024-05-31")
    write_archive(raw, path, "2024-06-01")
    write_archive(raw, path, "2024-06-01")
    day = read_archive(spark, path).where(
        F.col("archive_date") == F.lit("2024-06-01").cast("date")
    )
    dated = parse_payload(day).withColumn("archive_date", F.lit("2024-06-01").cast("date"))
    return dated.select("pmid", "archive_date", "title", "abstract_text", "journal")


# --- extraction, notes -------------------------------------------------------------


@query
def rule_extract(spark, sf):
    return with_rules(spread(fx.abstracts(spark, sf))).select("pmid", *_flat("extracted"))


@query
def extraction_confidence(spark, sf):
    scored = fx.pairs(spark, sf)
    return scored.select(
        "pmid",
        confidence(F.col("original")).alias("original_score"),
        confidence(F.col("final")).alias("final_score"),
    )


@query
def extraction_rows(spark, sf):
    rows = extract(spread(fx.abstracts(spark, sf)), NOW())
    return rows.select("pmid", *_flat("original"), "confidence_score", "model_version")


def _vocabulary(spark, sf, most: int = 20_000) -> list[str]:
    """The words of the benchmark as a vocabulary; its size is checked, since it goes to every task."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))
    held = fx.table(spark, sf, "benchmark").select(words.alias("term")).distinct().limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} terms")
    return sorted(r["term"] for r in held)


@query
def lexicon_many(spark, sf):
    found = terms_in(spark, F.lower("text"), _vocabulary(spark, sf))
    return fx.table(spark, sf, "documents").select("doc_id", found.alias("terms")).select(
        "doc_id", F.size("terms").cast("bigint").alias("n_terms"),
        F.array_join("terms", "|").alias("terms"),
    )


@query
def lexicon_labels(spark, sf):
    text = F.lower("abstract_text")
    return fx.abstracts(spark, sf).select(
        "pmid",
        _joined(labels_in(spark, text, TREATMENT_TERMS)).alias("treatment_modality"),
        _joined(labels_in(spark, text, BIOMARKER_TERMS)).alias("biomarkers"),
    )


@query
def prompts(spark, sf):
    return fx.abstracts(spark, sf).select(
        "pmid", build_prompt(F.col("abstract_text")).alias("prompt")
    )


@query
def model_output_parse(spark, sf):
    return with_model(spread(fx.model_outputs(spark, sf)), "raw_output").select(
        "pmid", *_flat("extracted")
    )


def stub_predictor():
    """A predictor factory that answers by prompt length: a record, prose, or rarely a failure.

    The factory is a local function, so it travels to the workers by value.
    """

    def make():
        def predict(prompts):
            out = []
            for p in prompts:
                if len(p) % 300 == 0:
                    raise ValueError("no answer")
                out.append("nothing" if len(p) % 3 == 1 else '{"sample_size": %d}' % len(p))
            return out

        return predict

    return make


@query
def batch_inference(spark, sf):
    rows = extract(
        fx.abstracts(spark, sf),
        NOW(),
        make_predictor=stub_predictor(),
        model_version="stub",
        with_reader=True,
    )
    return rows.select(
        "pmid", *_flat("extracted"), "confidence_score", "model_version", "read_by"
    )


@query
def inference_distinct(spark, sf):
    rows = extract(
        fx.abstracts(spark, sf),
        NOW(),
        make_predictor=stub_predictor(),
        model_version="stub",
        with_reader=True,
        distinct_prompts=True,
    )
    return rows.select(
        "pmid", *_flat("extracted"), "confidence_score", "model_version", "read_by"
    )


@query
def key_findings(spark, sf):
    return fx.abstracts(spark, sf).select(
        "pmid", last_sentence(F.col("abstract_text")).alias("key_finding")
    )


@query
def notes(spark, sf):
    rows = write_notes(with_rules(spread(fx.abstracts(spark, sf))), NOW())
    return rows.select("pmid", "summary_text", "model_version")


# --- keyed tables ------------------------------------------------------------------


@query
def run_unprocessed(spark, sf):
    rows = unprocessed(fx.abstracts(spark, sf), fx.extractions(spark, sf))
    return rows.select("pmid", "title", F.length("abstract_text").cast("bigint").alias("n_chars"))


@query
def new_keys(spark, sf):
    return keyed.new_keys(
        fx.abstracts(spark, sf).select("pmid"), fx.label_raw(spark, sf)
    )


@query
def run_needs_notes(spark, sf):
    rows = needs_notes(
        fx.extractions(spark, sf), fx.abstracts(spark, sf), fx.notes(spark, sf)
    )
    return rows.select("pmid", "abstract_text", *_flat("extracted"))


@query
def insert_if_absent(spark, sf):
    batch = fx.turn_batch(spark, sf)
    return keyed.insert_if_absent(fx.label_raw(spark, sf), batch, ["arrival"])


@query
def replace_by_key(spark, sf):
    return _plain(
        keyed.replace_by_key(fx.abstracts(spark, sf), fx.page_abstracts(spark, sf))
    )


@query
def cascade_delete(spark, sf):
    left = keyed.delete_keys(fx.extractions(spark, sf), fx.page_abstracts(spark, sf))
    return left.select("pmid", *_flat("extracted"), "confidence_score", "human_verified")


@query
def upsert_extractions(spark, sf):
    batch = stored(
        extract(fx.page_abstracts(spark, sf), NOW(), model_version="v1"),
        shared_dir(spark, "batch"),
    )
    rows = keyed.upsert_extractions(fx.extractions(spark, sf), batch)
    return rows.select(
        "pmid", *_flat("extracted"), *_flat("original", "original_"), "confidence_score",
        "model_version", "human_verified", "reviewer_notes",
    )


@query
def upsert_notes(spark, sf):
    waiting = fx.extractions(spark, sf).join(
        fx.abstracts(spark, sf).select("pmid", "abstract_text"), "pmid"
    )
    batch = stored(write_notes(waiting, NOW(), "v1"), shared_dir(spark, "batch"))
    rows = keyed.upsert_notes(fx.notes(spark, sf), batch)
    return rows.select("pmid", "summary_text", "model_version")


def _keyed(spark, rows: DataFrame) -> KeyedTable:
    return KeyedTable.create(spark, shared_dir(spark, "keyed"), rows)


@query
def bucketed_replace(spark, sf):
    table = _keyed(spark, fx.abstracts(spark, sf))
    table.replace(fx.page_abstracts(spark, sf))
    return _plain(KeyedTable.open(spark, table.path).rows())


@query
def bucketed_delete(spark, sf):
    table = _keyed(spark, fx.extractions(spark, sf))
    table.delete(fx.page_abstracts(spark, sf))
    return table.rows().select("pmid", *_flat("extracted"), "confidence_score", "human_verified")


@query
def bucketed_insert(spark, sf):
    table = _keyed(spark, fx.label_raw(spark, sf))
    table.insert_if_absent(fx.turn_batch(spark, sf), ["arrival"])
    return table.rows()


@query
def bucketed_upsert_extractions(spark, sf):
    batch = stored(
        extract(fx.page_abstracts(spark, sf), NOW(), model_version="v1"),
        shared_dir(spark, "batch"),
    )
    table = _keyed(spark, fx.extractions(spark, sf))
    table.upsert(batch, first_wins=["original"], defaults={"human_verified": F.lit(False)})
    return table.rows().select(
        "pmid", *_flat("extracted"), *_flat("original", "original_"), "confidence_score",
        "model_version", "human_verified", "reviewer_notes",
    )


@query
def bucketed_upsert_notes(spark, sf):
    waiting = fx.extractions(spark, sf).join(
        fx.abstracts(spark, sf).select("pmid", "abstract_text"), "pmid"
    )
    batch = stored(write_notes(waiting, NOW(), "v1"), shared_dir(spark, "batch"))
    table = _keyed(spark, fx.notes(spark, sf))
    table.upsert(batch)
    return table.rows().select("pmid", "summary_text", "model_version")


@query
def candidate_cap(spark, sf):
    order = [F.col("pub_date").desc_nulls_last(), F.col("pmid")]
    return keyed.capped(fx.abstracts(spark, sf), 100, order).select("pmid", "title", "pub_date")


@query
def key_range_rows(spark, sf):
    keys = fx.abstracts(spark, sf).select("pmid")
    bounds = key_bounds(keys, 8)
    parts = [
        keys.where(condition).select("pmid", F.lit(i).alias("part"))
        for i, condition in enumerate(key_ranges(bounds))
    ]
    # Each key comes once, and the ranges follow each other as the keys do.
    rows = quality.report(*parts)
    spans = rows.groupBy("part").agg(F.min("pmid").alias("low"), F.max("pmid").alias("high"))
    after = spans.select((F.col("part") + 1).alias("part"), F.col("high").alias("before"))
    ordered = spans.join(after, "part", "left").select(
        "part", (F.coalesce("before", F.lit("")) < F.col("low")).alias("in_order")
    )
    return rows.join(ordered, "part").select("pmid", "in_order")


@query
def reset_outputs(spark, sf):
    def counted(df: DataFrame, state: str) -> DataFrame:
        return df.select(F.lit(state).alias("state"))

    tables = [fx.notes(spark, sf), fx.extractions(spark, sf)]
    rows = [counted(t, "before") for t in tables]
    rows += [counted(keyed.reset(t), "after") for t in tables]
    n = lambda state: F.count_if(F.col("state") == state).alias(f"rows_{state}")
    return quality.report(*rows).agg(n("before"), n("after"))


@query
def backfill_original(spark, sf):
    rows = keyed.backfill_original(fx.extractions(spark, sf))
    return rows.select("pmid", *_flat("original", "original_"))


@query
def stage_counts(spark, sf):
    run = full_run(
        spark,
        fx.raw_records(spark, sf),
        shared_dir(spark, "run"),
        NOW(),
        ["fetched_at", "raw_json"],
        shared_dir(spark, "archive"),
        "2024-06-01",
    )
    return run.counters()


@query
def run_run_state(spark, sf):
    out = shared_dir(spark, "run")
    full_run(
        spark,
        stored(fx.raw_records(spark, sf), shared_dir(spark, "raw")),
        out,
        NOW(),
        ["fetched_at"],
        shared_dir(spark, "archive"),
        "2024-06-01",
    )
    opened = open_state(spark, out)
    noted = opened["notes"].select("pmid", F.col("model_version").alias("note_version"))
    return opened["extractions"].join(noted, "pmid").select(
        "pmid", *_flat("extracted"), "confidence_score", "human_verified", "note_version"
    )


@query
def state_of_runs(spark, sf):
    """Two runs, the second on the state that the first one left, whose folders are merged then."""
    raw = stored(fx.raw_records(spark, sf), shared_dir(spark, "raw"))
    folder = None
    for part in range(2):
        out = shared_dir(spark, "run")
        full_run(
            spark,
            raw.where(F.col("pmid").cast("bigint") % 2 <= part),
            out,
            NOW(),
            ["fetched_at"],
            shared_dir(spark, "archive"),
            "2024-06-01",
            folder,
            only_new=True,
        )
        folder = out
    packed = shared_dir(spark, "run")
    compact_state(spark, folder, packed, fan_in=2)
    opened = open_state(spark, packed)
    noted = opened["notes"].select("pmid", F.col("model_version").alias("note_version"))
    return opened["extractions"].join(noted, "pmid").select(
        "pmid", *_flat("extracted"), "confidence_score", "human_verified", "note_version"
    )


# --- review ------------------------------------------------------------------------


def _queue(spark, sf) -> DataFrame:
    return review.preview_queue(
        fx.extractions(spark, sf), fx.abstracts(spark, sf), fx.notes(spark, sf)
    )


def _queue_columns() -> list:
    return [
        "pmid", "title_preview", "abstract_preview", *_flat("extracted"),
        "confidence_score", "human_verified", "reviewer_notes", "summary_text",
    ]


@query
def review_queue(spark, sf):
    return review.in_review_order(_queue(spark, sf)).select(
        *_queue_columns()
    )


@query
def review_queue_page(spark, sf):
    """The second page of 50 rows, from the cursor that the first one ends with."""
    queue = _queue(spark, sf).select(*_queue_columns())
    last = review.queue_page(queue, 50).select("human_verified", "confidence_score", "pmid").collect()
    return review.queue_page(queue, 50, after=tuple(last[-1]) if last else None)


@query
def review_queue_filtered(spark, sf):
    shown = review.filter_queue(_queue(spark, sf), show_verified=False, min_confidence=0.4)
    return shown.select(*_queue_columns())


@query
def review_edits(spark, sf):
    edited = review.edited_record(
        F.col("event_type"),
        F.concat("event_type", F.lit(" , ,  x,"), F.col("event_id").cast("string")),
        F.when(F.col("value") > 20, F.concat(F.lit(" a,"), "event_type")),
        F.when(F.col("event_id") % 3 == 0, "12 ").otherwise(
            F.col("value").cast("bigint").cast("string")
        ),
        F.when(F.col("user_id") % 2 == 0, "").otherwise(F.lit("Lung Cancer")),
    )
    return fx.table(spark, sf, "events").select("event_id", edited.alias("r")).select(
        "event_id", *_flat("r")
    )


@query
def apply_reviews(spark, sf):
    rows = review.apply_reviews(
        fx.extractions(spark, sf), fx.decisions(spark, sf), ["decided_at", "seq"]
    )
    return rows.select(
        "pmid", *_flat("extracted"), *_flat("original", "original_"), "human_verified",
        "reviewer_notes",
    )


@query
def review_stream(spark, sf):
    """Decisions in shuffled files, a few per micro-batch; the stream is stopped and started again."""
    table = _keyed(spark, fx.extractions(spark, sf))
    incoming, checkpoint = shared_dir(spark, "decisions"), shared_dir(spark, "checkpoint")
    decisions = fx.decisions(spark, sf).withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(2)))
    for part in range(2):
        later = decisions.where(F.col("part") == part).drop("part")
        later.repartition(4).write.mode("append").parquet(incoming)
        start_review_stream(spark, incoming, table, checkpoint, max_files=3).awaitTermination()
    return table.rows().select(
        "pmid", *_flat("extracted"), *_flat("original", "original_"), "human_verified",
        "reviewer_notes",
    )


@query
def dashboard_stats(spark, sf):
    return review.dashboard_stats(fx.extractions(spark, sf))


@query
def confidence_bands(spark, sf):
    return review.confidence_bands(fx.extractions(spark, sf))


@query
def verified_pairs(spark, sf):
    return review.verified_pairs(fx.extractions(spark, sf)).select(
        "pmid", *_flat("original", "original_"), *_flat("final", "final_")
    )


@query
def field_agreement(spark, sf):
    return review.with_matches(fx.pairs(spark, sf)).select(
        "pmid", *[F.col("matches")[f].alias(f"{f}_match") for f in RECORD_FIELDS]
    )


@query
def field_agreement_rates(spark, sf):
    pairs = review.verified_pairs(fx.extractions(spark, sf))
    return review.field_agreement_rates(pairs).select("field", "agreed", "n", "agreement_rate")


@query
def disagreements(spark, sf):
    return review.disagreements(fx.pairs(spark, sf)).select(
        "pmid", _joined(F.col("fields")).alias("fields")
    )


@query
def disagreements_top5(spark, sf):
    return review.top_disagreements(fx.pairs(spark, sf)).select(
        "pmid", _joined(F.col("fields")).alias("fields")
    )


@query
def record_json(spark, sf):
    stored = fx.extractions(spark, sf).select("pmid", F.to_json("original").alias("json"))
    return stored.select("pmid", parse_record(F.col("json")).alias("r")).select(
        "pmid", *_flat("r")
    )


# --- evaluation --------------------------------------------------------------------


def _metrics(spark, sf, fields, columns) -> DataFrame:
    pairs = evaluation.pair_by_key(fx.predictions(spark, sf), fx.gold(spark, sf))
    rows = evaluation.validation_metrics(pairs)
    return rows.where(F.col("field").isin(*fields)).select("field", *columns)


@query
def validation_metrics_scalar(spark, sf):
    return _metrics(
        spark, sf, ("tnm_stage", "cancer_type"), ["tp", "fp", "fn", "precision", "recall", "f1"]
    )


@query
def validation_metrics_list(spark, sf):
    return _metrics(
        spark, sf, LIST_FIELDS, ["tp", "fp", "fn", "precision", "recall", "f1"]
    )


@query
def validation_metrics_size(spark, sf):
    return _metrics(spark, sf, ("sample_size",), ["n", "correct", "accuracy"])


@query
def validation_run_log(spark, sf):
    pairs = evaluation.pair_by_key(fx.predictions(spark, sf), fx.gold(spark, sf))
    path = shared_dir(spark, "validation_runs")
    run = evaluation.validation_run(
        evaluation.validation_metrics(pairs), "run-1", NOW(), "v0", pairs.count()
    )
    for _ in range(2):  # a run that is written again replaces itself
        evaluation.append_run(run, path)
    return evaluation.read_runs(spark, path).select(
        "run_id", "model_version", "field", "tp", "n", "correct", "sample_size"
    )


# --- models, quality ---------------------------------------------------------------


@query
def stg_abstracts(spark, sf):
    stg = models.staged(fx.abstracts(spark, sf))
    return stg.select(
        "abstract_id", "pmid", "title", "publication_date",
        F.col("publication_year").cast("bigint").alias("publication_year"),
        _joined(F.col("mesh_terms")).alias("mesh_terms"), "journal",
        F.col("abstract_length").cast("bigint").alias("abstract_length"),
    )


@query
def abstract_flags(spark, sf):
    rows = models.flagged(models.staged(spread(fx.abstracts(spark, sf))))
    return rows.select("abstract_id", "cancer_type", *models.FLAG_TERMS)


def _year_first(mart: DataFrame) -> DataFrame:
    return mart.withColumn("publication_year", F.col("publication_year").cast("bigint"))


def _base(spark, sf) -> DataFrame:
    return models.study_base(models.flagged(models.staged(spread(fx.abstracts(spark, sf)))))


@query
def mart_cancer_studies(spark, sf):
    return _year_first(models.mart_cancer_studies(_base(spark, sf)))


@query
def mart_treatment_outcomes(spark, sf):
    return _year_first(models.mart_treatment_outcomes(_base(spark, sf)))


def _both_marts(marts: dict[str, DataFrame]) -> DataFrame:
    studies = marts["mart_cancer_studies"].select(
        F.lit("mart_cancer_studies").alias("model"), "publication_year", "cancer_type", "journal",
        F.col("study_count").alias("n"), F.col("chemo_studies").alias("chemo"),
    )
    outcomes = marts["mart_treatment_outcomes"].select(
        F.lit("mart_treatment_outcomes").alias("model"), "publication_year", "cancer_type",
        F.lit(None).cast("string").alias("journal"),
        F.col("total_abstracts").alias("n"), F.col("chemo_count").alias("chemo"),
    )
    return _year_first(studies.unionByName(outcomes))


@query
def built_models(spark, sf):
    return _both_marts(models.build_models(fx.abstracts(spark, sf), shared_dir(spark, "models")))


@query
def marts_after_change(spark, sf):
    """The marts after pages took the place of rows and labels were deleted, from the changes alone."""
    table = _keyed(spark, fx.abstracts(spark, sf))
    ledger = mart_changes.MartLedger(spark, shared_dir(spark, "ledger"))
    ledger.record("load", None, table.rows())
    mart_changes.replace_rows(table, ledger, "pages", fx.page_abstracts(spark, sf))
    mart_changes.delete_rows(table, ledger, "labels", fx.extractions(spark, sf))
    return _both_marts(ledger.marts())


@query
def dq_report(spark, sf):
    cleaned, ext = fx.abstracts(spark, sf), fx.extractions(spark, sf)
    stg = models.staged(cleaned)
    parsed = models.flagged(stg)
    base = models.study_base(parsed)
    types = [*SUBJECT_CANCER_TYPES.values(), OTHER_CANCER_TYPE]
    return quality.report(
        quality.check_table(cleaned, "cleaned", ["pmid", "pub_date"], "pmid"),
        quality.check_table(ext, "extractions", ["pmid", "confidence_score"], "pmid"),
        quality.check_table(
            stg, "stg_abstracts", ["abstract_id", "pmid", "abstract_text"], "abstract_id"
        ),
        quality.check_table(
            parsed, "int_abstracts_parsed", ["abstract_id"], "abstract_id",
            {"cancer_type": types},
        ),
        quality.check_table(
            models.mart_cancer_studies(base), "mart_cancer_studies",
            ["publication_year", "cancer_type"],
        ),
        quality.check_table(
            models.mart_treatment_outcomes(base), "mart_treatment_outcomes",
            ["publication_year", "cancer_type"],
        ),
        quality.check_table(
            fx.table(spark, sf, "conversations"), "conversations", ["conv_id", "text"],
            "conv_id", {"role": ["user", "assistant"]},
        ),
    )


@query
def dq_observed(spark, sf):
    """The report, with the checks of three layers counted while one narrow table is written."""
    flagged = models.flagged(models.stage_columns(spread(fx.abstracts(spark, sf))))
    usable = F.col("abstract_length") > MIN_ABSTRACT
    watched = quality.ObservedChecks(
        [
            *quality.row_checks("cleaned", {"pmid": "pmid", "pub_date": "publication_date"}),
            *quality.row_checks("stg_abstracts", ["abstract_id", "pmid", "abstract_text"], among=usable),
            *quality.row_checks(
                "int_abstracts_parsed", ["abstract_id"],
                {"cancer_type": [*SUBJECT_CANCER_TYPES.values(), OTHER_CANCER_TYPE]}, usable,
            ),
        ]
    )
    narrow = watched.on(flagged).drop("title", "abstract_text", "mesh_terms")
    facts = stored(narrow, shared_dir(spark, "facts"))
    base = models.study_base(facts.where(usable))
    every = F.lit(True)
    return quality.report(
        watched.report(spark),
        quality.check_unique(
            facts, "pmid",
            {
                "cleaned": ("pmid", every),
                "stg_abstracts": ("abstract_id", usable),
                "int_abstracts_parsed": ("abstract_id", usable),
            },
        ),
        quality.check_table(
            fx.extractions(spark, sf), "extractions", ["pmid", "confidence_score"], "pmid"
        ),
        quality.check_table(
            models.mart_cancer_studies(base), "mart_cancer_studies",
            ["publication_year", "cancer_type"],
        ),
        quality.check_table(
            models.mart_treatment_outcomes(base), "mart_treatment_outcomes",
            ["publication_year", "cancer_type"],
        ),
        quality.check_table(
            fx.table(spark, sf, "conversations"), "conversations", ["conv_id", "text"],
            "conv_id", {"role": ["user", "assistant"]},
        ),
    )


@query
def dq_foreign_keys(spark, sf):
    cleaned, ext = fx.abstracts(spark, sf), fx.extractions(spark, sf)
    return quality.report(
        quality.check_reference(ext, cleaned, "extractions"),
        quality.check_reference(fx.notes(spark, sf), cleaned, "notes"),
        quality.check_reference(fx.notes(spark, sf), ext, "notes_without_extraction"),
        quality.check_reference(fx.turn_batch(spark, sf), ext, "turns_without_extraction"),
    )
