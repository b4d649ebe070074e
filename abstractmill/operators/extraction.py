"""Extraction of clinical records and notes from cleaned abstracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.model_output import with_model_record
from ..functions.rules import MIN_TEXT, confidence, with_rule_record
from ..functions.summary import note_text
from .inference import PredictorFactory, with_distinct_output, with_model_output
from .keyed import new_keys

RULES_VERSION = "rules-v1"
NOTES_VERSION = "template-v1"


def unprocessed(cleaned: DataFrame, extractions: DataFrame) -> DataFrame:
    """Abstracts without an extraction.

    The keys are compared alone; the texts meet only the keys that are left, which is
    a short list when most of the table has been processed.
    """
    missing = new_keys(cleaned.select("pmid"), extractions)
    return cleaned.join(missing, "pmid", "left_semi")


def with_rules(df: DataFrame, text: str = "abstract_text", into: str = "extracted") -> DataFrame:
    """Add the rule record of ``text``."""
    return with_rule_record(df, text, into)


def with_model(df: DataFrame, raw: str, text: str = "abstract_text") -> DataFrame:
    """Add ``extracted``, the validated model record, else the rule record, and ``read_by``.

    Texts under the minimum length get the empty record whatever the model says. The
    rules are handed null instead of the text where the model record stands, so they
    search only the texts they are needed for.
    """
    kept = [F.col(c) for c in df.columns]
    long_enough = F.coalesce(F.length(text), F.lit(0)) >= MIN_TEXT
    parsed = with_model_record(df, raw, "__parsed").select(
        *kept, F.when(long_enough, F.col("__parsed")).alias("__model")
    )
    left = parsed.select(
        *kept, "__model", F.when(F.col("__model").isNull(), F.col(text)).alias("__left")
    )
    by_model = F.when(F.col("__model").isNotNull(), "model").otherwise("rules")
    return with_rule_record(left, "__left", "__rules").select(
        *kept, F.coalesce("__model", "__rules").alias("extracted"), by_model.alias("read_by")
    )


def extract(
    abstracts: DataFrame,
    extracted_at: Column | None = None,
    make_predictor: PredictorFactory | None = None,
    model_version: str = RULES_VERSION,
    with_note: bool = False,
    max_chars: int | None = None,
    partitions: int | None = None,
    with_reader: bool = False,
    distinct_prompts: bool = False,
) -> DataFrame:
    """Extraction rows for every abstract: record, snapshot, score, version, time.

    ``with_note`` adds ``summary_text`` while the text is at hand, which saves the join
    of records and texts that writing notes later takes. ``with_reader`` adds
    ``read_by``: whether the ``model`` or the ``rules`` gave the record. ``max_chars`` goes to
    the inference; ``distinct_prompts`` asks the model once for texts that repeat.
    ``partitions`` spreads the texts (or distinct prompts) first, by a shuffle of them: for a
    slow model, and for files of few large row groups, which few tasks would read.
    """
    stamp = F.current_timestamp() if extracted_at is None else extracted_at
    source = abstracts.select("pmid", "abstract_text")
    if make_predictor is None:
        spread = source if partitions is None else source.repartition(partitions)
        read = with_rules(spread).withColumn("read_by", F.lit("rules"))
    else:
        ask = with_distinct_output if distinct_prompts else with_model_output
        read = with_model(ask(source, make_predictor, max_chars=max_chars, partitions=partitions), "model_output")
    note = note_text(F.col("extracted"), F.col("abstract_text")).alias("summary_text")
    return read.select(
        "pmid",
        "extracted",
        F.col("extracted").alias("original"),
        confidence(F.col("extracted")).alias("confidence_score"),
        F.lit(model_version).alias("model_version"),
        stamp.cast("timestamp").alias("extracted_at"),
        *([note] if with_note else []),
        *(["read_by"] if with_reader else []),
    )


def with_texts(waiting: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Records with their text."""
    return waiting.join(cleaned.select("pmid", "abstract_text"), "pmid")


def needs_notes(extractions: DataFrame, cleaned: DataFrame, notes: DataFrame) -> DataFrame:
    """Extractions without a note, with their text.

    The anti join comes first: both of its sides are narrow, and it leaves fewer keys
    for the join that carries the texts.
    """
    return with_texts(new_keys(extractions.select("pmid", "extracted"), notes), cleaned)


def note_rows(
    noted: DataFrame, generated_at: Column | None = None, version: str = NOTES_VERSION
) -> DataFrame:
    """Note rows from ``pmid`` and ``summary_text``."""
    stamp = F.current_timestamp() if generated_at is None else generated_at
    return noted.select(
        "pmid",
        "summary_text",
        F.lit(version).alias("model_version"),
        stamp.cast("timestamp").alias("generated_at"),
    )


def write_notes(
    waiting: DataFrame, generated_at: Column | None = None, version: str = NOTES_VERSION
) -> DataFrame:
    """Note rows for records with their text."""
    text = note_text(F.col("extracted"), F.col("abstract_text")).alias("summary_text")
    return note_rows(waiting.select("pmid", text), generated_at, version)
