"""Rule-based reading of clinical variables from an abstract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BIOMARKER_TERMS, TREATMENT_TERMS, empty_record
from .text import WS, contains_any

# Patterns for stage codes, worded stages and cohort sizes.
TNM_PATTERN = r"(T[0-4][a-b]?N[0-3]M[0-1])"
STAGE_PATTERN = r"(?iu)stage" + WS + r"+(I{1,3}V?[AB]?|[1-4][AB]?)"
SIZE_PATTERN = (
    r"(?iu)(\d{1,5})" + WS + r"*(?:patients|subjects|cases|participants|individuals)"
)
MIN_TEXT = 20
# Site -> cancer type and whether a word for a tumour must stand in the text too.
SITES = {
    "nasopharyngeal": ("Nasopharyngeal Carcinoma", False),
    "lung": ("Lung Cancer", True),
    "breast": ("Breast Cancer", True),
}
TUMOUR_WORDS = ["cancer", "carcinoma"]


def stage_code(text: Column) -> Column:
    """First TNM code, ``''`` without one; the pattern runs only where it can match."""
    return F.when(
        contains_any(text, ["M0", "M1"]), F.regexp_extract(text, TNM_PATTERN, 1)
    ).otherwise("")


def worded_stage(text: Column, lowered: Column) -> Column:
    """First worded stage, ``''`` without one; the pattern runs only where it can match."""
    return F.when(lowered.contains("tage"), F.regexp_extract(text, STAGE_PATTERN, 1)).otherwise(
        ""
    )


def labels(lowered: Column, lexicon: dict[str, list[str]]) -> Column:
    """Labels with a term in the text, in lexicon order.

    The nulls of absent labels are removed with a set difference: unlike a lambda filter
    it leaves the term searches inside generated code.
    """
    found = F.array(*[F.when(contains_any(lowered, t), F.lit(l)) for l, t in lexicon.items()])
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def cohort_size(text: Column, pattern: str = SIZE_PATTERN) -> Column:
    """First number right before a word for people (its last five digits), or ``''``."""
    return F.regexp_extract(text, pattern, 1)


def cancer_type(lowered: Column) -> Column:
    """The first of three tumour sites that the text names, else null."""
    tumour = contains_any(lowered, TUMOUR_WORDS)
    found = F.lit(None).cast("string")
    for site, (name, needs_tumour) in reversed(SITES.items()):
        named = lowered.contains(site)
        found = F.when(named & tumour if needs_tumour else named, name).otherwise(found)
    return found


def with_rule_record(
    df: DataFrame,
    text: str,
    into: str,
    treatments: dict[str, list[str]] = TREATMENT_TERMS,
    biomarkers: dict[str, list[str]] = BIOMARKER_TERMS,
    size_pattern: str = SIZE_PATTERN,
) -> DataFrame:
    """Add ``into``, the record the rules read from ``text``.

    Texts under ``MIN_TEXT`` characters, and null, give the empty record. Every search
    of the text is a column of its own before its result is used, so none runs twice.
    """
    kept = [F.col(c) for c in df.columns if c != into]
    t, low, code = F.col(text), F.col("__low"), F.col("__code")
    searched = df.select(*kept, F.lower(t).alias("__low"), stage_code(t).alias("__code")).select(
        *kept,
        code,
        F.when(code == "", worded_stage(t, low)).otherwise("").alias("__word"),
        cohort_size(t, size_pattern).alias("__size"),
        labels(low, treatments).alias("__treatments"),
        labels(low, biomarkers).alias("__biomarkers"),
        cancer_type(low).alias("__cancer"),
    )
    record = F.struct(
        F.when(code != "", code)
        .when(F.col("__word") != "", F.concat(F.lit("Stage "), F.upper("__word")))
        .alias("tnm_stage"),
        F.col("__treatments").alias("treatment_modality"),
        F.col("__biomarkers").alias("biomarkers"),
        F.col("__size").try_cast("bigint").alias("sample_size"),
        F.col("__cancer").alias("cancer_type"),
    )
    short = F.coalesce(F.length(t), F.lit(0)) < MIN_TEXT
    return searched.select(*kept, F.when(short, empty_record()).otherwise(record).alias(into))


def present(record: Column, field: str) -> Column:
    """Whether a field carries a value: null, ``''``, ``0`` and ``[]`` do not."""
    value = record[field]
    if field == "sample_size":
        filled = value != 0
    elif field in ("treatment_modality", "biomarkers"):
        filled = F.size(value) > 0
    else:
        filled = value != ""
    return F.coalesce(filled, F.lit(False))


def confidence(record: Column) -> Column:
    """Share of the five fields that carry a value."""
    fields = ("tnm_stage", "treatment_modality", "biomarkers", "sample_size", "cancer_type")
    return sum((present(record, f).cast("int") for f in fields), F.lit(0)) / F.lit(5.0)
