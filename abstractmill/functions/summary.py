"""Template notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import present
from .text import last_sentence


def _text_or(record: Column, field: str, default: str) -> Column:
    return F.when(present(record, field), record[field]).otherwise(default)


def _list_or(record: Column, field: str, default: str) -> Column:
    return F.when(present(record, field), F.array_join(record[field], ", ")).otherwise(default)


# The wording of notes.
SIZED = "This study examined %s patients with %s %s, treated with %s."
UNSIZED = "This study investigated %s (%s), with treatment involving %s."
MARKERS = "Biomarkers assessed: %s."
FINDING = "Key finding: %s."
NO_CANCER, NO_STAGE = "oncology condition", "unspecified stage"
NO_TREATMENT, NO_MARKERS = "unspecified treatment", "none reported"


def _filled(wording: str, *parts: Column) -> Column:
    """The wording with ``parts`` in it; null if a part is null."""
    whole = F.lit(True)
    for part in parts:
        whole = whole & part.isNotNull()
    return F.when(whole, F.format_string(wording, *parts))


def note_text(record: Column, text: Column) -> Column:
    """Two or three sentences on a record: cohort, biomarkers, key finding."""
    cancer = _text_or(record, "cancer_type", NO_CANCER)
    stage = _text_or(record, "tnm_stage", NO_STAGE)
    treatment = _list_or(record, "treatment_modality", NO_TREATMENT)
    biomarkers = _list_or(record, "biomarkers", NO_MARKERS)
    size = record["sample_size"].cast("string")
    return F.concat_ws(
        " ",
        F.when(
            present(record, "sample_size"), _filled(SIZED, size, stage, cancer, treatment)
        ).otherwise(_filled(UNSIZED, cancer, stage, treatment)),
        _filled(MARKERS, biomarkers),
        _filled(FINDING, last_sentence(text)),
    )
