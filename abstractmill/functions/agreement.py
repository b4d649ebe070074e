"""Agreement of two records, field by field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LIST_FIELDS, RECORD, RECORD_FIELDS, TEXT_FIELDS
from .text import strip


def norm_text(value: Column) -> Column:
    """Trimmed and lower-cased; blank becomes null."""
    return F.nullif(F.lower(strip(value)), F.lit(""))


def _norm_set(values: Column) -> Column:
    folded = F.transform(F.coalesce(values, F.array().cast("array<string>")), norm_text)
    return F.array_sort(F.array_distinct(F.array_compact(folded)))


def sizes_close(value: Column, reference: Column) -> Column:
    """Within a tenth of ``reference`` or within one; null if a side is null.

    Whole-number arithmetic in a wide decimal: exact, and no overflow under ANSI.
    """
    wide = "decimal(20,0)"
    gap = F.abs(value.cast(wide) - reference.cast(wide))
    return (gap * 10 <= reference.cast(wide)) | (gap <= 1)


def field_matches(original: Column, final: Column) -> Column:
    """Struct of five booleans. Null agrees with null and with blank."""
    matches = {}
    for f in TEXT_FIELDS:
        matches[f] = norm_text(original[f]).eqNullSafe(norm_text(final[f]))
    for f in LIST_FIELDS:
        matches[f] = _norm_set(original[f]) == _norm_set(final[f])
    a, b = original["sample_size"], final["sample_size"]
    matches["sample_size"] = a.eqNullSafe(b) | F.coalesce(sizes_close(a, b), F.lit(False))
    return F.struct(*[matches[f].alias(f) for f in RECORD_FIELDS])


def differing_fields(matches: Column) -> Column:
    """Names of the fields that do not match, in record order."""
    return F.array_compact(F.array(*[F.when(~matches[f], F.lit(f)) for f in RECORD_FIELDS]))


def parse_record(json_text: Column) -> Column:
    """Record from JSON text; null text gives a record of nulls."""
    return F.from_json(F.coalesce(json_text, F.lit("{}")), RECORD)
