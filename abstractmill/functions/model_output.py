"""Typed reading of free-form model output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LIST_FIELDS, RECORD, TEXT_FIELDS
from .text import strip

# Fixed value: the first flat JSON object in the output.
OBJECT_PATTERN = r"\{[^{}]*\}"
# Fixed value: text that counts as a whole number.
WHOLE_NUMBER_PATTERN = r"^[+-]?[0-9]+(_[0-9]+)*(\.0+)?$"

PROMPT_HEAD = (
    "Read the oncology abstract below and report its clinical variables as one JSON object "
    "with the keys tnm_stage (text or null), treatment_modality (list of text), biomarkers "
    "(list of text), sample_size (whole number or null) and cancer_type (text or null)."
    "\n\nAbstract: "
)
PROMPT_TAIL = "\n\nJSON:"


def build_prompt(text: Column, max_chars: int | None = None) -> Column:
    """Instruction plus the whole abstract, or its first ``max_chars`` for a model with a short window."""
    body = text if max_chars is None else F.substring(text, 1, max_chars)
    return F.concat(F.lit(PROMPT_HEAD), body, F.lit(PROMPT_TAIL))


def with_model_record(df: DataFrame, raw: str, into: str) -> DataFrame:
    """Add ``into``: the record in column ``raw``, or null where it is not a valid one.

    Types are checked per field on a VARIANT, since schema-driven JSON parsing would
    silently turn a number into text. One bad field rejects the whole record.
    """
    doc = f"__{into}_doc"
    kinds = f"__{into}_kinds"
    fields = f"__{into}_fields"
    kept = [F.col(c) for c in df.columns if c != into]
    span = F.regexp_extract(F.col(raw), OBJECT_PATTERN, 0)
    parsed = df.select(*kept, F.try_parse_json(F.nullif(span, F.lit(""))).alias(doc))
    typed = parsed.select(
        *kept,
        doc,
        F.struct(
            *[
                F.schema_of_variant(_get(doc, f, "variant")).alias(f)
                for f in RECORD.fieldNames()
            ]
        ).alias(kinds),
    )
    checked = typed.select(
        *kept,
        doc,
        F.struct(
            *[_text_field(doc, kinds, f).alias(f) for f in TEXT_FIELDS],
            *[_list_field(doc, kinds, f).alias(f) for f in LIST_FIELDS],
            _whole_number(doc, kinds, "sample_size").alias("sample_size"),
        ).alias(fields),
    )
    valid = F.col(doc).isNotNull()
    for f in RECORD.fieldNames():
        valid = valid & F.col(fields)[f]["ok"]
    record = F.struct(*[F.col(fields)[f]["value"].alias(f) for f in RECORD.fieldNames()])
    return checked.select(*kept, F.when(valid, record).alias(into))


def _get(doc: str, field: str, kind: str) -> Column:
    return F.try_variant_get(F.col(doc), f"$.{field}", kind)


def _field(value: Column, ok: Column) -> Column:
    return F.struct(value.alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))


def _text_field(doc: str, kinds: str, field: str) -> Column:
    kind = F.col(kinds)[field]
    value = F.when(kind == "STRING", _get(doc, field, "string"))
    return _field(value, kind.isNull() | kind.isin("VOID", "STRING"))


def _list_field(doc: str, kinds: str, field: str) -> Column:
    kind = F.col(kinds)[field]
    items = F.when(kind.startswith("ARRAY"), _get(doc, field, "array<string>"))
    ok = (
        kind.isNull()
        | ((kind == "ARRAY<VOID>") & (F.size(items) == 0))
        | ((kind == "ARRAY<STRING>") & ~F.exists(items, lambda x: x.isNull()))
    )
    return _field(F.coalesce(items, F.array().cast("array<string>")), ok)


def _whole_number(doc: str, kinds: str, field: str) -> Column:
    kind = F.col(kinds)[field]
    written = strip(_get(doc, field, "string"))
    digits = F.regexp_replace(F.regexp_replace(written, r"\.0+$", ""), "_", "")
    real = _get(doc, field, "double")
    value = (
        F.when(kind == "BIGINT", _get(doc, field, "bigint"))
        .when(kind == "BOOLEAN", _get(doc, field, "boolean").cast("bigint"))
        .when(
            (kind == "STRING") & written.rlike(WHOLE_NUMBER_PATTERN), digits.try_cast("bigint")
        )
        .when(
            kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
            F.when(real == F.floor(real), real.try_cast("bigint")),
        )
    )
    return _field(value, kind.isNull() | (kind == "VOID") | value.isNotNull())
