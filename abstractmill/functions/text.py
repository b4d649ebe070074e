"""Text cleaning on columns."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space, as a regex class that
# reads the same in Java and RE2, and as the list that ``btrim`` takes.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
# The same class, faster, in a form only Java reads.
WS_RUN = r"(?U)[\s\x{1c}-\x{1f}]+"
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
# What ``html.unescape`` takes as one reference. It never spans an ``&`` that starts another one.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _reference_udf():
    # Built in a closure so that workers need no copy of this package.
    def decode(references: pa.Array) -> pa.Array:
        listed = references.cast(pa.list_(pa.string()))
        coded = listed.flatten().dictionary_encode()  # each distinct one is decoded once a batch
        decoded = pa.array(map(html.unescape, coded.dictionary.to_pylist()), pa.string())
        offsets = listed.offsets.to_numpy()
        return pa.ListArray.from_arrays(offsets - offsets[0], decoded.take(coded.indices))

    # Declared non-deterministic so that a later filter on the decoded text stays above
    # the Python step; Catalyst would otherwise push a copy of it below and decode twice.
    return F.arrow_udf(decode, "array<string>").asNondeterministic()


def decode_entities(text: Column) -> Column:
    """Decode named and numeric HTML entities.

    Spark has no entity table, so this is the one Python step of the cleaning plan. Only
    the references themselves travel to the Python worker, in the order they stand; the
    text between them stays, so that a worker's memory does not follow the length of the texts.
    """
    coded = text.contains("&")
    found = F.when(coded, F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    decoded = _reference_udf()(F.coalesce(found, F.array().cast("array<string>")))
    # One piece more than references: the last one has none behind it.
    pieces = F.zip_with(
        F.split(text, REFERENCE, -1), decoded, lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))
    )
    return F.when(coded, F.array_join(pieces, "")).otherwise(text)


def strip(text: Column) -> Column:
    """Trim every Unicode white-space character, not only blanks."""
    return F.btrim(text, F.lit(WS_CHARS))


def squeeze(text: Column) -> Column:
    """Drop tags and collapse white space to single blanks."""
    untagged = F.when(text.contains("<"), F.regexp_replace(text, "<[^>]+>", "")).otherwise(text)
    return F.trim(F.regexp_replace(untagged, WS_RUN, " "))


def normalize(text: Column) -> Column:
    """Decode entities, drop tags, collapse white space; null becomes ``''``.

    Entities are decoded first, so an escaped ``&lt;...&gt;`` is dropped as a tag too.
    """
    return squeeze(decode_entities(F.coalesce(text, F.lit(""))))


def contains_any(text: Column, terms: list[str]) -> Column:
    """True where ``text`` holds one of the literal ``terms``; null text is false.

    A chain of substring searches stops at the first hit and needs no regex engine. A term
    that contains another one adds no match and is not searched for.
    """
    found = F.lit(False)
    needed = [t for t in terms if not any(o in t for o in terms if o != t)]
    for term in reversed(needed):
        found = text.contains(term) | found
    return F.coalesce(found, F.lit(False))


def last_sentence(text: Column, min_text: int = 100, min_sentence: int = 20) -> Column:
    """Last ``.``-separated sentence longer than ``min_sentence``; null for short texts."""
    long_enough = F.filter(
        F.split(text, r"\."), lambda s: F.length(strip(s)) > min_sentence
    )
    return F.when(F.length(text) > min_text, strip(F.try_element_at(long_enough, F.lit(-1))))


def preview(text: Column, width: int) -> Column:
    """First ``width`` characters, with ``...`` only where something was cut."""
    text = F.coalesce(text, F.lit(""))
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)


def csv_items(text: Column) -> Column:
    """Items of a comma-separated field, trimmed, blanks dropped."""
    items = F.filter(
        F.transform(F.split(F.coalesce(text, F.lit("")), ","), strip), lambda s: s != ""
    )
    return items
