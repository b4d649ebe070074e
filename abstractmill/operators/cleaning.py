"""Raw JSON records to cleaned abstracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import pin
from ..functions.text import decode_entities, squeeze
from ..schemas import PAYLOAD

MIN_ABSTRACT = 10


def parse_payload(raw: DataFrame) -> DataFrame:
    """Expand ``raw_json`` once into typed columns; the row's own ``pmid`` is the key."""
    doc = F.from_json("raw_json", PAYLOAD)
    return raw.select("pmid", doc.alias("d")).select(
        "pmid", *[F.col("d")[f].alias(f) for f in PAYLOAD.fieldNames() if f != "pmid"]
    )


def clean_abstracts(raw: DataFrame, cleaned_at: Column | None = None) -> DataFrame:
    """Cleaned rows of every raw record whose abstract is longer than ten characters.

    Entities of all three texts are decoded in one Python step, everything else is
    native. The other texts are squeezed only for rows that stay. Missing lists stay null.
    """
    stamp = F.current_timestamp() if cleaned_at is None else cleaned_at
    texts = ("title", "abstract_text", "journal")
    decoded = parse_payload(raw).withColumns(
        {c: decode_entities(F.coalesce(c, F.lit(""))) for c in texts}
    )
    kept = pin(decoded, "abstract_text", squeeze(F.col("abstract_text"))).where(
        F.length("abstract_text") > MIN_ABSTRACT
    )
    return kept.select(
        "pmid",
        squeeze(F.col("title")).alias("title"),
        "abstract_text",
        "authors",
        F.try_to_date("pub_date").alias("pub_date"),
        "mesh_terms",
        squeeze(F.col("journal")).alias("journal"),
        stamp.cast("timestamp").alias("cleaned_at"),
    )
