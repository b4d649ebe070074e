"""Human review: queue, statistics, and batches of decisions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.agreement import differing_fields, field_matches
from ..functions.plan import pin
from ..functions.text import csv_items, preview
from ..schemas import RECORD, RECORD_FIELDS


def review_queue(extractions: DataFrame, cleaned: DataFrame, notes: DataFrame) -> DataFrame:
    """Extractions with their abstract and, where there is one, their note."""
    return extractions.join(cleaned.select("pmid", "title", "abstract_text"), "pmid").join(
        notes.select("pmid", "summary_text"), "pmid", "left"
    )


def preview_queue(extractions: DataFrame, cleaned: DataFrame, notes: DataFrame) -> DataFrame:
    """The queue with previews instead of texts, which are cut before the join moves them."""
    short = with_previews(cleaned).select("pmid", "title_preview", "abstract_preview")
    return extractions.join(short, "pmid").join(
        notes.select("pmid", "summary_text"), "pmid", "left"
    )


def in_review_order(queue: DataFrame) -> DataFrame:
    """Unverified first, then least certain; unknown last. The key settles ties.

    Ending the sort with the unique key also lets the range partitioner cut through
    the few distinct scores. Follow with ``limit`` to get a top-k instead of a sort.
    """
    return queue.orderBy(
        F.col("human_verified").asc_nulls_last(),
        F.col("confidence_score").asc_nulls_last(),
        "pmid",
    )


def queue_page(
    queue: DataFrame, size: int, after: tuple[bool | None, float | None, str] | None = None
) -> DataFrame:
    """The next ``size`` rows of the queue in review order.

    ``after`` is (human_verified, confidence_score, pmid) of the last row of the page before, none for the
    first page. A page is a top-k over the rows behind the cursor: nothing is sorted whole, a deep page costs
    what the first one does, and rows that were added or reviewed since shift no page.
    """
    if after is not None:
        verified, score, key = after
        flag, mark = F.col("human_verified"), F.col("confidence_score")

        def beyond(column: Column, value) -> Column:
            """Later in an order that puts null last."""
            return F.lit(False) if value is None else column.isNull() | (column > F.lit(value))

        tied = mark.eqNullSafe(F.lit(score).cast("double"))
        queue = queue.where(
            beyond(flag, verified)
            | (flag.eqNullSafe(F.lit(verified).cast("boolean")) & (beyond(mark, score) | (tied & (F.col("pmid") > key))))
        )
    return in_review_order(queue).limit(size)


def filter_queue(
    queue: DataFrame, show_verified: bool = False, min_confidence: float = 0.0
) -> DataFrame:
    """Rows to show; an unknown flag is unverified and an unknown score is 0."""
    kept = F.coalesce("confidence_score", F.lit(0.0)) >= min_confidence
    if not show_verified:
        kept = kept & ~F.coalesce("human_verified", F.lit(False))
    return queue.where(kept)


def with_previews(queue: DataFrame) -> DataFrame:
    """Add the short title (always ending in ``...``) and abstract of a queue entry."""
    return queue.withColumns(
        {
            "title_preview": F.concat(F.substring("title", 1, 80), F.lit("...")),
            "abstract_preview": preview(F.col("abstract_text"), 500),
        }
    )


def edited_record(
    stage: Column, treatments: Column, biomarkers: Column, size: Column, cancer: Column
) -> Column:
    """Record from the reviewer's text fields."""
    return F.struct(
        F.nullif(stage, F.lit("")).alias("tnm_stage"),
        csv_items(treatments).alias("treatment_modality"),
        csv_items(biomarkers).alias("biomarkers"),
        F.when(size.rlike("^[0-9]+$"), size.try_cast("bigint")).alias("sample_size"),
        F.nullif(cancer, F.lit("")).alias("cancer_type"),
    )


def settle_decisions(decisions: DataFrame, order_by: Iterable[str]) -> DataFrame:
    """Net effect of all decisions on each key, as if applied in order.

    ``decisions`` has ``pmid, action, edited, notes`` and the ``order_by`` columns.
    The last approval or rejection sets flag and notes; the last approval that carries
    an edited record sets the record, even when a rejection follows; skips do nothing.
    A hot key is reduced in the map tasks before the shuffle.
    """
    order = F.struct(*order_by)
    acted = decisions.where(F.col("action").isin("approve", "reject"))
    edit_order = F.when(
        (F.col("action") == "approve") & F.col("edited").isNotNull(), order
    )
    return acted.groupBy("pmid").agg(
        F.max_by(
            F.struct(
                (F.col("action") == "approve").alias("verified"), F.col("notes").alias("notes")
            ),
            order,
        ).alias("__last"),
        F.max_by("edited", edit_order).alias("__edited"),
    )


def apply_reviews(
    extractions: DataFrame, decisions: DataFrame, order_by: Iterable[str]
) -> DataFrame:
    """Extraction table after a batch of decisions; unknown keys are ignored.

    A rejected row stays in the table: rejecting does not queue it for extraction.
    """
    settled = settle_decisions(decisions, order_by)
    decided = F.col("__last").isNotNull()
    changed = {
        "extracted": F.coalesce(F.col("__edited").cast(RECORD), F.col("extracted")),
        "human_verified": F.when(decided, F.col("__last.verified")).otherwise(
            F.col("human_verified")
        ),
        "reviewer_notes": F.when(decided, F.col("__last.notes")).otherwise(
            F.col("reviewer_notes")
        ),
    }
    return extractions.join(settled, "pmid", "left").select(
        *[changed.get(c, F.col(c)).alias(c) for c in extractions.columns]
    )


def dashboard_stats(extractions: DataFrame) -> DataFrame:
    """Total, verified, mean score to two decimals, verified share (null when empty)."""
    verified = F.count_if(F.col("human_verified"))
    mean = F.round(F.avg("confidence_score").cast("decimal(20,10)"), 2).cast("double")
    return extractions.agg(
        F.count(F.lit(1)).alias("total"),
        verified.alias("verified"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_confidence"),
        F.try_divide(verified.cast("double"), F.count(F.lit(1))).alias("verification_rate"),
    )


# Lowest score and name of each band, from the top.
BANDS = ((0.8, "High (0.8-1.0)"), (0.4, "Medium (0.4-0.8)"))
LOWEST_BAND = "Low (0.0-0.4)"


def confidence_bands(extractions: DataFrame) -> DataFrame:
    """Number of extractions per score band; an unknown score counts as low."""
    band = F.lit(LOWEST_BAND)
    for floor, label in reversed(BANDS):
        band = F.when(F.col("confidence_score") >= floor, label).otherwise(band)
    return (
        extractions.groupBy(band.alias("confidence_band"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("confidence_band")
    )


def verified_pairs(extractions: DataFrame) -> DataFrame:
    """Reviewed extractions that have a snapshot to compare with."""
    return extractions.where(F.col("human_verified") & F.col("original").isNotNull()).select(
        "pmid", "original", F.col("extracted").alias("final")
    )


def with_matches(pairs: DataFrame) -> DataFrame:
    """Add ``matches``, the per-field agreement of ``original`` and ``final``."""
    return pairs.withColumn("matches", field_matches(F.col("original"), F.col("final")))


def disagreements(pairs: DataFrame) -> DataFrame:
    """Pairs that differ somewhere, with the names of the differing fields."""
    matched = pin(pairs, "matches", field_matches(F.col("original"), F.col("final")))
    fields = differing_fields(F.col("matches"))
    return matched.withColumn("fields", fields).where(
        ~reduce(lambda a, b: a & b, [F.col("matches")[f] for f in RECORD_FIELDS])
    )


def top_disagreements(pairs: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` disagreements by key, for display."""
    return disagreements(pairs).orderBy("pmid").limit(n)


def field_agreement_rates(pairs: DataFrame) -> DataFrame:
    """Share of agreeing pairs per field, one pass; no rows for no pairs."""
    counts = (
        with_matches(pairs)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col("matches")[f]).alias(f) for f in RECORD_FIELDS],
        )
        .where(F.col("n") > 0)
    )
    return counts.unpivot("n", list(RECORD_FIELDS), "field", "agreed").select(
        "field",
        "agreed",
        "n",
        (F.col("agreed").cast("double") / F.col("n")).alias("agreement_rate"),
        F.round(F.col("agreed").cast("double") / F.col("n"), 4).alias("agreement_display"),
    )
