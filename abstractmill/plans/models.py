"""Analytic models: staged abstracts, flagged abstracts, and two marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any
from ..operators.cleaning import MIN_ABSTRACT
from ..schemas import FLAG_TERMS, OTHER_CANCER_TYPE, SUBJECT_CANCER_TYPES


def staged(cleaned: DataFrame) -> DataFrame:
    """Renamed columns, publication year and text length of usable abstracts."""
    return stage_columns(cleaned.where(F.length("abstract_text") > MIN_ABSTRACT))


def stage_columns(cleaned: DataFrame) -> DataFrame:
    """The columns of ``staged`` for all rows."""
    return cleaned.select(
        F.col("pmid").alias("abstract_id"),
        "pmid",
        "title",
        "abstract_text",
        "authors",
        F.col("pub_date").alias("publication_date"),
        F.year("pub_date").alias("publication_year"),
        "mesh_terms",
        "journal",
        F.length("abstract_text").alias("abstract_length"),
        "cleaned_at",
    )


def _any_term_has(fragment: str):
    return F.exists("mesh_terms", lambda term: F.lower(term).contains(fragment))


def flagged(stg: DataFrame) -> DataFrame:
    """Cancer type from subject terms and six mention flags from the text."""
    cancer = F.lit(OTHER_CANCER_TYPE)
    for fragment, label in reversed(SUBJECT_CANCER_TYPES.items()):
        cancer = F.when(_any_term_has(fragment), label).otherwise(cancer)
    kept = [
        "abstract_id", "pmid", "title", "abstract_text", "publication_date",
        "publication_year", "journal", "mesh_terms", "abstract_length",
    ]
    return stg.withColumn("__lower", F.lower("abstract_text")).select(
        *kept,
        cancer.alias("cancer_type"),
        *[
            contains_any(F.col("__lower"), terms).alias(flag)
            for flag, terms in FLAG_TERMS.items()
        ],
    )


def study_base(parsed: DataFrame) -> DataFrame:
    """Additive counts by year, cancer type and journal.

    Both marts are sums over this, so the texts are read once however many marts are
    built, and what a shuffle carries is the number of groups. The null test is on the
    date, not on the derived year, so that it reaches the file scan.
    """
    flags = {flag: F.count_if(F.col(flag)).alias(flag) for flag in FLAG_TERMS}
    return (
        parsed.where(F.col("publication_date").isNotNull())
        .groupBy("publication_year", "cancer_type", "journal")
        .agg(
            F.count(F.lit(1)).alias("studies"),
            F.sum("abstract_length").alias("total_length"),
            *flags.values(),
            F.count_if(
                F.col("mentions_chemotherapy") & F.col("mentions_radiation")
            ).alias("chemoradiation"),
        )
    )


def mart_cancer_studies(base: DataFrame) -> DataFrame:
    """Studies, mean length and mention counts by year, cancer type and journal."""
    return base.select(
        "publication_year",
        "cancer_type",
        "journal",
        F.col("studies").alias("study_count"),
        (F.col("total_length").cast("double") / F.col("studies")).alias("avg_abstract_length"),
        F.col("mentions_ebv").alias("ebv_studies"),
        F.col("mentions_pdl1").alias("pdl1_studies"),
        F.col("mentions_p53").alias("p53_studies"),
        F.col("mentions_chemotherapy").alias("chemo_studies"),
        F.col("mentions_radiation").alias("radiation_studies"),
        F.col("mentions_immunotherapy").alias("immunotherapy_studies"),
    ).orderBy(F.desc("publication_year"), F.desc("study_count"))


def mart_treatment_outcomes(base: DataFrame) -> DataFrame:
    """Treatment counts and shares and biomarker counts by year and cancer type."""
    total = F.sum("studies")

    def share(flag: str):
        percent = F.sum(flag).cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)")
        return F.round(percent, 1).cast("double")

    return (
        base.groupBy("publication_year", "cancer_type")
        .agg(
            total.alias("total_abstracts"),
            F.sum("mentions_chemotherapy").alias("chemo_count"),
            F.sum("mentions_radiation").alias("radiation_count"),
            F.sum("mentions_immunotherapy").alias("immunotherapy_count"),
            F.sum("chemoradiation").alias("chemoradiation_count"),
            share("mentions_chemotherapy").alias("chemo_pct"),
            share("mentions_radiation").alias("radiation_pct"),
            share("mentions_immunotherapy").alias("immunotherapy_pct"),
            F.sum("mentions_ebv").alias("ebv_mentions"),
            F.sum("mentions_pdl1").alias("pdl1_mentions"),
        )
        .orderBy(F.desc("publication_year"), F.desc("total_abstracts"))
    )


def build_models(cleaned: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write both marts under ``path``; staged and flagged abstracts stay lazy views.

    The base is written first and read back: it is tiny, and the marts then cost no
    second pass over the texts.
    """
    spark = cleaned.sparkSession
    stg = staged(cleaned)
    parsed = flagged(stg)
    study_base(parsed).write.mode("overwrite").parquet(f"{path}/study_base")
    base = spark.read.parquet(f"{path}/study_base")
    marts = {
        "mart_cancer_studies": mart_cancer_studies(base),
        "mart_treatment_outcomes": mart_treatment_outcomes(base),
    }
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{path}/{name}")
    stg.createOrReplaceTempView("stg_abstracts")
    parsed.createOrReplaceTempView("int_abstracts_parsed")
    return {
        "stg_abstracts": stg,
        "int_abstracts_parsed": parsed,
        **{name: spark.read.parquet(f"{path}/{name}") for name in marts},
    }
