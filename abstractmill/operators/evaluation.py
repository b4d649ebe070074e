"""Precision, recall, F1 and accuracy of predicted records against gold records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.agreement import sizes_close
from ..schemas import LIST_FIELDS, TEXT_FIELDS, VALIDATION_RUNS, conform
from .keyed import one_row_per_key


def pair_by_key(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Predicted and gold record of each key both tables have.

    A key that comes twice in either table is an error: its pairs would count twice.
    """
    for table in (predictions, gold):
        one_row_per_key(table)
    return predictions.select("pmid", F.col("record").alias("pred")).join(
        gold.select("pmid", F.col("record").alias("gold")), "pmid"
    )


def _text_counts(field: str) -> dict[str, Column]:
    p, g = F.col("pred")[field], F.col("gold")[field]
    has_p = F.coalesce(p != "", F.lit(False))
    has_g = F.coalesce(g != "", F.lit(False))
    same = has_p & has_g & F.coalesce(F.lower(p) == F.lower(g), F.lit(False))
    return {
        "tp": F.count_if(same),
        # A wrong value counts against precision only.
        "fp": F.count_if(has_p & ~same),
        "fn": F.count_if(has_g & ~has_p),
    }


def _list_counts(field: str) -> dict[str, Column]:
    def folded(record: str) -> Column:
        values = F.coalesce(F.col(record)[field], F.array().cast("array<string>"))
        return F.transform(values, F.lower)

    p, g = folded("pred"), folded("gold")
    total = lambda values: F.coalesce(F.sum(F.size(values)), F.lit(0)).cast("bigint")
    return {
        "tp": total(F.array_intersect(p, g)),
        "fp": total(F.array_except(p, g)),
        "fn": total(F.array_except(g, p)),
    }


def validation_counts(pairs: DataFrame) -> DataFrame:
    """One row with every count of every field: a single pass over the pairs."""
    p, g = F.col("pred")["sample_size"], F.col("gold")["sample_size"]
    columns = []
    for fields, counts in ((TEXT_FIELDS, _text_counts), (LIST_FIELDS, _list_counts)):
        for f in fields:
            columns.append(F.struct(*[c.alias(n) for n, c in counts(f).items()]).alias(f))
    sizes = F.struct(
        F.count_if(g.isNotNull()).alias("n"), F.count_if(sizes_close(p, g)).alias("correct")
    )
    return pairs.agg(*columns, sizes.alias("sample_size"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def validation_metrics(pairs: DataFrame) -> DataFrame:
    """One row per field: counts with exact ratios, and ratios to three decimals.

    Text and list fields carry precision, recall and F1; the sample size carries the
    accuracy over the ``n`` pairs with a gold size.
    """
    counts = validation_counts(pairs)
    long_null = F.lit(None).cast("bigint")
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            *[F.col(f)[c].alias(c) for c in ("tp", "fp", "fn")],
            long_null.alias("correct"),
            long_null.alias("n"),
        )
        for f in (*TEXT_FIELDS, *LIST_FIELDS)
    ]
    rows.append(
        F.struct(
            F.lit("sample_size").alias("field"),
            *[long_null.alias(c) for c in ("tp", "fp", "fn")],
            F.col("sample_size")["correct"].alias("correct"),
            F.col("sample_size")["n"].alias("n"),
        )
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = F.col("precision"), F.col("recall")
    scored = F.col("tp").isNotNull()
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumns(
            {
                "precision": F.when(scored, _ratio(tp, tp + fp)),
                "recall": F.when(scored, _ratio(tp, tp + fn)),
                "accuracy": F.when(
                    F.col("n").isNotNull(), _ratio(F.col("correct"), F.col("n"))
                ),
            }
        )
        .withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).when(scored, F.lit(0.0)))
        .withColumns(
            {f"{m}_display": F.round(m, 3) for m in ("precision", "recall", "f1", "accuracy")}
        )
    )


def validation_run(
    metrics: DataFrame,
    run_id: str,
    run_at: Column,
    model_version: str,
    sample_size: int | None = None,
) -> DataFrame:
    """Rows to append to the log of validation runs; ``sample_size`` is the run's pairs."""
    return conform(
        metrics.withColumns(
            {
                "run_id": F.lit(run_id),
                "run_at": run_at.cast("timestamp"),
                "model_version": F.lit(model_version),
                "sample_size": F.lit(sample_size),
            }
        ),
        VALIDATION_RUNS,
    )


def append_run(run: DataFrame, path: str) -> None:
    """Add a run's rows to the log of runs; a run that is there already is replaced, not doubled.

    The log is partitioned by run, and only the partition of this run is written.
    """
    run.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The log of runs; a filter on ``run_id`` reads one run only."""
    return conform(spark.read.schema(VALIDATION_RUNS).parquet(path), VALIDATION_RUNS)
