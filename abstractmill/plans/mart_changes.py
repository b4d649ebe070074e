"""Marts kept up to date from changes of the cleaned table.

Both marts are sums over the study base, so a change of the table is a change of the base: the counts
of the rows that come, minus those of the rows that go. Each change is stored as such a difference, some
counts by year, cancer type and journal; the base is the sum of all differences. The texts of
rows that a change leaves alone are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed_table import KeyedTable
from ..schemas import FLAG_TERMS
from ..sources import files
from . import models

DIMENSIONS = ("publication_year", "cancer_type", "journal")
MEASURES = ("studies", "total_length", *FLAG_TERMS, "chemoradiation")
_SCHEMA = "publication_year int, cancer_type string, journal string, " + ", ".join(f"{m} bigint" for m in MEASURES)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*DIMENSIONS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])


def base_change(removed: DataFrame | None, added: DataFrame | None) -> DataFrame:
    """Difference of the study base when cleaned rows go and others come; groups that do not change are left out."""
    parts = [
        models.study_base(models.flagged(models.staged(rows))).select(
            *DIMENSIONS, *[(sign * F.col(m)).cast("bigint").alias(m) for m in MEASURES]
        )
        for rows, sign in ((removed, -1), (added, 1))
        if rows is not None
    ]
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    changed = " or ".join(f"{m} <> 0" for m in MEASURES)
    return _summed(whole).where(changed)


class MartLedger:
    """Differences of the study base under ``path``, one folder per change.

    A change has an id of the caller's choice. One that is recorded already is not recorded again, so
    a run that was interrupted between recording a change and applying it repeats both safely.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, change: str) -> str:
        return f"{self.path}/change={change}"

    def recorded(self, change: str) -> bool:
        return files.committed(self.spark, self._folder(change))

    def record(self, change: str, removed: DataFrame | None, added: DataFrame | None) -> None:
        """Store the difference that this change makes."""
        if not self.recorded(change):
            base_change(removed, added).write.mode("overwrite").parquet(self._folder(change))

    def base(self) -> DataFrame:
        """The study base after all changes; groups without a study left are gone."""
        done = [f for f in files.folders(self.spark, self.path) if files.committed(self.spark, f)]
        if not done:
            return self.spark.createDataFrame([], _SCHEMA)
        return _summed(self.spark.read.schema(_SCHEMA).parquet(*done)).where("studies <> 0")

    def marts(self) -> dict[str, DataFrame]:
        base = self.base()
        return {
            "mart_cancer_studies": models.mart_cancer_studies(base),
            "mart_treatment_outcomes": models.mart_treatment_outcomes(base),
        }


def replace_rows(table: KeyedTable, ledger: MartLedger, change: str, batch: DataFrame) -> None:
    """Replace rows of a cleaned table by key and record what that does to the marts.

    Old rows are read from the buckets that the batch has keys of. The batch has unique keys; hand in
    a stored one where it is costly to compute.
    """
    ledger.record(change, table.matching(batch), batch)
    table.replace(batch)


def delete_rows(table: KeyedTable, ledger: MartLedger, change: str, keys: DataFrame) -> None:
    """Delete rows of a cleaned table by key and record what that does to the marts."""
    ledger.record(change, table.matching(keys), None)
    table.delete(keys)
