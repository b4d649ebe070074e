"""Declared data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "table_name string, check_name string, column_name string, failures bigint, passed boolean"


def check_table(
    df: DataFrame,
    name: str,
    not_null: Sequence[str] = (),
    unique: str | None = None,
    accepted: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Failures of all checks of one table, from one scan.

    ``not_null`` counts null rows, ``unique`` counts keys that occur more than once,
    ``accepted_values`` counts rows with another value; nulls only fail ``not_null``.
    With a unique check the row counts ride on its aggregation by key, which reduces
    repeated keys before the shuffle.
    """
    accepted = accepted or {}
    rows: dict[tuple[str, str], Column] = {}
    for c in not_null:
        rows["not_null", c] = F.count_if(F.col(c).isNull())
    for c, values in accepted.items():
        rows["accepted_values", c] = F.count_if(~F.col(c).isin(*values))
    names = {k: f"__f{i}" for i, k in enumerate(rows)}
    row_counts = [rows[k].alias(names[k]) for k in rows]
    if unique is None:
        totals = df.agg(*row_counts)
    else:
        per_key = df.groupBy(F.col(unique).alias("__key")).agg(
            F.count(F.lit(1)).alias("__n"), *row_counts
        )
        names["unique", unique] = "__unique"
        totals = per_key.agg(
            *[F.coalesce(F.sum(names[k]), F.lit(0)).alias(names[k]) for k in rows],
            F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1)).alias("__unique"),
        )
    report = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col(alias).cast("bigint").alias("failures"),
                (F.col(alias) == 0).alias("passed"),
            )
            for (check, column), alias in names.items()
        ]
    )
    return totals.select(F.inline(report))


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row: how it is reported, and when a row fails it."""

    table: str
    check: str
    column: str
    fails: Column


def row_checks(
    table: str,
    not_null: dict[str, str] | Sequence[str] = (),
    accepted: dict[str, Sequence[str]] | None = None,
    among: Column | None = None,
) -> list[RowCheck]:
    """The checks of ``check_table`` that need no other row.

    ``not_null`` may map reported names to columns; ``among`` limits the checks to the rows that the
    table has, where the frame that is written holds more.
    """
    named = not_null if isinstance(not_null, dict) else {c: c for c in not_null}
    found = [("not_null", name, F.col(c).isNull()) for name, c in named.items()]
    found += [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in (accepted or {}).items()]
    return [RowCheck(table, kind, c, fails if among is None else among & fails) for kind, c, fails in found]


class ObservedChecks:
    """Row checks that ride on a write: their failures are counted by the tasks that write the rows.

    ``on`` gives the frame to write (once); ``report`` the results after the write has ended.
    A task that is repeated is not counted twice.
    """

    def __init__(self, checks: Sequence[RowCheck]):
        self.checks = list(checks)
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self._seen, *[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(self.checks)]
        )

    def report(self, spark: SparkSession) -> DataFrame:
        counts = self._seen.get
        rows = [
            (c.table, c.check, c.column, counts[f"c{i}"], counts[f"c{i}"] == 0)
            for i, c in enumerate(self.checks)
        ]
        return spark.createDataFrame(rows, REPORT)


def check_unique(df: DataFrame, key: str, tables: dict[str, tuple[str, Column]]) -> DataFrame:
    """Keys that come more than once, for several tables that are parts of one frame.

    ``tables`` maps a table to the reported name of its key and the condition on its rows. One
    aggregate by key serves all; repeats are reduced in the map tasks.
    """
    counts = {name: F.count_if(rows).alias(f"__n{i}") for i, (name, (_, rows)) in enumerate(tables.items())}
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(*counts.values())
    totals = per_key.agg(*[F.count_if(F.col(f"__n{i}") > 1).alias(f"__n{i}") for i in range(len(tables))])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit("unique").alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(f"__n{i}").alias("failures"),
            (F.col(f"__n{i}") == 0).alias("passed"),
        )
        for i, (name, (column, _)) in enumerate(tables.items())
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_reference(
    child: DataFrame, parent: DataFrame, name: str, key: str = "pmid"
) -> DataFrame:
    """Child rows whose non-null key the parent lacks.

    Child keys are counted first, so a key that many rows share crosses the join once.
    """
    counts = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = counts.join(parent.select(key), key, "left_anti")
    return orphans.agg(
        F.lit(name).alias("table_name"),
        F.lit("foreign_key").alias("check_name"),
        F.lit(key).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("failures"),
        (F.count(F.lit(1)) == 0).alias("passed"),
    )


def report(*checks: DataFrame) -> DataFrame:
    """All results in one table."""
    return reduce(DataFrame.unionByName, checks)
