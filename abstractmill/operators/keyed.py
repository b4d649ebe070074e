"""Keyed changes as ``target x batch -> new target``.

File tables take no MERGE, so every change is a join that yields the next state of
the table; the caller writes it as a new version. No join carries a broadcast hint:
Catalyst broadcasts a batch it knows to be under the session's threshold and otherwise
sort-merges, where adaptive execution splits hot partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "pmid"


def checked(batch: DataFrame, key: str = KEY) -> DataFrame:
    """Fail the job on a null key, as a primary key does."""
    null_key = F.raise_error(F.lit(f"null {key} in a keyed write")).cast("boolean")
    return batch.where(F.when(F.col(key).isNull(), null_key).otherwise(F.lit(True)))


def first_per_key(batch: DataFrame, order_by: Iterable[str], key: str = KEY) -> DataFrame:
    """Earliest row of each key.

    An aggregate, not a ranking window: copies of a hot key are reduced in each map
    task, so one key's share of the rows never lands in one task.
    """
    return _one_per_key(batch, F.min_by, order_by, key)


def last_per_key(batch: DataFrame, order_by: Iterable[str], key: str = KEY) -> DataFrame:
    """Latest row of each key, for a batch that updates a key more than once."""
    return _one_per_key(batch, F.max_by, order_by, key)


def _one_per_key(batch: DataFrame, pick, order_by: Iterable[str], key: str) -> DataFrame:
    # The key stays a grouping column, so a join on it reuses the aggregate's shuffle.
    rest = [c for c in batch.columns if c != key]
    chosen = pick(F.struct(*rest), F.struct(*order_by)).alias("__row")
    picked = [F.col(key) if c == key else F.col("__row")[c].alias(c) for c in batch.columns]
    return batch.groupBy(key).agg(chosen).select(*picked)


def new_keys(candidates: DataFrame, existing: DataFrame, key: str = KEY) -> DataFrame:
    """Candidate rows whose key the existing table lacks.

    ``existing`` is a table with unique keys; ``candidates`` may repeat keys, and a hot
    one is the side that adaptive execution splits.
    """
    return candidates.join(existing.select(key), key, "left_anti")


def capped(candidates: DataFrame, most: int, order_by: Iterable[Column | str]) -> DataFrame:
    """At most ``most`` candidate rows, the first by ``order_by``, as a load with a result cap takes them.

    A top-k: each task keeps ``most`` rows, nothing is sorted whole. End the order with a key, so that the
    same rows are chosen again.
    """
    return candidates.orderBy(*order_by).limit(most)


def absent_rows(
    target: DataFrame, batch: DataFrame, order_by: Iterable[str], key: str = KEY
) -> DataFrame:
    """Rows that insert-if-absent adds: one per unknown key, the earliest.

    Known keys leave first, so a load with few new keys does not sort the texts of the rest.
    """
    unknown = new_keys(checked(batch, key), target, key)
    return first_per_key(unknown, order_by, key).select(*target.columns)


def insert_if_absent(
    target: DataFrame, batch: DataFrame, order_by: Iterable[str], key: str = KEY
) -> DataFrame:
    """Existing rows win over the batch; within the batch the earliest row wins."""
    return target.unionByName(absent_rows(target, batch, order_by, key))


def delete_keys(target: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not among ``keys``; used for the cascade to child tables.

    The keys are made distinct first: map tasks drop repeats before the shuffle, which
    the join then needs no second time.
    """
    return target.join(keys.select(key).distinct(), key, "left_anti")


def one_row_per_key(
    batch: DataFrame, order_by: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """The batch with unique keys: its latest rows by ``order_by``, or an error.

    Without an order a repeated key is an error, as in a table with a primary key; the
    check is one narrow job over the keys. Null keys fail by themselves (``checked``).
    """
    if order_by is not None:
        return last_per_key(batch, order_by, key)
    repeated = batch.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if first := repeated.select(key).take(1):
        raise ValueError(f"{key} {first[0][0]!r} comes more than once in a keyed write")
    return batch


def replace_by_key(
    target: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    order_by: Iterable[str] | None = None,
) -> DataFrame:
    """Batch rows replace target rows of the same key. Other target rows stay.

    Of rows that repeat a key the last by ``order_by`` counts; without it they fail.
    """
    batch = one_row_per_key(batch, order_by, key)
    return delete_keys(target, batch, key).unionByName(checked(batch, key))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    *,
    key: str = KEY,
    first_wins: Iterable[str] = (),
    defaults: dict[str, Column] | None = None,
    order_by: Iterable[str] | None = None,
) -> DataFrame:
    """Insert unknown keys, update known ones.

    On an update batch columns overwrite, columns in ``first_wins`` keep a non-null
    target value, and target columns the batch lacks stay as they are; an insert takes
    those from ``defaults``. Of rows that repeat a key the last by ``order_by`` counts;
    without it they fail. Two branches read the batch: hand in a stored table where it is
    costly to compute.

    A left join for the updates plus an anti join against the target's keys for the
    inserts, rather than one full outer join: a small batch is then broadcast and the
    target is not shuffled.
    """
    first_wins = set(first_wins)
    defaults = defaults or {}
    batch = checked(one_row_per_key(batch, order_by, key), key)
    incoming = [c for c in batch.columns if c != key]
    changes = batch.select(key, F.struct(*incoming).alias("__new"))

    def updated(c: str) -> Column:
        old = F.col(c)
        if c == key or c not in incoming:
            return old
        new = F.col("__new")[c]
        if c in first_wins:
            return F.coalesce(old, new)
        return F.when(F.col("__new").isNotNull(), new).otherwise(old)

    updates = target.join(changes, key, "left").select(
        *[updated(c).alias(c) for c in target.columns]
    )
    inserts = new_keys(batch, target, key).select(
        *[
            F.col(c) if c in batch.columns
            else defaults.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return updates.unionByName(inserts)


def upsert_extractions(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Overwrite the record and score; keep the first snapshot and the review columns."""
    return upsert(
        target, batch, first_wins=["original"], defaults={"human_verified": F.lit(False)}
    )


def upsert_notes(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The new note wins."""
    return upsert(target, batch)


def reset(table: DataFrame) -> DataFrame:
    """The table without rows; Catalyst drops the scan."""
    return table.where(F.lit(False))


def backfill_original(extractions: DataFrame) -> DataFrame:
    """Fill missing snapshots with the current record."""
    return extractions.withColumn("original", F.coalesce("original", "extracted"))
