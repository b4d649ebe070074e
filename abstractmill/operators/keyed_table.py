"""Keyed tables laid out by a hash of the key, so that a change touches few files.

The rows of a table lie in ``buckets`` folders, one per hash of the key, and the table is declared
to Spark as clustered by the key. So a join by key or a check of the key reads each bucket in one
task and moves only the batch, never the table; only the buckets that the batch has keys of
are read, and only they are written anew, by a dynamic partition overwrite.

All changes are idempotent: a change that was interrupted is applied again from the same batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from .keyed import KEY, checked, first_per_key, one_row_per_key

_OLD, _NEW, _BUCKET = "__old", "__new", "__bucket"


class KeyedTable:
    """A table with unique keys under ``path``; make one by ``create`` or ``open``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.name = f"keyed_{uuid.uuid4().hex}"
        quoted = f"{path}/rows".replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}, {_BUCKET} int) USING parquet "
            f"OPTIONS (path '{quoted}', partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY ({_BUCKET}) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
        )
        # As the files have it: every column, nested ones too, may be null.
        self.schema = T.StructType([f for f in spark.table(self.name).schema.fields if f.name != _BUCKET])

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        rows: DataFrame,
        key: str = KEY,
        buckets: int | None = None,
        order_by: Iterable[str] | None = None,
    ) -> KeyedTable:
        """Lay out the rows under a fresh path. This is the one time that all of them move.

        ``buckets`` is for the life of the table: some hundred MB of the grown table to each, at
        least the shuffle partitions of the session (the default). Of rows that repeat a key
        the last by ``order_by`` counts; without it they fail.
        """
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        about = json.dumps({"key": key, "buckets": buckets, "schema": rows.schema.jsonValue()})
        table = cls(spark, path, rows.schema, key, buckets)
        table._write(checked(one_row_per_key(rows, order_by, key), key).repartition(buckets, key))
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/layout")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        """The table that ``create`` laid out under the path."""
        about = json.loads(spark.read.text(f"{path}/layout", wholetext=True).first()[0])
        table = cls(spark, path, T.StructType.fromJson(about["schema"]), about["key"], about["buckets"])
        spark.sql(f"MSCK REPAIR TABLE {table.name}")
        return table

    def rows(self) -> DataFrame:
        """The whole table."""
        return self.spark.table(self.name).select(*self.schema.fieldNames())

    def _bucket(self) -> Column:
        """The folder of a key. The same hash as the clustering's, so that a bucket is one folder."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets that keys of the batch belong to; at most all buckets."""
        return sorted(r[0] for r in batch.select(self._bucket().alias(_BUCKET)).distinct().collect())

    def _in(self, buckets: list[int]) -> DataFrame:
        near = self.spark.table(self.name).where(F.col(_BUCKET).isin(buckets))
        return near.select(*self.schema.fieldNames())

    def matching(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is among ``keys``; other buckets are not read."""
        wanted = keys.select(self.key).distinct()
        return self._in(self.touched(wanted)).join(wanted, self.key, "left_semi").select(*self.schema.fieldNames())

    def repeated_keys(self) -> DataFrame:
        """Keys that come more than once, which is none unless files were added by hand."""
        counts = self.spark.table(self.name).groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        return counts.where(F.col("n") > 1)

    def changed(self, batch: DataFrame, columns: dict[str, Column]) -> DataFrame:
        """The next rows of the touched buckets; the batch has unique keys.

        ``columns`` may use ``__old`` and ``__new``, the table's and the batch's row of the key,
        null where there is none.
        """
        old = self._in(self.touched(batch)).select(self.key, F.struct(*self.schema.fieldNames()).alias(_OLD))
        new = batch.select(self.key, F.struct(*batch.columns).alias(_NEW))
        both = old.join(new, self.key, "full_outer")
        return both.select(
            *[
                F.col(self.key) if f.name == self.key else columns[f.name].cast(f.dataType).alias(f.name)
                for f in self.schema.fields
            ]
        )

    def _write(self, rows: DataFrame) -> None:
        placed = rows.select(*self.schema.fieldNames(), self._bucket().alias(_BUCKET))
        placed.write.insertInto(self.name, overwrite=True)
        self.spark.catalog.refreshTable(self.name)

    def _apply(self, batch: DataFrame, columns: dict[str, Column]) -> None:
        self._write(self.changed(checked(batch, self.key), columns))

    def replace(self, batch: DataFrame, order_by: Iterable[str] | None = None) -> None:
        """Batch rows take the place of rows of the same key, or are added."""
        batch = one_row_per_key(batch, order_by, self.key)
        self._apply(batch, {c: self._newest(c) for c in self.schema.fieldNames()})

    def insert_if_absent(self, batch: DataFrame, order_by: Iterable[str]) -> None:
        """Rows of the table win over the batch; within the batch the earliest row wins."""
        batch = first_per_key(batch, order_by, self.key)
        held = F.col(_OLD).isNotNull()
        columns = {c: F.when(held, F.col(_OLD)[c]).otherwise(F.col(_NEW)[c]) for c in self.schema.fieldNames()}
        self._apply(batch.select(*self.schema.fieldNames()), columns)

    def upsert(
        self,
        batch: DataFrame,
        *,
        first_wins: Iterable[str] = (),
        defaults: dict[str, Column] | None = None,
        order_by: Iterable[str] | None = None,
    ) -> None:
        """As ``keyed.upsert``: unknown keys are inserted, known ones get the batch's columns."""
        batch = one_row_per_key(batch, order_by, self.key)
        defaults, columns = defaults or {}, {}
        for c in self.schema.fieldNames():
            if c not in batch.columns:
                absent = defaults.get(c, F.lit(None))
                columns[c] = F.when(F.col(_OLD).isNotNull(), F.col(_OLD)[c]).otherwise(absent)
            elif c in set(first_wins):
                columns[c] = F.coalesce(F.col(_OLD)[c], F.col(_NEW)[c])
            else:
                columns[c] = self._newest(c)
        self._apply(batch, columns)

    def update(self, batch: DataFrame, columns: dict[str, Column]) -> None:
        """Give the known keys of the batch new columns, from ``__old`` and ``__new``; others stay as they are.

        Unknown keys of the batch are ignored.
        """
        known = F.col(_NEW).isNotNull()
        every = {c: F.when(known, columns.get(c, F.col(_OLD)[c])).otherwise(F.col(_OLD)[c]) for c in self.schema.fieldNames()}
        here = self._in(self.touched(batch)).select(self.key)
        self._apply(batch.join(here, self.key, "left_semi"), every)

    def delete(self, keys: DataFrame) -> None:
        """Rows whose key is among ``keys`` go.

        An overwrite leaves a bucket alone that gets no row, so the folders of buckets
        that end empty are deleted; which ones these are is found from keys alone.
        """
        gone = keys.select(self.key).distinct()
        touched = self.touched(gone)
        left = self._in(touched).join(gone, self.key, "left_anti")
        filled = set(self.touched(left))
        self._write(left)
        for bucket in set(touched) - filled:
            files.delete(self.spark, f"{self.path}/rows/{_BUCKET}={bucket}")
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({_BUCKET} = {bucket})")
        self.spark.catalog.refreshTable(self.name)

    @staticmethod
    def _newest(column: str) -> Column:
        return F.when(F.col(_NEW).isNotNull(), F.col(_NEW)[column]).otherwise(F.col(_OLD)[column])
