"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Where a table that `stored` returned lies.
_PATH = "_stored_at"
_OPEN: ContextVar = ContextVar("scratch", default=None)


class Scratch:
    """Tables stored inside a `with` block, which are deleted at its end but for those kept.

    Nothing that reads a table which is not kept may leave the block without having been stored.
    """

    def __enter__(self) -> Scratch:
        self.tables: list[DataFrame] = []
        self.outer = _OPEN.set(self)
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        self.tables = [t for t in self.tables if getattr(t, _PATH) != getattr(table, _PATH)]
        return table

    def __exit__(self, *error: object) -> None:
        _OPEN.reset(self.outer)
        discard(*self.tables)


def free_name(taken: Iterable[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    held = {x.lower() for x in taken}
    while name.lower() in held:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; without that setting there is no folder that all executors see."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again.

    narrow: the rows are few and short against the other tables of a plan (edges, say), so they go to
    a sixteenth of the shuffle partitions' number of files.

    Later plans start from the files, so a lost executor costs the tasks that were running
    on it, and rows that depend on how they were dealt out do not change any more. Whoever stored
    a table may `discard` it once nothing reads it; the tables behind a returned DataFrame stay.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if narrow:
        df = df.coalesce(max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    if _OPEN.get():
        _OPEN.get().tables.append(out)
    return out


def viewed(df: DataFrame, table: DataFrame) -> DataFrame:
    """df, which reads nothing but the stored table, as a stored table too."""
    setattr(df, _PATH, getattr(table, _PATH))
    return df


def discard(*tables: DataFrame) -> None:
    """Delete tables that `stored` returned; others are left alone."""
    for table in tables:
        path = getattr(table, _PATH, None)
        if path:
            jvm = table.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
