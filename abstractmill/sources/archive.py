"""Date-partitioned archive of raw records."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_COLUMNS = "pmid string, raw_json string, archive_date date"


def write_archive(raw: DataFrame, path: str, archive_date: str) -> None:
    """Write every raw row under ``path/archive_date=YYYY-MM-DD/``.

    Running again for the same date replaces that date only. Rows share files, so the
    number of objects follows the data volume and not the record count.
    """
    (
        raw.select("pmid", "raw_json", F.lit(archive_date).alias("archive_date"))
        .write.partitionBy("archive_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Scan the archive; a filter on ``archive_date`` prunes folders."""
    return spark.read.schema(ARCHIVE_COLUMNS).json(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names.

    ``spark.checkpoint.dir``, which every executor must reach; without it there is no
    folder that they could share, and a cluster would write to many local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a fresh path and read it back: one evaluation, short lineage."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
