"""Ingest of article files as they arrive.

The same ingest as the batch run, driven by a file stream: each micro-batch parses the
new files and adds the records whose keys are unknown. Later stages pick up what is new
by their anti joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.keyed import absent_rows
from ..schemas import RAW, conform
from ..sources.articles import RECORD_END, parse_articles, to_raw

_STORED = "pmid string, raw_json string, fetched_at timestamp, batch bigint"


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table that the stream keeps."""
    return conform(spark.read.schema(_STORED).parquet(raw_path), RAW)


def ingest_stream(
    spark: SparkSession,
    incoming: str,
    raw_path: str,
    checkpoint: str,
    fetched_at: Column,
    max_files: int = 1000,
) -> StreamingQuery:
    """Start the ingest of all files not seen yet; the query ends when they are done.

    Of articles that repeat a key the one of the earliest file counts (by time, then
    name, then the record's text). A micro-batch writes only its own partition and looks for known keys only in the
    others, so a batch that is replayed after a failure replaces what it had written.
    """
    empty = spark.createDataFrame([], _STORED)
    empty.write.mode("append").partitionBy("batch").parquet(raw_path)
    lines = (
        spark.readStream.format("text")
        .schema("value string")
        .option("lineSep", RECORD_END)
        .option("maxFilesPerTrigger", max_files)
        .load(incoming)
        .select(
            "value",
            F.col("_metadata.file_modification_time").alias("arrived"),
            F.col("_metadata.file_path").alias("file"),
        )
    )
    order = ["arrived", "file"]

    def add(rows: DataFrame, batch: int) -> None:
        stored = rows.sparkSession.read.schema(_STORED).parquet(raw_path)
        known = stored.where(F.col("batch") != batch).drop("batch")
        absent_rows(known, rows, [*order, "raw_json"]).withColumn("batch", F.lit(batch)).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(raw_path)

    return (
        to_raw(parse_articles(lines, keep=order), fetched_at, keep=order)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
