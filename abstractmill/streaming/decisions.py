"""Review decisions as a stream.

The state of a key is the net effect of all its decisions so far: the last approval or
rejection and the last edit, each with the order it was made in. It is kept by Spark's stateful
aggregation, in the checkpoint. A decision that arrives late or twice is compared with what the state
holds, so the outcome does not depend on the order of arrival. Each micro-batch
hands on the keys that it changed, and only their buckets of the extraction table are written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.keyed_table import KeyedTable
from ..operators.review import settle_decisions
from ..schemas import RECORD

DECISIONS = T.StructType(
    [
        T.StructField("pmid", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("edited", RECORD),
        T.StructField("notes", T.StringType()),
        T.StructField("decided_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)


def review_stream(
    spark: SparkSession,
    incoming: str,
    extractions: KeyedTable,
    checkpoint: str,
    order_by: Iterable[str] = ("decided_at", "seq"),
    max_files: int = 1000,
) -> StreamingQuery:
    """Apply all decision files (Parquet) not seen yet to the table; the query ends when they are done.

    Decisions on keys that the table lacks are ignored. Settled decisions are cumulative, so a
    micro-batch that is repeated after a failure writes the same rows again, and decisions apply to
    the record as it was when the first edit came or later. A decision with a null key is an error.
    """
    decisions = spark.readStream.schema(DECISIONS).option("maxFilesPerTrigger", max_files).parquet(incoming)
    old, new = F.col("__old"), F.col("__new")
    changed = {
        "extracted": F.coalesce(new["__edited"].cast(RECORD), old["extracted"]),
        "human_verified": new["__last"]["verified"],
        "reviewer_notes": new["__last"]["notes"],
    }

    def apply(settled: DataFrame, batch: int) -> None:
        # Stored once: the table reads it three times, and the state must not be computed for each.
        folder = f"{checkpoint}-settled/batch={batch}"
        settled.write.mode("overwrite").parquet(folder)
        extractions.update(spark.read.schema(settled.schema).parquet(folder), changed)

    return (
        settle_decisions(decisions, order_by)
        .writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
