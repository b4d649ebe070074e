"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, written as Parquet and read
again, and returns documents with all their columns; the last one returns the pieces of the
packed sequences.

1. quality: documents that the pairwise classifier rejects go.
2. near_duplicates: of the documents that shingle links connect, the one with the smallest id stays;
   of several rows with this id, and of documents without id, one row. Texts without a word all stay.
3. repeated_spans: words in windows of 35 words that occur elsewhere are cut out of the
   texts; other texts are left as they are.
4. decontamination: documents that hold a benchmark item go.
5. packing: token ids of all documents in sequences of at most 2048.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abstractmill.llm import containment, jaccard, packing, quality, rlz
from abstractmill.llm.stored import discard, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier of the labelled ones accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn_from = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return quality.accepted(docs, quality.fit(docs, labels, learn_from))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard.one_per_component(docs)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that occur elsewhere."""
    cut = rlz.remove_repeats(docs, window=35, keep_layout=True)
    chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return containment.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_spans", cut_repeated_spans),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: The classifier and the tokenizer are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
