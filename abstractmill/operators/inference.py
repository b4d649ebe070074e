"""Batched model inference with a caller-supplied predictor."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.model_output import build_prompt
from ..functions.rules import MIN_TEXT

Predictor = Callable[[Sequence[str]], Sequence[str | None]]
PredictorFactory = Callable[[], Predictor]


def _predictor_udf(make_predictor: PredictorFactory):
    # Nested so that the function travels by value; workers need no copy of this package.
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        log = logging.getLogger("abstractmill.inference")
        try:
            predict = make_predictor()
        except Exception as e:
            log.warning("no predictor, rules take every row: %s", e)
            predict = None

        def many(prompts):
            try:
                answers = list(predict(prompts))
                if len(answers) == len(prompts):
                    return answers
            except Exception as e:
                log.debug("%d prompts failed: %s", len(prompts), e)
            # A failing batch is halved until only its bad rows lose their answer.
            if len(prompts) == 1:
                return [None]
            half = len(prompts) // 2
            return many(prompts[:half]) + many(prompts[half:])

        for batch in batches:
            out = pd.Series([None] * len(batch), dtype=object)
            asked = batch.notna().to_numpy()
            if predict is not None and asked.any():
                out[asked] = many(batch[asked].tolist())
            yield out

    # Non-deterministic: no optimizer rule may evaluate the model twice for a row.
    return F.pandas_udf(run, T.StringType()).asNondeterministic()


def with_model_output(
    df: DataFrame,
    make_predictor: PredictorFactory,
    text: str = "abstract_text",
    max_chars: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``model_output``, the predictor's raw answer to each abstract's prompt.

    ``make_predictor`` runs once per task and returns a function over a list of prompts.
    Answers are null for texts under the minimum length, for rows the predictor fails
    on, and for every row if it cannot be made; the rules take those. ``partitions``
    spreads the rows first, where inference costs far more than a shuffle of the texts.
    """
    spread = df if partitions is None else df.repartition(partitions)
    prompt = F.when(F.length(text) >= MIN_TEXT, build_prompt(F.col(text), max_chars))
    return spread.withColumn("model_output", _predictor_udf(make_predictor)(prompt))


def with_distinct_output(
    df: DataFrame,
    make_predictor: PredictorFactory,
    text: str = "abstract_text",
    max_chars: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """As ``with_model_output``, but the predictor sees each distinct prompt once.

    Prompts meet by their SHA-256; a hash with two prompts, if there were one, fails the job. Copies
    of a hot prompt are reduced in the map tasks. Within a task prompts come by length, so that
    a batch holds prompts of like length and a model pads little. The answers are
    joined back by hash; adaptive execution splits the rows of a hot one.
    """
    prompt = F.when(F.length(text) >= MIN_TEXT, build_prompt(F.col(text), max_chars))
    asked = df.select(F.sha2(prompt, 256).alias("__hash"), prompt.alias("__prompt")).where(F.col("__hash").isNotNull())
    per_hash = asked.groupBy("__hash").agg(F.min("__prompt").alias("__first"), F.max("__prompt").alias("__last"))
    clash = F.raise_error(F.lit("two prompts have one hash")).cast("string")
    distinct = per_hash.select(
        "__hash", F.when(F.col("__first") == F.col("__last"), F.col("__first")).otherwise(clash).alias("__prompt")
    )
    spread = distinct if partitions is None else distinct.repartition(partitions, "__hash")
    by_length = spread.sortWithinPartitions(F.length("__prompt"))
    answers = by_length.select("__hash", _predictor_udf(make_predictor)(F.col("__prompt")).alias("model_output"))
    keyed = df.withColumn("__hash", F.sha2(prompt, 256))
    return keyed.join(answers, "__hash", "left").select(*df.columns, "model_output")
