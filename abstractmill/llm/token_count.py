"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a slice of texts are one ragged numpy array; every round merges each
distinct pre-token's pair of lowest rank (`bpe.Merges.merge`); the symbols that survive
are counted and summed by document.

Defined cases: null counts as the empty text (0 bytes, 0 tokens); special strings inside a
text are one token each, as the tokenizer library has it by default; every input row
gives one row, repeated ids too; other columns are ignored.

Scale: no shuffle; a task holds one slice of texts (or one text) at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import pieces, text_bytes
from .bpe import merges


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row.

    vocabulary: the path of a byte-level BPE file that every worker can read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merges(vocabulary)
        for batch in batches:
            for part in pieces(batch, "text"):
                number, rows, _, at = bpe.encode(part.column("text"))
                total = np.concatenate([[0], np.cumsum(np.diff(at)[number])])
                n = (total[rows[1:]] - total[rows[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_bytes": pa.array(np.diff(text_bytes(part.column("text"))[1])),
                        "n_tokens": pa.array(n),
                        "over_limit": pa.array(n > limit),
                    }
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
