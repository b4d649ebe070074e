"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by the size q of their shingle set (powers of two). A partition keeps
the smallest floor((1 - t) * u) + 1 hash values of each of its items (a bottom-k MinHash
sketch; u is the partition's largest size). A document that holds t * q or more of an
item's shingles misses at most floor((1 - t) * q) of them, so it holds one of the sketch: looking
up every shingle of a document in the sketches finds every item it may contain, however
much longer the document is. Candidates are verified by exact shingle containment on the words.

Shingles are five lower-cased (A-Z) words; a text with fewer words has its whole sequence
as one shingle, without words it has none.

Defined cases: null and empty texts contain nothing and are contained in nothing; an item
of fewer than five words is contained only in documents of exactly those words; repeated
rows of items or documents give a row for each pair; null ids are carried as they are;
other columns are ignored; without items or documents there is no pair.

Scale: documents are read once and not shuffled while the items are within `broadcast_bytes` of
text, ITEMS rows and SHINGLES words (they are broadcast; the bounds are checked before). Beyond it sketches and
shingles are joined by hash and only the texts of candidate pairs are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Words, pieces, shingles, spans
from .stored import free_name, stored

N_WORDS = 5
#: Items and shingles that are broadcast at most (beside the bytes of their texts, a parameter).
ITEMS, SHINGLES = 1 << 16, 1 << 18
PAIRS = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def word_shingles(text: str | None, n: int = N_WORDS) -> set[bytes]:
    """The distinct shingles of a text, as bytes."""
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def _kept(q: np.ndarray, threshold: float) -> np.ndarray:
    """Sketch sizes of items with q shingles."""
    upper = (1 << (np.floor(np.log2(np.maximum(q, 1))).astype(np.int64) + 1)) - 1
    return np.minimum(q, np.floor((1 - threshold) * upper + 1e-9).astype(np.int64) + 1)


def _sketches(column: pa.Array, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The sketch hashes of a text column and the row of each. Hashes of a row are ascending."""
    words = Words(column, lower=True)
    hashes, rows = shingles(words.hashes(), words.rows, N_WORDS)
    kept = _kept(np.diff(rows), threshold) * (np.diff(rows) > 0)
    return hashes[spans(rows[:-1], rows[:-1] + kept)], np.repeat(np.arange(len(kept)), kept)


class SketchIndex:
    """Sketches of items that fit a task, and their shingle sets for verification."""

    def __init__(self, ids: list, texts: list[str], threshold: float):
        self.ids, self.threshold = ids, threshold
        self.sets = [word_shingles(x) for x in texts]
        hashes, items = _sketches(pa.array(texts, pa.large_string()), threshold)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.items = hashes[order], items[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.hashes >> np.uint64(42)] = True

    def candidates(self, column: pa.Array) -> dict[int, set[int]]:
        """Items that each row may contain."""
        words = Words(column, lower=True)
        hashes, rows = shingles(words.hashes(), words.rows, N_WORDS)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(42)])
        low, high = (np.searchsorted(self.hashes, hashes[at], side) for side in ("left", "right"))
        row = np.repeat(np.searchsorted(rows, at, "right") - 1, high - low)
        found: dict[int, set[int]] = {}
        for r, i in zip(row.tolist(), self.items[spans(low, high)].tolist(), strict=True):
            found.setdefault(r, set()).add(i)
        return found

    def contained(self, column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """Row, item, its shingles and how many of them the row holds, where these are enough."""
        for row, items in self.candidates(column).items():
            held = word_shingles(column[row].as_py())
            for i in sorted(items):
                shared = len(self.sets[i] & held)
                if shared >= self.threshold * len(self.sets[i]) - 1e-9:
                    yield row, i, len(self.sets[i]), shared


def _index(spark, items: DataFrame, item_id: str, text: str, threshold: float, most: int):
    """A broadcast index, or None if the items are too many: more than `most` bytes of text, ITEMS rows or SHINGLES shingles."""
    rows = items.filter(F.col(text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    n_words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.filter(n_words > 0)  # an item without words is in no document
    size, count, words = rows.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum(n_words)).first()
    if (size or 0) > most or count > ITEMS or (words or 0) > SHINGLES:  # an item has no more shingles than words
        return None
    held = rows.collect()
    return spark.sparkContext.broadcast(SketchIndex([x[0] for x in held], [x[1] for x in held], threshold))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    broadcast_bytes: int = 16 << 20,
) -> DataFrame:
    """Pairs of a document and an item of which it holds `threshold` of the shingles or more."""
    shared = _index(docs.sparkSession, items, item_id, text, threshold, broadcast_bytes)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if shared is None:
        return _contained_by_join(texts, items, threshold, item_id, text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                found = list(index.contained(part.column("text")))
                if found:
                    row, item, size, held = zip(*found, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": part.column("doc_id").take(pa.array(row)),
                            "item_id": pa.array([index.ids[i] for i in item], pa.int64()),
                            "item_shingles": pa.array(size, pa.int64()),
                            "shared": pa.array(held, pa.int64()),
                            "containment": pa.array([h / s for h, s in zip(held, size, strict=True)], pa.float64()),
                        }
                    )

    return texts.mapInArrow(search, PAIRS)


def _contained_by_join(texts: DataFrame, items: DataFrame, threshold: float, item_id: str, text: str) -> DataFrame:
    """The same pairs where the items are too many to broadcast."""
    kept = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("item_text")).filter("item_text is not null")

    def hashed(key: str, column: str, sketch: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, column):
                    if sketch:
                        h, row = _sketches(part.column(column), threshold)
                    else:
                        words = Words(part.column(column), lower=True)
                        h, rows = shingles(words.hashes(), words.rows, N_WORDS)
                        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
                    yield pa.RecordBatch.from_pydict({key: part.column(key).take(pa.array(row)), "h": pa.array(h.view(np.int64))})

        return run

    left = texts.mapInArrow(hashed("doc_id", "text", False), "doc_id long, h long")
    right = kept.mapInArrow(hashed("item_id", "item_text", True), "item_id long, h long")
    pairs = left.join(right, "h").select("doc_id", "item_id").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                item = word_shingles(x["item_text"])
                shared = len(item & word_shingles(x["text"]))
                if shared >= threshold * len(item) - 1e-9:
                    rows.append((x["doc_id"], x["item_id"], len(item), shared, shared / len(item)))
            if rows:
                names = ("doc_id", "item_id", "item_shingles", "shared", "containment")
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))

    # Ids may be null or repeated: every pair of rows with these ids is verified.
    both = pairs.join(texts, pairs.doc_id.eqNullSafe(texts.doc_id)).select(pairs.doc_id, "item_id", "text")
    return (
        both.join(kept, both.item_id.eqNullSafe(kept.item_id))
        .select("doc_id", both.item_id, "text", "item_text")
        .mapInArrow(verify, PAIRS)
    )


def without_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, item_id: str = "item_id", text: str = "text", broadcast_bytes: int = 16 << 20
) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    shared = _index(docs.sparkSession, items, item_id, text, threshold, broadcast_bytes)
    if shared is None:
        row = free_name(docs.columns, "row")
        keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # the same numbers for both uses
        held = contained_items(keyed, items, threshold, row, item_id, text, broadcast_bytes)
        return keyed.join(held.select(F.col("doc_id").alias(row)).distinct(), row, "left_anti").select(*docs.columns)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in pieces(batch, text):
                bad = Counter(row for row, *_ in index.contained(part.column(text)))
                yield part.filter(pa.array([row not in bad for row in range(part.num_rows)]))

    return docs.mapInArrow(search, T.StructType(docs.schema.fields))
