"""Interaction of document filters, counted over every order in which they can be applied.

Five filters, by the letter of the failure:

- A: fewer than `least_words` words;
- B: 100 * distinct words < `distinct_pct` * words;
- C: 100 * capitals A-Z > `capitals_pct` * code points;
- D: the text holds one of `symbols`;
- E: the text is identical to the text of a smaller doc_id.

*Byte transducer.* A-D come from one pass of a finite-state transducer over the UTF-8 bytes of a
slice of texts. Its two tables, indexed by state and class of the byte, give the next state and
the output: word begins, code point, capital, symbol. Every class leads to the same state from
any state, so the states of all bytes come from one table look-up and the machine runs on all
bytes of a slice at once. Each word span it puts out is inserted into one open-addressing hash
table keyed by (row, word): a probe finds a free slot, which the first such word takes, or an
owner, and then row, length and all bytes are compared with the owner's. Only a verified match is
a repeated word, so the count of distinct words does not depend on the hash.

E is decided on SHA-256 digests of whole texts.

*Orders.* A document is reduced to the set of filters that it fails. A step removes what fails its
filter and no earlier one, so all counts of all orders follow from the number of documents with
each set of failures; a filter is the first of k failures in 1 / k of the orders, which
gives `shapley` (the removals of a filter summed over all orders).

Defined cases: a null text is empty, and empty texts are identical to each other; a null value
of the part column counts as the empty string; repeated rows each count as a document and a row
with the same id is no smaller one; null ids come after all others, and none of them is smaller than another;
a document is good (toxic) if any label row of its id says 1, null ids have no label; the input may have
any other columns; an empty table gives no row.

Scale: texts stay in the scan; a document leaves it as some 60 bytes (id, digest, failures, part).
Copies are added up in the map tasks before they move, per id and then per digest, so a text that a
third of all rows share is one row per task. The driver collects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import FIRST, LONG_SPAN, lanes, mix, pieces, span_hashes, text_bytes

FILTERS = "ABCDE"
SYMBOLS = "#$%&*|"

# Classes of bytes.
SPACE, ASCII, CAPITAL, SYMBOL, LEAD, TRAIL = range(6)
# States: between words, in a word.
BETWEEN, WORD = 0, 1
# Outputs, as bits.
BEGIN, POINT, UPPER, SIGN = 1, 2, 4, 8

#: State after a byte of each class, by the state before it.
NEXT = np.array([[BETWEEN, WORD, WORD, WORD, WORD, WORD]] * 2, np.uint8)
#: Output at a byte of each class, by the state before it.
OUTPUT = np.array(
    [
        [POINT, BEGIN | POINT, BEGIN | POINT | UPPER, BEGIN | POINT | SIGN, BEGIN | POINT, BEGIN],
        [POINT, POINT, POINT | UPPER, POINT | SIGN, POINT, 0],
    ],
    np.uint8,
)


def byte_classes(symbols: str = SYMBOLS) -> np.ndarray:
    """The class of each byte."""
    out = np.full(256, ASCII, np.uint8)
    out[0x80:0xC0], out[0xC0:] = TRAIL, LEAD
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    out[ord("A") : ord("Z") + 1] = CAPITAL
    out[[ord(c) for c in symbols]] = SYMBOL
    return out


def transduce(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after each byte and output at it; the machine starts anew at each row."""
    kind = classes[data]
    state = NEXT[BETWEEN][kind]
    before = np.empty(len(data), np.uint8)
    before[1:] = state[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = BETWEEN
    return state, OUTPUT.ravel()[before * np.uint8(6) + kind]


def _same_words(
    data: np.ndarray, held: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, a: np.ndarray, b: np.ndarray
) -> np.ndarray:
    """Whether words a and b are of one row and equal byte by byte."""
    same = (rows[a] == rows[b]) & (sizes[a] == sizes[b])
    for at in range(0, LONG_SPAN, 8):
        own = np.flatnonzero(same & (sizes[a] > at) & (a != b))
        if not len(own):
            break
        x, y = a[own], b[own]
        mask = FIRST[np.minimum(sizes[x] - at, 8)]
        same[own] = ((held[starts[x] + at] ^ held[starts[y] + at]) & mask) == 0
    for i in np.flatnonzero(same & (sizes[a] > LONG_SPAN) & (a != b)).tolist():
        x, y, n = starts[a[i]], starts[b[i]], sizes[a[i]]
        same[i] = bool((data[x : x + n] == data[y : y + n]).all())
    return same


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int, hashes: np.ndarray | None = None) -> np.ndarray:
    """Distinct words of each row, by a verified hash table of all word spans.

    Words of one hash probe the same slots in the same rounds, so a word meets every
    earlier one it may equal. hashes: given by tests, to force collisions.
    """
    found = np.zeros(n_rows, np.int64)
    if not len(starts):
        return found
    sizes, held = ends - starts, lanes(data)
    h = span_hashes(data, starts, ends) if hashes is None else hashes
    h = mix(h ^ mix(rows.astype(np.uint64)))
    mask = (1 << max(4, int(2 * len(starts) - 1).bit_length())) - 1
    slots = np.full(mask + 1, -1, np.int64)
    place = (h & np.uint64(mask)).astype(np.int64)
    left = np.arange(len(starts))
    while len(left):
        at = place[left]
        free = np.flatnonzero(slots[at] < 0)
        slots[at[free[::-1]]] = left[free[::-1]]  # of several words the first one takes the slot
        owner = slots[at]
        mine = owner == left
        found += np.bincount(rows[left[mine]], minlength=n_rows)
        rest = np.flatnonzero(~mine)
        other = ~_same_words(data, held, starts, sizes, rows, left[rest], owner[rest])
        left = left[rest[other]]
        place[left] = (place[left] + 1) & mask
    return found


def text_counts(column: pa.Array, classes: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, code points, capitals and symbols of each text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    state, out = transduce(data, offsets, classes)

    def counted(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, offsets))

    starts = np.flatnonzero(out & BEGIN)
    over = np.zeros(len(data) + 1, bool)  # no word goes on at these places
    over[:-1] = state == BETWEEN
    over[offsets] = True
    ends = np.flatnonzero((state == WORD) & over[1:]) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return {
        "n_words": counted(starts),
        "n_distinct": distinct_words(data, starts, ends, rows, n),
        "n_points": np.diff(offsets) - counted(np.flatnonzero(out & POINT == 0)),
        "n_capitals": counted(np.flatnonzero(out & UPPER)),
        "n_symbols": counted(np.flatnonzero(out & SIGN)),
    }


def document_failures(
    docs: DataFrame,
    part: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = 100,
    distinct_pct: int = 80,
    capitals_pct: int = 10,
    symbols: str = SYMBOLS,
) -> DataFrame:
    """part, doc_id, digest, failures and the counts behind them, for each row.

    failures is a number whose bits 0 to 3 stand for filters A to D; E is left to
    `interactions`, which sees all texts.
    """
    classes = byte_classes(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text"):
                n = text_counts(rows.column("text"), classes)
                fails = (
                    (n["n_words"] < least_words).astype(np.int32)
                    | (100 * n["n_distinct"] < distinct_pct * n["n_words"]).astype(np.int32) << 1
                    | (100 * n["n_capitals"] > capitals_pct * n["n_points"]).astype(np.int32) << 2
                    | (n["n_symbols"] > 0).astype(np.int32) << 3
                )
                yield pa.RecordBatch.from_pydict(
                    {c: rows.column(c) for c in ("part", "doc_id", "digest")}
                    | {"failures": pa.array(fails, pa.int32())}
                    | {c: pa.array(x, pa.int64()) for c, x in n.items()}
                )

    whole = F.coalesce(F.col(text), F.lit(""))
    columns = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        whole.alias("text"),
    )
    schema = "part string, doc_id long, digest binary, failures int, n_words long, n_distinct long, n_points long, n_capitals long, n_symbols long"
    return columns.mapInArrow(run, schema)


def failure_groups(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """part, failures (E too), good, toxic and the number of documents of each such group."""
    said = labels.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    by_id = documents.groupBy("doc_id", "digest", "part", "failures").agg(F.count("*").alias("n"))
    marked = by_id.join(said, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Of one digest and group each id is one row here, so the least struct holds the rows of the least id.
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("n").alias("n"))
    by_text = marked.groupBy("digest", "part", "failures", "good", "toxic").agg(F.sum("n").alias("n"), F.min(own).alias("own"))
    least = F.min(F.struct("own.none", "own.id")).over(Window.partitionBy("digest"))
    first = F.when((F.col("own.none") == least["none"]) & F.col("own.id").eqNullSafe(least["id"]), F.col("own.n")).otherwise(0)
    split = by_text.withColumn("first", first).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("failures").alias("failures"), F.col("first").alias("n")),
                F.struct(F.col("failures").bitwiseOR(F.lit(16)).alias("failures"), (F.col("n") - F.col("first")).alias("n")),
            )
        ).alias("g"),
    )
    return split.filter("g.n > 0").groupBy("part", F.col("g.failures").alias("failures"), "good", "toxic").agg(F.sum("g.n").alias("n"))


def _summed(value: Column, condition: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0).cast("long"))


def interactions(groups: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the groups of `failure_groups`."""
    sets = groups.groupBy("part", "failures").agg(
        F.sum("n").alias("n"),
        F.sum(_summed(F.col("n"), F.col("good"))).alias("good"),
        F.sum(_summed(F.col("n"), F.col("toxic"))).alias("toxic"),
    )
    per_part = sets.groupBy("part").agg(F.collect_list(F.struct("failures", "n", "good", "toxic")).alias("sets"))  # 32 at most
    orders = F.split(F.lit(",".join("".join(x) for x in permutations(FILTERS))), ",")
    steps = per_part.select("part", "sets", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )

    def letters(upto: str) -> Column:
        """The filters of the order's first `upto` steps, as bits."""
        bit = "shiftleft(1, ascii(substring(filter_order, i, 1)) - 65)"
        return F.expr(f"aggregate(sequence(1, 5), 0, (bits, i) -> if(i <= {upto}, bits | {bit}, bits))")

    steps = steps.withColumns({"before": letters("step - 1"), "after": letters("step")}).withColumn("own", F.col("after") - F.col("before"))

    def total(field: str, condition: str, factor: str = "1") -> Column:
        return F.expr(f"aggregate(sets, 0L, (sum, s) -> if({condition}, sum + s.{field} * {factor}, sum))")

    removed = "s.failures & own != 0 AND s.failures & before = 0"
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", "s.failures & after = 0").alias("kept"),
        total("n", removed).alias("removed"),
        total("n", "s.failures & own != 0 AND s.failures & before != 0").alias("redundant"),
        total("n", "s.failures = own").alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        # A filter comes first among k failures in 120 / k of the 120 orders.
        total("n", "s.failures & own != 0", "(120 div bit_count(s.failures))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every part, order of the five filters and step."""
    documents = document_failures(docs, part, doc_id, text).select("part", "doc_id", "digest", "failures")
    return interactions(failure_groups(documents, labels, doc_id))
