"""Substring dedup by relative Lempel-Ziv parsing against every block of the corpus.

The corpus is cut into reference blocks (slices of about BLOCK_BYTES of documents). The index
of all blocks is a distributed hash table of their windows of `window` words: each block
sends the hashes of its distinct windows, with a bit for those that start twice in it, to `buckets` groups; a
group finds the windows that start more than once anywhere and answers each block with a bit per
window and the block of the other occurrence to follow (the block itself if there is no other). A document is then parsed greedily from left to right: at a window
that occurs elsewhere a factor starts and runs on while the windows after it are found in
the same reference block. Factors of `window` words or more are duplicate spans. A window
that crosses the end of a factor is in no factor of that block, so the windows at each boundary
are looked up by themselves; the one found there starts the next factor, which
overlaps the last one. So a word is removed if and only if a window that covers it
starts anywhere else, in the same document too.

Windows are told apart by 56 bits of one hash and the group, which comes from another hash
(about 64 bits at 200 groups and more with every doubling), so a false match is not to be expected
in 10 ** 9 words (N * N / 2 ** 65); the input alone is judged, not what is left of it.

Defined cases: a null text has no words and comes back empty; documents shorter than the window
lose nothing; every row is a document of its own, so repeated rows lose all their windows;
ties do not arise (every occurrence is removed, the reference is the first other block);
other columns are carried, also ones named like the added columns of the answer, which are
then replaced; an empty table gives no row.

Scale: texts are read once and travel compressed with their block to the group and back. The groups
are dealt by hash and hold one row per block and each of its windows once, so a passage that a third of all
documents share, or one word that they repeat, adds one entry a block to the groups of its windows. A task holds one
group or one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Words, block_numbers, grams, mix, pieces, spread

BLOCK_BYTES = 2 << 20
#: Bytes of a window's hash that are sent.
WIDTH = 7
SENT = "bucket int, block long, hashes binary, twice binary, texts binary"
ANSWER = "block long, bucket int, found binary, refs binary, texts binary"


def _windows(words: Words, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Low hash bits of each window, its start, and its group."""
    hashes = words.hashes()
    h, at = grams(hashes, words.rows, window)
    other, _ = grams(mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)), words.rows, window)
    group = ((other >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return h, at, group.astype(np.int32)


def _distinct(h: np.ndarray, group: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows of a block by group, bounds of the groups, the entry of each window, and which come twice."""
    h = h & np.uint64((1 << 8 * WIDTH) - 1)  # what is sent tells them apart
    order = np.lexsort((h, group))
    hashes, groups = h[order], group[order]
    new = np.ones(len(h), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (groups[1:] != groups[:-1])
    entry = np.empty(len(h), np.int64)
    entry[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    twice = np.diff(np.append(first, len(h))) > 1
    return hashes[first], np.searchsorted(groups[first], np.arange(buckets + 1)), entry, twice


def _by_group(group: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their groups, and the bounds of the groups."""
    kind = np.uint16 if buckets <= 1 << 16 else np.int32
    order = np.argsort(group.astype(kind), kind="stable")
    return order, np.searchsorted(group[order], np.arange(buckets + 1))


def _pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view(np.uint64).ravel()


def _pack_refs(refs: np.ndarray) -> bytes:
    """Block numbers as the distinct ones and an index into them, of two bytes where these are few."""
    blocks, index = np.unique(refs, return_inverse=True)
    kind = np.uint16 if len(blocks) <= 1 << 16 else np.uint32
    return np.int64(len(blocks)).tobytes() + blocks.astype(np.int64).tobytes() + index.astype(kind).tobytes()


def _unpack_refs(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    kind = np.uint16 if n <= 1 << 16 else np.uint32
    return np.frombuffer(data, np.int64, n, 8)[np.frombuffer(data, kind, offset=8 * (n + 1))]


def to_bytes(batch: pa.RecordBatch) -> bytes:
    """The rows, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as rows:
        return rows.read_next_batch()


def _send(text: str, window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = block_numbers(TaskContext.get().partitionId())
        for batch in batches:
            for part in pieces(batch, text, BLOCK_BYTES):
                block = next(blocks)
                h, _, group = _windows(Words(part.column(text), lower=False), window, buckets)
                h, bounds, _, twice = _distinct(h, group, buckets)
                used = np.flatnonzero(np.diff(bounds))
                cuts = [slice(bounds[g], bounds[g + 1]) for g in used]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([spread(block, buckets), *used.tolist()], pa.int32()),
                        "block": pa.array([block] * (len(used) + 1), pa.int64()),
                        "hashes": pa.array([None, *(_pack(h[c], WIDTH) for c in cuts)], pa.binary()),
                        "twice": pa.array([None, *(np.packbits(twice[c]).tobytes() for c in cuts)], pa.binary()),
                        "texts": pa.array([to_bytes(part)] + [None] * len(used), pa.binary()),
                    }
                )

    return run


def _look_up(table: pa.Table) -> pa.Table:
    """The answer of one group to each of its blocks."""
    out: dict[str, list] = {"block": [], "bucket": [], "found": [], "refs": [], "texts": []}
    blocks, sent = table.column("block").to_pylist(), table.column("hashes").to_pylist()
    for block, texts in zip(blocks, table.column("texts").to_pylist(), strict=True):
        if texts is not None:
            for name, x in zip(out, (block, None, None, None, texts), strict=True):
                out[name].append(x)
    asked = sorted((b, i) for i, b in enumerate(blocks) if sent[i] is not None)
    if asked:
        values = [_unpack(sent[i], WIDTH) for _, i in asked]
        sizes = np.array([len(v) for v in values])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        bits = table.column("twice").to_pylist()
        twice = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8), count=n) for (_, i), n in zip(asked, sizes.tolist(), strict=True)])
        h = np.concatenate(values)
        source = np.repeat(np.array([b for b, _ in asked], np.int64), sizes)
        order = np.argsort(h, kind="stable")  # of equal windows the first block comes first
        h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        several = (np.diff(np.append(first, len(h))) > 1)[run]
        again = several | (twice[order] > 0)
        # All but the first block follow the first; it follows the second, or itself if there is none.
        ref = source[order[np.where(several, first[run] + new, np.arange(len(h)))]]
        found, refs = np.empty(len(h), bool), np.empty(len(h), np.int64)
        found[order], refs[order] = again, ref
        bucket = table.column("bucket")[0].as_py()
        for n, (block, _) in enumerate(asked):
            own = found[bounds[n] : bounds[n + 1]]
            if own.any():
                own_refs = _pack_refs(refs[bounds[n] : bounds[n + 1]][own])
                for name, x in zip(out, (block, bucket, np.packbits(own).tobytes(), own_refs, None), strict=True):
                    out[name].append(x)
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})


def _resolve(table: pa.Table, text: str, window: int, buckets: int) -> tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]:
    """A block's rows and words; for each window start whether it occurs elsewhere, and where."""
    texts = next(x for x in table.column("texts").to_pylist() if x is not None)
    batch = from_bytes(texts)
    words = Words(batch.column(text), lower=False)
    found = np.zeros(len(words), bool)
    refs = np.full(len(words), -1, np.int64)
    answers = table.filter(table.column("found").is_valid())
    if answers.num_rows:
        h, at, group = _windows(words, window, buckets)
        held, bounds, entry, _ = _distinct(h, group, buckets)
        elsewhere, where = np.zeros(len(held), bool), np.full(len(held), -1, np.int64)
        for g, bits, ref in zip(*(answers.column(c).to_pylist() for c in ("bucket", "found", "refs")), strict=True):
            own = np.arange(bounds[g], bounds[g + 1])
            hit = own[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)]
            elsewhere[hit], where[hit] = True, _unpack_refs(ref)
        found[at], refs[at] = elsewhere[entry], where[entry]
    return batch, words, found, refs


def parse(found: np.ndarray, refs: np.ndarray, row: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors: first word, number of words and reference block of each.

    A factor is a longest stretch of windows of one document that one block holds.
    """
    at = np.flatnonzero(found)
    if not len(at):
        return at, at, refs[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (refs[at[1:]] != refs[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    return at[first], windows + window - 1, refs[at[first]]


def _covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a factor."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:-1]) > 0


def _keep(words: Words, covered: np.ndarray) -> pa.Array:
    """The words of each row that are not covered, joined by one space."""
    kept = np.flatnonzero(~covered)
    size = words.ends[kept] - words.starts[kept]
    rows = np.searchsorted(kept, words.rows)
    last = np.zeros(len(kept), bool)
    last[rows[1:][rows[1:] > rows[:-1]] - 1] = True
    room = size + ~last
    ends = np.cumsum(room)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    to = np.repeat(ends - room - (np.cumsum(size) - size), size)
    inside = np.arange(int(size.sum()))
    take = np.repeat(words.starts[kept] - (np.cumsum(size) - size), size)
    out[inside + to] = words.data[inside + take]
    offsets = np.concatenate([[0], ends])[rows].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(rows) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _answers(docs: DataFrame, text: str, window: int, buckets: int | None) -> tuple[DataFrame, int]:
    buckets = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(_send(text, window, buckets), SENT)
    return sent.groupBy("bucket").applyInArrow(_look_up, ANSWER), buckets


def remove_repeats(
    docs: DataFrame, window: int = 35, text: str = "text", buckets: int | None = None, keep_layout: bool = False
) -> DataFrame:
    """The documents with repeated spans taken out, and n_words and n_removed of each.

    text becomes the kept words joined by one space; with keep_layout a text that loses
    nothing stays as it is, white space and null too. buckets: groups of the index, four times
    the shuffle partitions if unset.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed")]
    rows = docs.select(*(F.col(f"`{f.name}`") for f in kept))
    answers, buckets = _answers(rows, text, window, buckets)
    schema = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def finish(table: pa.Table) -> pa.Table:
        batch, words, found, refs = _resolve(table, text, window, buckets)
        start, length, _ = parse(found, refs, words.row, window)
        covered = _covered(start, length, len(words))
        removed = np.concatenate([[0], np.cumsum(covered)])[words.rows]
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns[text] = _keep(words, covered).cast(pa.string())
        if keep_layout:
            lost = pa.array(removed[1:] > removed[:-1])
            columns[text] = pc.if_else(lost, columns[text], batch.column(text).cast(pa.string()))
        return pa.table(columns | {"n_words": pa.array(np.diff(words.rows)), "n_removed": pa.array(np.diff(removed))})

    return answers.groupBy("block").applyInArrow(finish, schema)


def repeated_spans(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """The factors: doc_id, first word (from 0), number of words and the reference block."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    answers, buckets = _answers(rows, "text", window, buckets)

    def spans_of(table: pa.Table) -> pa.Table:
        batch, words, found, refs = _resolve(table, "text", window, buckets)
        row = words.row
        start, length, ref = parse(found, refs, row, window)
        return pa.table(
            {
                "doc_id": batch.column("doc_id").take(pa.array(row[start], pa.int64())),
                "first_word": pa.array(start - words.rows[row[start]], pa.int64()),
                "n_words": pa.array(length, pa.int64()),
                "block": pa.array(ref, pa.int64()),
            }
        )

    return answers.groupBy("block").applyInArrow(spans_of, "doc_id long, first_word long, n_words long, block long")
