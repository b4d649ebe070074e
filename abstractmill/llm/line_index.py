"""Line dedup by a sharded minimal perfect hash over line hashes.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased;
keys of at least `least_chars` code points count. A key found in at least `min_docs`
documents loses all its lines except those of the largest doc_id that holds it.

*Hashes.* Each block of documents (a slice of about BLOCK_BYTES of text) sends each of its distinct
keys once, as 128 bits, with the number of its documents that hold it and their largest id, packed by
shard. A shard adds these up and keeps the distinct hashes found in `min_docs` documents or more.

*Index.* A `LineIndex` of a shard is a minimal perfect hash of these hashes: bit arrays in
levels, where a hash that has a bit of its level to itself stays and the others go on to the next level.
The rank of its bit is the place of a line in three compact arrays: a fingerprint of 64 bits, the
number of documents, and the largest id. No key is stored.

*Probes.* The blocks' hashes of that shard are then looked up in the arrays, block by
block: a hash whose bits lead nowhere, or to another fingerprint, is not in the index.
What is found goes back to the block, whose lines are dropped there. Lines are never joined with lines.

`line_indexes` returns the index alone, one row per shard; `LineIndex.from_bytes` reads it.

Defined cases: a null or empty text is one empty line and comes back empty; every row is a document, so
repeated rows count each; all rows of the largest id keep their lines (ties); a null id is smaller
than any other, and if all holders have none, all keep their lines; a text is split at every \\n, so a
last \\n is kept, as are the white space and case of lines that stay; other columns are carried,
also ones named like added columns, which are then replaced; an empty table gives no row.

Scale: texts are read once, travel compressed with their block and are never grouped by line. A line that
a third of all documents hold is one hash per block. Blocks are numbered in 64 bits. A task holds one block,
or the hashes of one shard; there are four times as many shards as shuffle partitions. Two
keys count as one line only if 128 bits of their hashes agree; a key that is not in the index is taken for one
that is only if its place and 64 bits agree with one entry's.
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
from xxhash import xxh3_128_digest

from .arrays import LOWER, SPACE, block_numbers, mix, pieces, spread, text_bytes
from .rlz import from_bytes, to_bytes

BLOCK_BYTES = 2 << 20
#: Bits of a level for each hash that reaches it.
BITS_PER_HASH = 2
NO_ID = np.iinfo(np.int64).min
SENT = "shard int, block long, hashes binary, counts binary, ids binary, texts binary"
ANSWER = "block long, shard int, found binary, ids binary, texts binary"
INDEX = "shard int, lines long, parts binary"


class LineIndex:
    """Minimal perfect hash of distinct 128-bit hashes, with an array entry for each of them.

    hashes: rows of two 64-bit numbers. The order of the entries is `place`.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.fingerprints, self.counts, self.ids = fingerprints, counts, ids
        ones = np.bitwise_count(bits)
        self.rank = np.cumsum(ones, dtype=np.int64) - ones  # bits set before each word of 64
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @staticmethod
    def _bit(h: np.ndarray, level: int, size: int) -> np.ndarray:
        """The bit of each hash in a level of `size` words of 64 bits."""
        step = np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
        return (mix(mix(h[:, 0] ^ step) + h[:, 1]) % np.uint64(64 * size)).astype(np.int64)

    @staticmethod
    def fingerprint(h: np.ndarray) -> np.ndarray:
        return mix(h[:, 1] + np.uint64(0xA0761D6478BD642F))

    @classmethod
    def build(cls, h: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> LineIndex:
        """An index of distinct hashes; counts and ids are given in their order."""
        sizes, words, place, done, left = [], [], np.zeros(len(h), np.int64), 0, np.arange(len(h))
        while len(left):
            size = max(1, -(-BITS_PER_HASH * len(left) // 64))
            bit = cls._bit(h[left], len(sizes), size)
            hits = np.bincount(bit, minlength=64 * size)
            alone = hits[bit] == 1
            level = np.packbits(hits == 1, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(hits == 1)])
            place[left[alone]] = done + before[bit[alone]]
            done += int(alone.sum())
            sizes.append(size)
            words.append(level)
            left = left[~alone]
        at = np.empty(len(h), np.int64)
        at[place] = np.arange(len(h))
        bits = np.concatenate([np.zeros(0, np.uint64), *words])
        return cls(np.array(sizes, np.int64), bits, cls.fingerprint(h)[at], counts[at].astype(np.int64), ids[at].astype(np.int64))

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where it is not in the index."""
        entry = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            bit = self._bit(h[left], level, size)
            word, inside = self.first[level] + (bit >> 6), (bit & 63).astype(np.uint64)
            held = self.bits[word]
            there = (held >> inside) & np.uint64(1) == 1
            below = np.bitwise_count(held & ((np.uint64(1) << inside) - np.uint64(1)))
            entry[left[there]] = (self.rank[word] + below)[there]
            left = left[~there]
        found = np.flatnonzero(entry >= 0)
        other = self.fingerprints[entry[found]] != self.fingerprint(h[found])
        entry[found[other]] = -1
        return entry

    def to_bytes(self) -> bytes:
        """The arrays; a level costs 2 bits a hash that reaches it, an entry 24 bytes."""
        parts = (self.sizes, self.bits, self.fingerprints, self.counts, self.ids)
        return to_bytes(pa.RecordBatch.from_pydict({str(i): pa.array([x.tobytes()], pa.binary()) for i, x in enumerate(parts)}))

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        batch = from_bytes(data)
        kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int64)
        return cls(*(np.frombuffer(batch.column(str(i))[0].as_py(), k) for i, k in enumerate(kinds)))


class Lines:
    """The lines of a slice of texts.

    rows: lines of row i are those from rows[i] to rows[i + 1]; keyed: the lines that have a key;
    hashes: its hash, two numbers for each of them.
    """

    def __init__(self, column: pa.Array, least_chars: int):
        self.data, self.offsets = text_bytes(column)
        data, offsets = self.data, self.offsets
        # A row's lines begin at its start and after each \n; they end before the next line of the row.
        breaks = np.flatnonzero(data == 0x0A)
        row_of = np.searchsorted(offsets, breaks, "right") - 1
        order = np.argsort(np.concatenate([np.arange(len(offsets) - 1), row_of]), kind="stable")
        self.starts = np.concatenate([offsets[:-1], breaks + 1])[order]
        self.rows = np.arange(len(offsets)) + np.concatenate([[0], np.cumsum(np.bincount(row_of, minlength=len(offsets) - 1))])
        self.ends = np.empty(len(self.starts), np.int64)
        self.ends[:-1] = self.starts[1:] - 1
        self.ends[self.rows[1:] - 1] = offsets[1:]
        # The key lies between the first and the last byte that is no white space.
        solid = np.flatnonzero(~SPACE[data])
        low, high = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        some = np.flatnonzero(high > low)
        begin, end = solid[low[some]], solid[high[some] - 1] + 1
        trail = np.flatnonzero((data & 0xC0) == 0x80)
        chars = end - begin - (np.searchsorted(trail, end) - np.searchsorted(trail, begin))
        enough = chars >= least_chars
        self.keyed = some[enough]
        lower = LOWER[data].tobytes()
        digests = [xxh3_128_digest(lower[a:b]) for a, b in zip(begin[enough].tolist(), end[enough].tolist(), strict=True)]
        self.hashes = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        self.row = np.searchsorted(self.rows, self.keyed, "right") - 1

    def distinct(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes in the order of their shards, bounds of the shards, and the entry of each keyed line."""
        shard = self.shard(self.hashes, shards)
        order = np.lexsort((self.hashes[:, 1], self.hashes[:, 0], shard))
        h = self.hashes[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]).any(axis=1)
        entry = np.empty(len(h), np.int64)
        entry[order] = np.cumsum(new) - 1
        return h[new], np.searchsorted(shard[order][new], np.arange(shards + 1)), entry

    @staticmethod
    def shard(h: np.ndarray, shards: int) -> np.ndarray:
        return (((mix(h[:, 0] ^ h[:, 1]) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False)


def _send(text: str, doc_id: str, least_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = block_numbers(TaskContext.get().partitionId())
        for batch in batches:
            for part in pieces(batch, text, BLOCK_BYTES):
                block = next(blocks)
                lines = Lines(part.column(text), least_chars)
                h, bounds, entry = lines.distinct(shards)
                # Each document counts once for a key, whatever the number of its lines.
                once = np.unique(entry * part.num_rows + lines.row)
                counts = np.bincount(once // part.num_rows, minlength=len(h)).astype(np.uint32)
                ids = np.full(len(h), NO_ID, np.int64)
                np.maximum.at(ids, entry, _ids(part.column(doc_id))[lines.row])
                used = np.flatnonzero(np.diff(bounds))
                cuts = [slice(bounds[s], bounds[s + 1]) for s in used]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([spread(block, shards), *used.tolist()], pa.int32()),
                        "block": pa.array([block] * (len(used) + 1), pa.int64()),
                        **{
                            name: pa.array([None, *(values[c].tobytes() for c in cuts)], pa.binary())
                            for name, values in (("hashes", h), ("counts", counts), ("ids", ids))
                        },
                        "texts": pa.array([to_bytes(part)] + [None] * len(used), pa.binary()),
                    }
                )

    return run


def _shard_index(sent: pa.Table, min_docs: int) -> LineIndex:
    """The index of the lines of one shard that are found in `min_docs` documents or more."""
    h, counts, ids = (
        np.frombuffer(b"".join(sent.column(name).to_pylist()), kind) for name, kind in (("hashes", np.uint64), ("counts", np.uint32), ("ids", np.int64))
    )
    h = h.reshape(-1, 2)
    order = np.lexsort((h[:, 1], h[:, 0]))
    h, counts, ids = h[order], counts[order], ids[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]).any(axis=1)]))
    if not len(first):
        return LineIndex.build(h, counts, ids)
    total, largest = np.add.reduceat(counts.astype(np.int64), first), np.maximum.reduceat(ids, first)
    kept = total >= min_docs
    return LineIndex.build(h[first[kept]], total[kept], largest[kept])


def _probe(min_docs: int):
    def run(table: pa.Table) -> pa.Table:
        whole = table.filter(table.column("texts").is_valid())
        out: dict[str, list] = {
            "block": whole.column("block").to_pylist(),
            "shard": [None] * whole.num_rows,
            "found": [None] * whole.num_rows,
            "ids": [None] * whole.num_rows,
            "texts": whole.column("texts").to_pylist(),
        }
        sent = table.filter(table.column("hashes").is_valid())
        if sent.num_rows:
            index, shard = _shard_index(sent, min_docs), sent.column("shard")[0].as_py()
            for block, hashes in zip(sent.column("block").to_pylist(), sent.column("hashes").to_pylist(), strict=True):
                entry = index.look_up(np.frombuffer(hashes, np.uint64).reshape(-1, 2))
                held = entry >= 0
                if held.any():
                    row = (block, shard, np.packbits(held).tobytes(), index.ids[entry[held]].tobytes(), None)
                    for name, x in zip(out, row, strict=True):
                        out[name].append(x)
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})

    return run


def _without(lines: Lines, dropped: np.ndarray) -> pa.Array:
    """The texts of the lines that stay, joined by \\n."""
    kept = np.flatnonzero(~dropped)
    rows = np.searchsorted(kept, lines.rows)
    last = np.zeros(len(kept), bool)
    last[rows[1:][rows[1:] > rows[:-1]] - 1] = True
    size = lines.ends[kept] - lines.starts[kept]
    ends = np.cumsum(size + ~last)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x0A, np.uint8)
    step = np.cumsum(size) - size
    inside = np.arange(int(size.sum()))
    out[inside + np.repeat(ends - size - ~last - step, size)] = lines.data[inside + np.repeat(lines.starts[kept] - step, size)]
    offsets = np.concatenate([[0], ends])[rows].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(rows) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _sent(docs: DataFrame, least_chars: int, doc_id: str, text: str, shards: int | None) -> tuple[DataFrame, int]:
    shards = shards or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.mapInArrow(_send(text, doc_id, least_chars, shards), SENT), shards


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """The documents without lines that repeat, and n_lines and n_dropped of each.

    shards: groups of line hashes, four times the shuffle partitions if unset.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")]
    rows = docs.select(*(F.col(f"`{f.name}`") for f in kept))
    sent, shards = _sent(rows, least_chars, doc_id, text, shards)
    answers = sent.groupBy("shard").applyInArrow(_probe(min_docs), ANSWER)
    schema = T.StructType([*kept, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def finish(table: pa.Table) -> pa.Table:
        batch = from_bytes(next(x for x in table.column("texts").to_pylist() if x is not None))
        lines = Lines(batch.column(text), least_chars)
        dropped = np.zeros(len(lines.starts), bool)
        found = table.filter(table.column("found").is_valid())
        if found.num_rows:
            h, bounds, entry = lines.distinct(shards)
            held, keeper = np.zeros(len(h), bool), np.zeros(len(h), np.int64)
            for shard, bits, ids in zip(*(found.column(c).to_pylist() for c in ("shard", "found", "ids")), strict=True):
                at = bounds[shard] + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=bounds[shard + 1] - bounds[shard]))
                held[at], keeper[at] = True, np.frombuffer(ids, np.int64)
            dropped[lines.keyed] = held[entry] & (keeper[entry] != _ids(batch.column(doc_id))[lines.row])
        gone = np.concatenate([[0], np.cumsum(dropped)])[lines.rows]
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns[text] = _without(lines, dropped)
        return pa.table(columns | {"n_lines": pa.array(np.diff(lines.rows)), "n_dropped": pa.array(np.diff(gone))})

    return answers.groupBy("block").applyInArrow(finish, schema)


def line_indexes(
    docs: DataFrame, least_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """The index alone: shard, number of lines and the arrays of each shard that has lines."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sent, _ = _sent(rows, least_chars, "doc_id", "text", shards)

    def build(table: pa.Table) -> pa.Table:
        index = _shard_index(table, min_docs)
        held = [index] if len(index.ids) else []
        return pa.table(
            {
                "shard": pa.array([table.column("shard")[0].as_py()] * len(held), pa.int32()),
                "lines": pa.array([len(x.ids) for x in held], pa.int64()),
                "parts": pa.array([x.to_bytes() for x in held], pa.binary()),
            }
        )

    return sent.drop("texts").filter("hashes IS NOT NULL").groupBy("shard").applyInArrow(build, INDEX)
