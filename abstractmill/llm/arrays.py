"""Text columns as flat numpy arrays: words, hashes and n-grams without one Python object a word.

An Arrow string column is one byte buffer with offsets. Words are found, lower-cased and
hashed on that buffer with array operations, so a task spends tens of nanoseconds on a
word. Every helper works on slices of a bounded number of bytes (one text at least), so a
task's memory follows its longest text, not its partition.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

#: Bytes of text that are handled at once.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 5
#: Spans longer than this are hashed and compared one at a time.
LONG_SPAN = 64
#: A mask of the first n bytes of a lane, for n up to 8.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i below n, kept for the largest n so far."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        have = _POWERS[0] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser, one to one)."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def pieces(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes of text and 2 ** 16 rows each, or one row."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        to = min(to, at + (1 << 16))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - first


def block_numbers(partition: int) -> Iterator[int]:
    """Numbers of the blocks of a scan's partition, distinct over the table, in 63 bits."""
    return itertools.count(partition << 32)


def spread(number: int, groups: int) -> int:
    """A group for a block, whatever the pattern of the numbers."""
    return int(mix(np.array([number], np.uint64))[0]) % groups


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place, as one number (zeros follow the data)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded.data, strides=(1,))


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a string column.

    data: bytes; starts, ends: places of the words in it; rows: words of row i are those
    from rows[i] to rows[i + 1].
    """

    def __init__(self, column: pa.Array, lower: bool):
        self.data, offsets = text_bytes(column)
        if lower:
            self.data = LOWER[self.data]
        inside = ~SPACE[self.data]
        bound = np.zeros(len(inside) + 1, bool)
        bound[offsets] = True
        first = inside & bound[:-1]
        first[1:] |= inside[1:] & ~inside[:-1]
        last = inside & bound[1:]
        last[:-1] |= inside[:-1] & ~inside[1:]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.starts, self.ends)

    def strings(self) -> pa.Array:
        """The words as an Arrow array over the same bytes."""
        cuts = np.empty(2 * len(self) + 1, np.int32)
        cuts[0:-1:2], cuts[1::2], cuts[-1] = self.starts, self.ends, len(self.data)
        both = pa.Array.from_buffers(
            pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(self.data))]
        )
        return both

    def coded(self) -> tuple[np.ndarray, list[bytes]]:
        """An index for each word and the distinct words that the indexes mean."""
        if not len(self):
            return np.zeros(0, np.int64), []
        coded = self.strings().dictionary_encode()
        index = coded.indices.to_numpy()[::2]
        used = np.zeros(len(coded.dictionary), bool)
        used[index] = True
        number = np.cumsum(used) - 1
        return number[index], coded.dictionary.filter(pa.array(used)).to_pylist()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the bytes, eight bytes at a time."""
    sizes, held = ends - starts, lanes(data)
    h = mix(sizes.astype(np.uint64) + np.uint64(BASE))
    own = np.flatnonzero(sizes <= LONG_SPAN)
    at = 0
    while len(own):
        size = sizes[own] - at
        h[own] = mix(h[own] ^ (held[starts[own] + at] & FIRST[np.minimum(size, 8)]))
        at += 8
        own = own[size > 8]
    for i in np.flatnonzero(sizes > LONG_SPAN).tolist():
        h[i] = xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix(h + np.uint64(BASE))


def grams(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of word hashes that lie in one row, and where they start."""
    length = np.diff(rows)
    count = np.maximum(length - n + 1, 0)
    at = np.arange(int(count.sum()), dtype=np.int64) + np.repeat(rows[:-1] - (np.cumsum(count) - count), count)
    if n <= 8:
        h = words[at].copy()
        for j in range(1, n):
            h *= np.uint64(BASE)
            h += words[at + j]
    else:
        up, down = _powers(len(words) + 1)
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=total[1:])
        h = (total[at + n] - total[at]) * down[at]
    return mix(h), at


def shingles(words: np.ndarray, rows: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes of each row, ascending, and the offsets of the rows.

    A row with fewer words has its whole sequence as one shingle; without words, none.
    """
    h, at = grams(words, rows, n)
    length = np.diff(rows)
    row = np.searchsorted(rows, at, "right") - 1
    short = np.flatnonzero((length > 0) & (length < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            has = length[short] > j
            whole[has] = whole[has] * np.uint64(BASE) + words[rows[short[has]] + j]
        whole = mix(whole ^ mix(length[short].astype(np.uint64)))
        h, row = np.concatenate([h, whole]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(len(rows)))


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the half-open spans, one after the other."""
    length = ends - starts
    return np.arange(int(length.sum()), dtype=np.int64) + np.repeat(starts - (np.cumsum(length) - length), length)
