"""Vector code compression: product codes by exact integer clustering of Hilbert-sorted blocks.

Components become whole numbers floor(scale * x); vectors are cut into `parts` equal parts. Each
part position has a codebook that starts as that part of the `entries` smallest ids and is
improved in `rounds` rounds: every part goes to the nearest entry (squared Euclidean distance,
ties to the lower index), then an entry becomes the componentwise floor(sum / count) of its
parts; unused entries stay. A last assignment gives the codes.

*Blocks.* The parts of each position are sorted along a Hilbert curve (over cells between
quantiles of the first codebook) by a range exchange, so near parts lie side by side, and
stored in flat blocks of at most BLOCK_ROWS of them, each with the minimum and maximum of every
component (its box) and the sums of its components.

*Rounds.* For a block, the least and the largest distance from the box to each entry are
computed. Entries whose least distance is above the smallest of the largest distances can be nearest
to no part of the block; the others are its shortlist, in which every tie is kept. A shortlist of
one takes the whole block: its stored sums are added and no part is looked at. Otherwise the
parts are compared with the shortlist by a small kernel in whole numbers: as products in doubles
where all results are below 2 ** 53, and so exact, else as differences in 64-bit integers.
A task adds up one table of sums and counts; Spark adds up the tables.

Defined cases: vectors that are null, of a length other than `dim`, or hold a null or
non-finite component are dropped; fewer vectors than entries give a shorter codebook; of equal
ids the smaller vector comes first, null ids come last; repeated rows each give a row; null
labels are one label; components of 2 ** 29 / sqrt(dim) or more after scaling are an error, as squared
distances would not fit 64 bits; an empty table gives no row; other columns are ignored.

Scale: one exchange of the parts (by range, with the row number as last key, so that equal
vectors spread over tasks), rounds read the blocks in place and send one table of codebook size
per task, one exchange brings the codes of a row together. The driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stored import discard, stored

BLOCK_ROWS = 128
#: Doubles hold whole numbers below this exactly.
EXACT = 1 << 53


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (whole numbers of `bits` bits) on a Hilbert curve.

    The cells are turned into the transposed curve index by Skilling's exchange of axes, most
    significant bit first, and its bits are then interleaved.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[:, i] & q) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = top
    while q > 1:
        flip ^= np.where((x[:, n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


class Codebook:
    """The entries of one part position, as rows of whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.doubles = entries.astype(np.float64)
        self.norms = (self.doubles**2).sum(axis=1)
        self.largest = int(np.abs(self.entries).max(initial=0))

    def shortlist(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries that may be nearest to a vector in the box, ascending."""
        e = self.entries
        outside = np.maximum(np.maximum(low - e, e - high), 0)
        across = np.maximum(e - low, high - e)
        least, most = (outside * outside).sum(axis=1), (across * across).sum(axis=1)
        return np.flatnonzero(least <= most.min())

    def nearest(self, x: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of the shortlist to each row of x, and its squared distance."""
        largest = max(self.largest, int(np.abs(x).max(initial=0)))
        if 4 * x.shape[1] * largest**2 < EXACT:
            v = x.astype(np.float64)
            far = (v**2).sum(axis=1)[:, None] - 2 * (v @ self.doubles[short].T) + self.norms[short]
        else:
            far = np.stack([((x - e) ** 2).sum(axis=1) for e in self.entries[short]], axis=1)
        best = far.argmin(axis=1)  # the first of equal ones
        return short[best], far[np.arange(len(x)), best].astype(np.int64)


def _whole(flat: np.ndarray, dim: int, scale: int) -> np.ndarray:
    x = np.floor(flat.astype(np.float64) * scale).reshape(-1, dim)
    if len(x) and np.abs(x).max() * dim**0.5 >= 1 << 29:
        raise ValueError("components too large: squared distances would not fit 64 bits")
    return x.astype(np.int64)


def usable(df: DataFrame, dim: int, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and v (doubles) of the vectors that are not dropped."""
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(v.isNotNull() & (F.size(v) == dim) & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.cast("array<double>").alias("v")
    )


def first_codebooks(rows: DataFrame, dim: int, parts: int, entries: int, scale: int) -> list[Codebook]:
    """The parts of the vectors with the smallest ids."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    held = rows.select("vec_id", "v").orderBy(*order).limit(entries).collect()
    x = _whole(np.array([r["v"] for r in held]).reshape(-1, dim), dim, scale)
    return [Codebook(p) for p in np.split(x, parts, axis=1)]


def _cells(width: int) -> tuple[int, int]:
    """Components that order the blocks, and bits of each of their cells."""
    used = min(width, 63)
    return used, 63 // used if used > 7 else 8


def sorted_blocks(rows: DataFrame, books: list[Codebook], dim: int, scale: int) -> DataFrame:
    """The parts of all vectors in Hilbert order, in flat blocks with boxes and sums."""
    parts, width = len(books), dim // len(books)
    used, bits = _cells(width)
    quantiles = np.arange(1, 1 << bits) / (1 << bits)
    cuts = [np.quantile(b.entries[:, :used], quantiles, axis=0) if len(b.entries) else np.zeros((len(quantiles), used)) for b in books]
    label = rows.schema["label"].dataType

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _whole(batch.column("v").flatten().to_numpy(), dim, scale)
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                cells = np.stack([np.searchsorted(cuts[p][:, d], own[:, d], "right") for d in range(used)], axis=1)
                carried = {c: batch.column(c) if not p else pa.nulls(n, batch.column(c).type) for c in ("vec_id", "label")}
                flat = np.ascontiguousarray(own.astype(np.int32)).tobytes()
                size = 4 * width
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(n, p, np.int32)),
                        "key": pa.array(hilbert_keys(cells, bits)),
                        "row": batch.column("row"),
                        **carried,
                        "x": pa.array([flat[i : i + size] for i in range(0, n * size, size)], pa.binary()),
                    }
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            edges = np.flatnonzero(np.diff(part)) + 1
            bounds = [0, *edges.tolist(), len(part)]
            cuts_ = [(a, min(a + BLOCK_ROWS, hi)) for lo, hi in zip(bounds, bounds[1:]) for a in range(lo, hi, BLOCK_ROWS)]
            if not len(part):
                continue
            out: dict[str, list] = {c: [] for c in ("part", "low", "high", "sums", "x", "rows", "ids", "labels")}
            for a, b in cuts_:
                rows_ = batch.slice(a, b - a)
                data = b"".join(rows_.column("x").to_pylist())
                x = np.frombuffer(data, np.int32).reshape(-1, width).astype(np.int64)
                own = int(part[a])
                held = (own, x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), x.sum(axis=0).tobytes(), data, rows_.column("row").to_numpy().tobytes())
                for name, value in zip(out, held):
                    out[name].append(value)
                out["ids"].append([] if own else rows_.column("vec_id").to_pylist())
                out["labels"].append([] if own else rows_.column("label").to_pylist())
            kinds = (pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(batch.column("label").type))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    fields = [("part", T.IntegerType()), ("key", T.LongType()), ("row", T.LongType()), ("vec_id", T.LongType()), ("label", label), ("x", T.BinaryType())]
    cut = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(split, T.StructType([T.StructField(n, t) for n, t in fields]))
    packed = [("part", T.IntegerType()), *((n, T.BinaryType()) for n in ("low", "high", "sums", "x", "rows"))]
    packed += [("ids", T.ArrayType(T.LongType())), ("labels", T.ArrayType(label))]
    order = ("part", "key", "row")
    blocks = cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, T.StructType([T.StructField(n, t) for n, t in packed]))
    return stored(blocks, "vector-blocks")


def _numbers(data: bytes, width: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width).astype(np.int64)


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def entry_sums(blocks: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """part, entry, number of its parts (n) and their sums (s0, s1, ..), of the entries in use."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    most = max(len(b.entries) for b in books)
    names = [f"s{d}" for d in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros((len(books), most, width), np.int64), np.zeros((len(books), most), np.int64)
        for batch in batches:
            for p, low, high, total, data in _columns(batch, "part", "low", "high", "sums", "x"):
                short = books[p].shortlist(_numbers(low, width), _numbers(high, width))
                if len(short) == 1:
                    sums[p, short[0]] += _numbers(total, width)[0]
                    counts[p, short[0]] += len(data) // (4 * width)
                    continue
                x = _numbers(data, width, np.int32)
                code, _ = books[p].nearest(x, short)
                order = np.argsort(code, kind="stable")
                entry, first = np.unique(code[order], return_index=True)
                sums[p, entry] += np.add.reduceat(x[order], first, axis=0)
                counts[p, entry] += np.diff(np.append(first, len(x)))
        part, entry = np.nonzero(counts)
        columns = {"part": pa.array(part.astype(np.int32)), "entry": pa.array(entry.astype(np.int32)), "n": pa.array(counts[part, entry])}
        yield pa.RecordBatch.from_pydict(columns | {c: pa.array(sums[part, entry, d]) for d, c in enumerate(names)})

    schema = "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names)
    tables = blocks.select("part", "low", "high", "sums", "x").mapInArrow(add, schema)
    return tables.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names))


def trained(blocks: DataFrame, books: list[Codebook], width: int, rounds: int) -> list[Codebook]:
    """The codebooks after the given rounds."""
    for _ in range(rounds):
        entries = [b.entries.copy() for b in books]
        for part, entry, n, *sums in entry_sums(blocks, books, width).collect():  # at most all entries of the codebooks
            entries[part][entry] = [s // n for s in sums]
        books = [Codebook(e) for e in entries]
    return books


def assigned(blocks: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """row, part, code and error of every part, with id and label at part 0."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    label = blocks.schema["labels"].dataType.elementType

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            ids, labels = batch.column("ids"), batch.column("labels")
            for i, (p, low, high, data, rows) in enumerate(_columns(batch, "part", "low", "high", "x", "rows")):
                x = _numbers(data, width, np.int32)
                code, error = books[p].nearest(x, books[p].shortlist(_numbers(low, width), _numbers(high, width)))
                n = len(x)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(np.frombuffer(rows, np.int64)),
                        "part": pa.array(np.full(n, p, np.int32)),
                        "code": pa.array(code.astype(np.int32)),
                        "error": pa.array(error),
                        "vec_id": ids[i].values if not p else pa.nulls(n, pa.int64()),
                        "label": labels[i].values if not p else pa.nulls(n, labels.type.value_type),
                    }
                )

    fields = [("row", T.LongType()), ("part", T.IntegerType()), ("code", T.IntegerType()), ("error", T.LongType())]
    fields += [("vec_id", T.LongType()), ("label", label)]
    return blocks.select("part", "low", "high", "x", "rows", "ids", "labels").mapInArrow(assign, T.StructType([T.StructField(n, t) for n, t in fields]))


def codebook_text(books: list[Codebook]) -> str:
    """All components by part, entry and place, as decimal numbers joined by commas."""
    return ",".join(str(x) for b in books for x in b.entries.ravel().tolist())


def _hex(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 2, "0"))


def compressed(
    df: DataFrame,
    dim: int = 64,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, list[Codebook]]:
    """vec_id, label, code and error of every vector that is not dropped, and the codebooks.

    entries: at most 256, as a code has two hex digits per part. dim: a multiple of parts.
    """
    if dim % parts or not 0 < entries <= 256:
        raise ValueError("dim must be a multiple of parts, entries at most 256")
    rows = usable(df, dim, vec_id, embedding, label)
    books = first_codebooks(rows, dim, parts, entries, scale)
    width = dim // parts
    blocks = sorted_blocks(rows, books, dim, scale)
    books = trained(blocks, books, width, rounds)
    at = {p: F.col("part") == p for p in range(parts)}
    codes = assigned(blocks, books, width).groupBy("row").agg(
        F.max(F.when(at[0], F.col("vec_id"))).alias("vec_id"),
        F.max(F.when(at[0], F.col("label"))).alias("label"),
        F.concat(*(F.max(F.when(at[p], _hex(F.col("code")))) for p in range(parts))).alias("code"),
        F.sum("error").alias("error"),
    )
    out = stored(codes.select("vec_id", "label", "code", "error"), "vector-codes")
    discard(blocks)
    return out, books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """The codes with label_error, the errors of all vectors of the label together."""
    total = codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("same"))).select("vec_id", "code", "error", "label_error")


def codebooks_sha256(books: list[Codebook]) -> str:
    return hashlib.sha256(codebook_text(books).encode()).hexdigest()
