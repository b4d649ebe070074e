"""Exact nearest neighbours by a block matrix join with int8 tiles.

Vectors are numbered and coded once. A vector u of length 1 is u = s * code + e with int8 codes, its
scale s and what the code leaves out, e. Queries and candidates are cut into blocks by a hash of their
row number; each pair of a query block and a candidate block is one tile, joined on (query block,
candidate block), and gets codes, scales and lengths of e alone. In a tile the codes are multiplied as
one matrix product (products of int8 codes of some thousand components are whole numbers that
float32 holds exactly). A product of two vectors differs from s * s' * (code . code') by at most
|u'| |e| + |s code| |e'|: a candidate survives a tile unless its highest possible value lies below
the k-th lowest possible value of the query there (of equal vectors, told by 128-bit hashes, k + 1 with the
smallest ids are looked at), and of these the ones stay that are not
below the k-th lowest value over all tiles. For them the original vectors are fetched by row
number and the cosine is computed in double precision; heaps of k per query and batch cut the rows
that a ranked window merges.

No candidate is lost, so recall is 1: the k best by (cosine descending, id ascending).

Defined cases: vectors that are null, zero, of a length other than `dim`, or hold a null or
non-finite component take no part, nor do rows with a null id; a query is never its own candidate;
fewer candidates than k give fewer rows; equal cosines go to the smaller id, in the tiles too; rows
that repeat an id are rows of their own: each such query has its own k rows of the result, and another
row with the query's id is a candidate; an empty table gives no row.

Scale: work is queries x rows / tile, as a stated query set against all rows asks; a tile
holds about query_block x row_block codes whatever the input, also where an id comes on many rows, and a
popular vector adds survivors inside its tiles only. Vectors in doubles move only for survivors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xxhash import xxh3_128_digest

from .stored import discard, stored

CODED = "row long, vec_id long, query boolean, v array<double>, code binary, scale double, rest double, same binary"
BLOCK = "block int, rows binary, ids binary, codes binary, scales binary, rests binary, sames binary"
SURVIVORS = "query_row long, row long, low double, high double"
SCORED = "query_row long, query_id long, row long, vec_id long, score double"


def _usable(df: DataFrame, is_query: Column, vec_id: str, embedding: str, dim: int) -> DataFrame:
    """Row numbers, ids and vectors (as doubles) that take part."""
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.filter(F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) == dim) & fine).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
        v.cast("array<double>").alias("v"),
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dim)


def _coded(dim: int):
    """Rows with their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), dim)
                code, scale, rest = _codes(v)
                columns = {c: batch.column(c) for c in ("row", "vec_id", "query", "v")}
                columns |= {"code": pa.array([x.tobytes() for x in code], pa.binary()), "scale": pa.array(scale), "rest": pa.array(rest)}
                columns["same"] = pa.array([xxh3_128_digest((x + 0.0).tobytes()) for x in v], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded rows of each Arrow batch as one row for each block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        numbers = [batch.column(c).to_numpy() for c in ("row", "vec_id", "scale", "rest")]
        codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.int8).reshape(len(block), -1)
        sames = np.frombuffer(b"".join(batch.column("same").to_pylist()), np.uint64).reshape(len(block), 2)
        found = np.unique(block)
        places = [np.flatnonzero(block == b) for b in found]
        out = {"block": pa.array(found, pa.int32())}
        for name, values in zip(("rows", "ids", "codes", "scales", "rests", "sames"), (*numbers[:2], codes, *numbers[2:], sames), strict=True):
            out[name] = pa.array([values[p].tobytes() for p in places], pa.binary())
        yield pa.RecordBatch.from_pydict(out)


def _codes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales and the lengths of what the codes leave out."""
    # Scaling by the largest component first keeps squares of huge and tiny components finite.
    v = v / np.abs(v).max(axis=1, keepdims=True)
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    scale = np.abs(u).max(axis=1) / 127
    code = np.rint(u / scale[:, None]).astype(np.int8)
    left = u - scale[:, None] * code
    return code, scale, np.sqrt((left * left).sum(axis=1)) + 1e-12


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision, components added in order."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        aa += a[:, j] * a[:, j]
        bb += b[:, j] * b[:, j]
    with np.errstate(all="ignore"):
        out = dot / (np.sqrt(aa) * np.sqrt(bb))
    odd = ~np.isfinite(out) | (aa < 1e-200) | (bb < 1e-200) | ~np.isfinite(aa * bb)
    if odd.any():
        x, y = (z[odd] / np.abs(z[odd]).max(axis=1, keepdims=True) for z in (a, b))
        out[odd] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    return out


Side = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _side(table: pa.Table, dim: int, copies: int | None = None) -> Side:
    """Rows, ids, codes, scales and rests of one side of a tile, by id; of equal vectors the first `copies` if given."""
    kinds = {"rows": np.int64, "ids": np.int64, "codes": np.int8, "scales": np.float64, "rests": np.float64}
    held = [np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in kinds.items()]
    held[2] = held[2].reshape(-1, dim)
    order = np.lexsort((held[0], held[1]))
    if copies is not None:
        same = np.frombuffer(b"".join(table.column("sames").to_pylist()), np.uint64).reshape(-1, 2)[order]
        alike = np.lexsort((np.arange(len(same)), same[:, 1], same[:, 0]))
        first = np.flatnonzero(np.concatenate([[True], (same[alike][1:] != same[alike][:-1]).any(axis=1)]))
        nth = np.arange(len(same)) - np.repeat(first, np.diff(np.append(first, len(same))))
        order = order[np.sort(alike[nth < copies])]
    return tuple(x[order] for x in held)


def _tile(queries: Side, rows: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query row, row, lowest and highest cosine of the candidates that may be among the k best in one tile."""
    q_rows, _, qc, qs, qe = queries
    rows_, _, vc, vs, ve = rows
    right = vc.astype(np.float32).T
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(q_rows), 128):
        part = slice(at, at + 128)
        near = (qc[part].astype(np.float32) @ right) * (qs[part, None] * vs[None, :])
        # |u| = 1 and |s code| <= 1 + |e|; a little more for the float32 scale.
        slack = qe[part, None] + ve[None, :] * (1 + qe[part, None]) + 1e-6
        own = q_rows[part, None] == rows_[None, :]
        low = np.where(own, -np.inf, near - slack)
        least = np.partition(low, -k, axis=1)[:, -k] if len(rows_) > k else np.full(len(low), -np.inf)
        high = near + slack
        i, j = np.nonzero((high >= least[:, None]) & ~own)
        found.append((q_rows[part][i], rows_[j], low[i, j], high[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _exact(dim: int, k: int):
    """Cosines of pairs of vectors; of a batch the k best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = exact_cosine(_matrix(batch.column("q"), dim), _matrix(batch.column("v"), dim))
            heaps: dict[int, list] = {}
            ids, rows = batch.column("vec_id").to_pylist(), batch.column("row").to_pylist()
            for n, (query, s) in enumerate(zip(batch.column("query_row").to_pylist(), score.tolist(), strict=True)):
                entry, heap = (s, -ids[n], -rows[n], n), heaps.setdefault(query, [])
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, entry)
            kept = pa.array(sorted(e[-1] for heap in heaps.values() for e in heap), pa.int64())
            columns = {c: batch.column(c) for c in ("query_row", "query_id", "row", "vec_id")} | {"score": pa.array(score)}
            yield pa.RecordBatch.from_pydict({c: x.take(kept) for c, x in columns.items()})

    return run


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    dim: int = 64,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    query_blocks: int | None = None,
    row_blocks: int | None = None,
    block_rows: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k nearest rows by cosine.

    is_query: a condition on the id column. query_blocks and row_blocks: blocks of either
    side; unset, as many as blocks of about block_rows vectors need.
    """
    coded = stored(_usable(df, is_query, vec_id, embedding, dim).mapInArrow(_coded(dim), CODED), "coded-vectors")
    if query_blocks is None or row_blocks is None:
        n_rows, n_queries = coded.agg(F.count("*"), F.count_if("query")).first()
        row_blocks = row_blocks or -(-n_rows // block_rows) or 1
        query_blocks = query_blocks or -(-n_queries // block_rows) or 1

    def blocks(side: DataFrame, n: int) -> DataFrame:
        place = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("block")
        return side.select(place, "row", "vec_id", "code", "scale", "rest", "same").mapInArrow(_pack, BLOCK)

    # Each block goes to every tile of its row or column of the grid.
    held = ("rows", "ids", "codes", "scales", "rests", "sames")
    left = blocks(coded.filter("query"), query_blocks).select(
        F.col("block").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"), *held
    )
    right = blocks(coded, row_blocks).select(
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), F.col("block").alias("rb"), *held
    )

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        columns = ([], [], [], [])
        if a.num_rows and b.num_rows:
            # Of equal vectors only those with the smallest ids can be among the k best; one may be the query's own row.
            columns = _tile(_side(a, dim), _side(b, dim, copies=k + 1), k)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ("query_row", "row", "low", "high")
        return pa.table({n: pa.array(x, kind) for n, x, kind in zip(names, columns, kinds, strict=True)})

    survivors = stored(left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(tile, SURVIVORS), "survivors")
    by_low = Window.partitionBy("query_row").orderBy(F.desc("low"), "row")
    least = survivors.withColumn("nth", F.row_number().over(by_low)).filter(F.col("nth") == k).select("query_row", F.col("low").alias("least"))
    near = survivors.join(least, "query_row", "left").filter(F.col("least").isNull() | (F.col("high") >= F.col("least")))
    queries = coded.filter("query").select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    both = near.select("query_row", "row").join(coded.select("row", "vec_id", "v"), "row").join(queries, "query_row")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = both.mapInArrow(_exact(dim, k), SCORED).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = stored(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "nearest")
    discard(coded, survivors)
    return found
