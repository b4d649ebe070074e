"""Best-fit packing with patterns fitted by non-negative least squares.

Documents are token ids and a closing id; only those longer than a sequence are cut, so
that all pieces but the first are full. The rest works on the histogram of piece lengths,
which has at most `capacity` bins however many documents there are:

1. patterns of a few lengths that fill a sequence are enumerated from the lengths present;
2. repeat counts x >= 0 that minimise |A x - histogram| are fitted (accelerated projected
   gradient; A counts each length in each pattern), rounded, and cut to what is there;
3. what is left is packed best-fit, longest first, on counts of equal gaps.

The result is a table of runs: the pieces of one length whose ranks lie in [first, last) take
consecutive sequences from `sequence` at one offset. A piece finds its run by its rank
among the pieces of its length.

Defined cases: a null or empty text is the closing id alone; null and repeated ids are
carried as they are, each row its own document; other columns are ignored; an empty table
gives no piece.

Scale: texts are read once and not shuffled; pieces (a few numbers each) are stored. Ranks are
counted within each task and shifted by sums over (task, length), so a length that a third
of the pieces has is not dealt to one task. The plan is bounded by the capacity alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import pieces
from .bpe import merges, row_ids
from .stored import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Lengths that stand for the histogram when patterns of three or four are enumerated.
PIVOTS = 5
#: Patterns fill at least this share of a sequence; lengths in no such pattern are packed best-fit.
TIGHT = 0.98


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece: its place in the document, length, checksum and rank in its task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = merges(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                number, rows, ids, at = bpe.encode(piece.column("text"))
                total = np.concatenate([[0], np.cumsum(np.diff(at)[number])])
                tokens = total[rows[1:]] - total[rows[:-1]] + 1
                count = -(-tokens // capacity)
                row = np.repeat(np.arange(len(count)), count)
                index = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                first = tokens - (count - 1) * capacity
                start = np.where(index == 0, 0, first[row] + (index - 1) * capacity)
                length = np.where(index == 0, first[row], capacity)
                crc = np.empty(len(row), np.int64)
                at_piece = 0
                for r in range(len(tokens)):
                    whole = np.append(row_ids(number[rows[r] : rows[r + 1]], ids, at), end_id).astype("<u4")
                    for _ in range(count[r]):
                        s = start[at_piece]
                        crc[at_piece] = zlib.crc32(whole[s : s + length[at_piece]])
                        at_piece += 1
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                local = np.empty(len(row), np.int64)
                local[order] = np.arange(len(row)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": piece.column("doc_id").take(pa.array(row)),
                        "piece": pa.array(index, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "part": pa.array(np.full(len(row), part), pa.int32()),
                        "local": pa.array(local, pa.int64()),
                    }
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of one to four present lengths, descending, that leave as little room as they can."""
    present = np.flatnonzero(histogram[: capacity + 1])
    fit = np.searchsorted(present, np.arange(capacity + 1), "right") - 1  # the longest present length that fits a gap

    def longest(gap: int) -> int:
        i = fit[gap] if gap > 0 else -1
        return int(present[i]) if i >= 0 else 0

    heavy = present[np.argsort(-histogram[present] * present, kind="stable")][:PIVOTS]
    spread = present[np.linspace(0, len(present) - 1, min(PIVOTS, len(present))).astype(int)]
    pivots = np.unique(np.concatenate([heavy, spread])).tolist()
    found: set[tuple[int, ...]] = set()
    for a in present.tolist():
        b = longest(capacity - a)
        found.add((a, b) if b else (a,))
        for p in pivots:
            if p > capacity - a:
                break
            c = longest(capacity - a - p)
            found.add(tuple(sorted((x for x in (a, p, c) if x), reverse=True)))
            half = (capacity - a - p) // 2
            d = longest(half)
            if d:
                e = longest(capacity - a - p - d)
                found.add(tuple(sorted((x for x in (a, p, d, e) if x), reverse=True)))
    tight = {p for p in found if sum(p) >= TIGHT * capacity}
    return sorted(tight, reverse=True)


def fit_counts(found: list[tuple[int, ...]], histogram: np.ndarray, steps: int = 120) -> np.ndarray:
    """Repeat counts x >= 0 with A x near the histogram, by accelerated projected gradient."""
    slot = np.array([p + (0,) * (4 - len(p)) for p in found])
    used = slot > 0
    target = histogram.astype(float)
    scale = target.sum() or 1.0

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(slot.ravel(), (x[:, None] * used).ravel(), len(target))

    def back(r: np.ndarray) -> np.ndarray:
        return (r[slot] * used).sum(axis=1)

    v = np.ones(len(found))
    for _ in range(20):  # the largest eigenvalue of A'A
        v = back(forward(v))
        v /= np.linalg.norm(v)
    step = 1.0 / max(np.linalg.norm(back(forward(v))) * 1.02, 1e-12)
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(forward(y) - target / scale))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


def plan_runs(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first rank, last rank, sequence, offset) that place every piece.

    Best-fit packing alone is tried as well, and taken where it needs fewer sequences.
    """
    plans = [_plan(histogram, capacity, fitted) for fitted in (True, False)]
    return min(plans, key=lambda runs: (runs[:, 3] + runs[:, 2] - runs[:, 1]).max(initial=0))


def _plan(histogram: np.ndarray, capacity: int, fitted: bool) -> np.ndarray:
    left = histogram.astype(np.int64).copy()
    taken = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    #: gap -> runs of sequences (first, count) with that much room
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    gaps: list[int] = []  # gaps with rooms, ascending

    def open_room(gap: int, first: int, count: int) -> None:
        if not rooms[gap]:
            insort(gaps, gap)
        rooms[gap].append((first, count))

    def put(length: int, count: int, first: int, offset: int) -> None:
        runs.append((length, int(taken[length]), int(taken[length]) + count, first, offset))
        taken[length] += count
        left[length] -= count

    found = patterns(left, capacity) if fitted else []
    if found:
        counts = fit_counts(found, left)
        for i in np.argsort(-counts, kind="stable"):
            need = np.bincount(found[i], minlength=len(left))
            at = np.flatnonzero(need)
            count = int(min(np.rint(counts[i]), (left[at] // need[at]).min()))
            if count <= 0:
                continue
            offset = 0
            for length in found[i]:
                put(length, count, sequence, offset)
                offset += length
            if offset < capacity:
                open_room(capacity - offset, sequence, count)
            sequence += count
    for length in range(capacity, 0, -1):
        while left[length]:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                first, count = rooms[gap].pop()
                n = min(count, int(left[length]))
                if n < count:
                    rooms[gap].append((first + n, count - n))
                elif not rooms[gap]:
                    del gaps[i]
            else:
                gap, first, n = capacity, sequence, int(left[length])
                if 2 * length <= capacity:  # as many of this length in one sequence as it holds
                    n = -(-n // (capacity // length))
                sequence += n
            put(length, n, first, capacity - gap)
            if gap > length:
                open_room(gap - length, first, n)
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cuts = stored(cut_documents(docs, vocabulary, capacity, end_id, doc_id, text), "pieces")
    by_task = cuts.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        histogram[length] = n
    runs = plan_runs(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cuts.join(shifts, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs of a length cover its ranks without a gap: one sorted key finds the run.
        bounds = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            ends = np.searchsorted(length[order], np.arange(capacity + 2))
            for n in np.unique(length):
                own = order[ends[n] : ends[n + 1]]
                a, b = bounds[n], bounds[n + 1]
                run[own] = a + np.searchsorted(runs[a:b, 1], rank[own], "right") - 1
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
                | {
                    "sequence_id": pa.array(runs[run, 3] + rank - runs[run, 1]),
                    "offset": pa.array(runs[run, 4]),
                }
            )

    return ranked.mapInArrow(place, PLACED)
