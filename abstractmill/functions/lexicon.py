"""Large vocabularies: which of thousands of terms occur in a text, in one pass over its bytes.

The chain of ``contains`` (``text.contains_any``) is the faster way for some tens of terms; its time grows
with their number. Here all terms share one Aho-Corasick automaton, whose time per byte does not.
The automaton walks many pieces of texts side by side: the texts of an Arrow batch are cut into pieces
of equal length that overlap by the longest term, and one array operation takes all pieces one byte on.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes that each piece adds to those it shares with the next one; a vocabulary has at most so many table cells.
PIECE, MOST_CELLS = 512, 1 << 25


class Automaton:
    """Tables of the automaton over distinct, non-empty terms.

    kinds: byte -> class, 0 for bytes in no term. step: state and class -> state, flat. ends: state -> number
    of the longest term that ends there, or -1; shorter: term -> the next shorter term that ends where it does.
    """

    def __init__(self, terms: Sequence[str]):
        held = [t.encode() for t in terms]
        if len(set(held)) < len(held) or not all(held):
            raise ValueError("terms must be distinct and not empty")
        self.longest = max(map(len, held), default=0)
        used = sorted(set(b"".join(held)))
        self.kinds = np.zeros(256, np.int32)
        self.kinds[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for number, term in enumerate(held):
            at = 0
            for byte in term:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][byte]
            ends[at] = number
        if len(children) * self.width > MOST_CELLS:
            raise ValueError(f"vocabulary too large: {len(children)} states of {self.width} bytes")
        step = np.zeros((len(children), self.width), np.int32)
        self.shorter = np.full(len(held), -1, np.int32)
        self.ends = np.array(ends, np.int32)
        # Level by level: a state that is not on a term's way takes over the steps of its longest proper suffix.
        level, suffix = [0], np.zeros(len(children), np.int32)
        while level:
            below = []
            for at in level:
                back = suffix[at]
                if at:
                    step[at] = step[back]
                    if self.ends[at] < 0:
                        self.ends[at] = self.ends[back]
                    else:
                        self.shorter[self.ends[at]] = self.ends[back]
                for byte, child in children[at].items():
                    kind = self.kinds[byte]
                    suffix[child] = step[at, kind]  # as far as the suffix goes on; 0 below the root
                    step[at, kind] = child
                    below.append(child)
            level = below
        self.step = step.ravel()

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and term of every match in the texts, each pair once, by row and then term."""
        size = np.diff(offsets)
        overlap = max(0, self.longest - 1)
        pieces = np.maximum(1, -(-size // PIECE))
        row = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[row] + nth * PIECE
        length = np.minimum(PIECE + overlap, offsets[row + 1] - start)
        order = np.argsort(-length, kind="stable")
        start, length, row = start[order], length[order], row[order]
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        kind = self.kinds[data]
        state = np.zeros(len(start), np.int32)
        found = []
        for j, n in enumerate(active.tolist()):
            state = self.step[state[:n] * self.width + kind[start[:n] + j]]
            term = self.ends[state]
            hit = np.flatnonzero(term >= 0)
            if len(hit):
                found.append(row[hit].astype(np.int64) * len(self.shorter) + term[hit])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        every = pairs
        while len(pairs):  # terms that end with another one
            rows, terms = np.divmod(pairs, len(self.shorter))
            less = self.shorter[terms]
            pairs = np.unique(rows[less >= 0] * len(self.shorter) + less[less >= 0])
            every = np.union1d(every, pairs)
        return np.divmod(every, max(1, len(self.shorter)))


def _found(automaton: Automaton, texts: pa.Array) -> Iterator[list[int]]:
    """Numbers of the terms in each text, ascending."""
    for at in range(0, len(texts), 2000):
        part = texts.slice(at, 2000).cast(pa.large_binary())
        _, offsets, data = part.buffers()
        offsets = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        rows, terms = automaton.matches(data[offsets[0] : offsets[-1]], offsets - offsets[0])
        bounds = np.searchsorted(rows, np.arange(len(part) + 1)).tolist()
        terms = terms.tolist()
        yield from (terms[a:b] for a, b in zip(bounds, bounds[1:]))


def terms_in(spark: SparkSession, text: Column, terms: Sequence[str]) -> Column:
    """Terms that occur in the text, in the order of ``terms``; empty for a null text.

    Terms are compared as they are: hand in lower-cased terms and texts to ignore case. The automaton is
    made on the driver and broadcast; its size is bounded by MOST_CELLS.
    """
    shared = spark.sparkContext.broadcast((Automaton(terms), list(terms)))

    def run(texts: pa.Array) -> pa.Array:
        automaton, names = shared.value
        return pa.array([[names[t] for t in found] for found in _found(automaton, texts)], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(F.coalesce(text, F.lit("")))


def labels_in(spark: SparkSession, text: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """Labels of which a term occurs in the text, in the order of the lexicon, as the rules list them."""
    labels_of: dict[str, list[int]] = {}
    for i, terms in enumerate(lexicon.values()):
        for t in terms:
            labels_of.setdefault(t, []).append(i + 1)
    shared = spark.sparkContext.broadcast((Automaton(list(labels_of)), list(labels_of.values()), list(lexicon)))

    def run(texts: pa.Array) -> pa.Array:
        automaton, places, names = shared.value
        out = []
        for found in _found(automaton, texts):
            out.append([names[i - 1] for i in sorted({i for t in found for i in places[t]})])
        return pa.array(out, pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(F.coalesce(text, F.lit("")))
