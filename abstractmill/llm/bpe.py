"""Byte-level BPE over ragged numpy arrays: pre-tokens by character class, merges by rank.

Pre-tokens are cut on the code points of a whole slice of texts at once. Each distinct
pre-token of a slice is held once, as a row of a ragged symbol array; in every round each
row's pair of lowest rank is merged in all its places at the same time, rows without a
pair that merges leave, until none is left. A merge never makes a pair of lower rank than
its own, so this gives the same symbols as merging one place after the other.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from .arrays import spans, text_bytes

OTHER, LETTER, NUMBER, BLANK = range(4)
NO_RANK = np.int32(1 << 30)


@lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of each code point."""
    classes = np.zeros(0x110000, np.uint8)
    chars = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, chars):
            # No run of a class crosses the gap of the surrogates.
            classes[ord(chars[m.start()]) : ord(chars[m.end() - 1]) + 1] = kind
    return classes


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary, and the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """The vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        self.first = np.zeros(256, np.int32)
        for letter, byte in _byte_letters().items():
            self.first[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.uint64) for i in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.special = {t["content"].encode(): t["id"] for t in file.get("added_tokens", []) if t["special"]}
        keys = left << np.uint64(32) | right
        self.keys = np.full(1 << 20, np.uint64(1) << np.uint64(63), np.uint64)
        self.ranks = np.full(1 << 20, NO_RANK, np.int32)
        todo = np.arange(len(keys))
        slot = self._slots(keys)
        while len(todo):  # the first of several keys takes a slot, the rest go to the next one
            free = self.ranks[slot] == NO_RANK
            _, one = np.unique(slot, return_index=True)
            taken = np.zeros(len(todo), bool)
            taken[one] = True
            taken &= free
            self.keys[slot[taken]], self.ranks[slot[taken]] = keys[todo[taken]], todo[taken]
            todo, slot = todo[~taken], (slot[~taken] + 1) & 0xFFFFF

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_RANK where it does not merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slots(keys)
        out = self.ranks[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & (out != NO_RANK))
        out[wrong] = NO_RANK
        at = slot[wrong]
        while len(wrong):
            at = (at + 1) & 0xFFFFF
            same = self.keys[at] == keys[wrong]
            out[wrong[same]] = self.ranks[at[same]]
            more = ~same & (self.ranks[at] != NO_RANK)
            wrong, at = wrong[more], at[more]
        return out

    def merge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of each pre-token given as bytes, and the offsets of the pre-tokens."""
        symbols, rows = self.first[data], np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        done_symbols, done_rows = [], []
        while len(symbols):
            inner = rows[1:] == rows[:-1]
            rank = np.full(len(symbols), NO_RANK, np.int32)
            at = np.flatnonzero(inner)
            rank[at] = self.rank(symbols[at], symbols[at + 1])
            heads = np.flatnonzero(np.concatenate([[True], ~inner]))
            least = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(symbols)))
            over = np.repeat(least == NO_RANK, sizes)
            if over.any():
                done_symbols.append(symbols[over])
                done_rows.append(rows[over])
                symbols, rows, rank = symbols[~over], rows[~over], rank[~over]
                least, sizes = least[least != NO_RANK], sizes[least != NO_RANK]
            hit = rank == np.repeat(least, sizes)
            # In a run of places that overlap (a pair of one symbol with itself) every other one merges.
            where = np.flatnonzero(hit)
            if len(where) > 1 and (near := np.diff(where) == 1).any():
                start = np.concatenate([[True], ~near])
                number = np.arange(len(where)) - np.maximum.accumulate(np.where(start, np.arange(len(where)), 0))
                where = where[number % 2 == 0]
            symbols[where] = self.merged[rank[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, rows = symbols[keep], rows[keep]
        if not done_rows:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        symbols, rows = np.concatenate(done_symbols), np.concatenate(done_rows)
        order = np.argsort(rows, kind="stable")
        return symbols[order], np.searchsorted(rows[order], np.arange(len(offsets)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of a text column without one array of all ids.

        Gives the number of the distinct pre-token at each place, the offsets of the rows in
        these, the ids of the distinct pre-tokens one after the other, and their offsets.
        """
        data, offsets = text_bytes(column)
        starts, special = pre_tokens(data, offsets, tuple(self.special))
        rows = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), rows, np.zeros(0, np.int32), np.zeros(1, np.int64)
        cuts = np.append(starts, len(data)).astype(np.int32)
        strings = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
        coded = strings.dictionary_encode()
        ids, at = self.merge(*text_bytes(coded.dictionary))
        number = coded.indices.to_numpy().astype(np.int64)
        if special:
            extra = list(self.special)
            for place, which in special:
                number[place] = len(at) - 1 + which
            ids = np.concatenate([ids, np.array([self.special[x] for x in extra], np.int32)])
            at = np.concatenate([at, at[-1] + 1 + np.arange(len(extra))])
        return number, rows, ids, at


def pre_tokens(data: np.ndarray, offsets: np.ndarray, special: tuple[bytes, ...] = ()) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Where pre-tokens start in the bytes of texts, and the special strings among them.

    The classes follow the byte-level pattern: contractions; an optional space before
    letters, numbers or other characters; white space, the last of it kept apart from a
    run that text follows. A special string is one pre-token and cuts the text.
    """
    if not len(data):
        return np.zeros(0, np.int64), []
    raw = data.tobytes()
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    found = []
    for which, name in enumerate(special):
        at = raw.find(name)
        while at >= 0:
            if not cut[at + 1 : at + len(name)].any():
                found.append((at, which))
                cut[at] = cut[at + len(name)] = True
                at += len(name) - 1
            at = raw.find(name, at + 1)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    bound = np.append(cut[place], True)
    kind = char_classes()[points]
    n = len(points)
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[bound[:-1]] = 255
    after = np.empty(n, np.uint8)
    after[-1] = 255
    after[:-1] = kind[1:]
    after[bound[1:]] = 255
    gap = kind == BLANK
    spaced = np.zeros(n, bool)
    spaced[1:] = points[:-1] == 0x20
    spaced[bound[:-1]] = False
    start = (before != kind) & ~(spaced & ~gap) | gap & (after != BLANK) & (after != 255)
    quote = np.flatnonzero((points == 0x27) & start & (after == LETTER))
    if len(quote):
        # A quote at a start, then s, t, m, d or re, ve, ll.
        one = points[quote + 1]
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        both = (quote + 2 < n) & (size == 0)
        two = np.zeros(len(quote), np.uint32)
        two[both] = points[quote[both] + 2]
        both &= ~bound[np.minimum(quote + 2, n)]
        wide = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size[wide & both] = 3
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        ends = (quote + size)[quote + size < n]
        start[ends] = True
        # After 're' the next pair of letters may not start inside the contraction.
        start[(quote + 2)[size == 3]] = False
    starts = place[start]
    if found:
        inside = np.zeros(len(data), bool)
        for at, which in found:
            inside[at + 1 : at + len(special[which])] = True
        starts = starts[~inside[starts]]
    return starts, [(int(np.searchsorted(starts, at)), which) for at, which in found]


@lru_cache(2)
def merges(path: str) -> Merges:
    """The file's merges, read once in a worker."""
    return Merges(path)


def row_ids(number: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Token ids of the given pre-tokens, one after the other."""
    return ids[spans(at[number], at[number + 1])]
