"""Language of documents from a linear-chain CRF over their words.

Every word of a document has a label (a language); the score of a labelling is the sum of
word weights (affixes, character n-grams and a lexicon entry of the lower-cased word) and of
learned transition weights between neighbours. Forward-backward gives each word its
probability of each language, so switches inside a text are followed; the language of a
document has the largest mean probability over its words with letters, which is the score.

Training sentences are spliced from stretches of documents of all languages, so that
transitions between languages are learned too; weights maximise the likelihood of the labels
(exact gradients by forward-backward, Adam, a small ridge). Training rows: at most `fit_rows`
documents a language (those with the smallest hash of their id, a documented bound),
whole texts. The lexicon holds the words that are frequent in these.

Defined cases: a null text, a text without a letter, or no language learned at all gives
`und` with score 0; rows without language are not learned from; equal means go to the first
language in order; a null id is not held out and not learned from; every row gives a row;
other columns are ignored.

Scale: prediction is one pass without a shuffle. The recursions run over chunks of all texts
of a slice at once: the transfer matrices of the chunks are multiplied in parallel, joined along
each document, and the words' probabilities filled in from the chunk ends, so a very
long text takes no longer than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import Words, pieces, text_bytes
from .bpe import LETTER, char_classes

BUCKETS = 1 << 15
CHUNK = 48
UNKNOWN = "und"


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each word, one after the other, and the offsets of the words.

    Affixes of one to three bytes and all pairs and triples of bytes, with the word's ends marked.
    """
    data, offsets = text_bytes(words)
    size = np.diff(offsets)
    framed = np.zeros(len(data) + 2 * len(size) + 3, np.uint64)
    at = offsets[:-1] + 2 * np.arange(len(size))  # the mark before each word
    inside = np.arange(len(data)) + np.repeat(2 * np.arange(len(size)) + 1, size)
    framed[inside] = data.astype(np.uint64) + 2
    framed[at] = framed[at + size + 1] = 1
    pair = framed[:-1] | framed[1:] << np.uint64(9)
    triple = pair[:-1] | framed[2:] << np.uint64(18)

    def bucket(key: np.ndarray, kind: int) -> np.ndarray:
        h = (key + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - 15)).astype(np.int64)

    # Each word has size + 1 pairs, size triples, and two affixes of three bytes beside its marks.
    count = 2 * size + 3
    ends = np.cumsum(count)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    start = ends - count

    def put(shift: np.ndarray, n: np.ndarray, place: np.ndarray, values: np.ndarray, kind: int) -> None:
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(start + shift, n) + step] = bucket(values[np.repeat(place, n) + step], kind)

    put(np.zeros_like(size), size + 1, at, pair, 1)
    put(size + 1, size, at, triple, 2)
    last = at + size + 1
    out[start + 2 * size + 1] = bucket(_affix(framed, at, 1), 3)
    out[start + 2 * size + 2] = bucket(_affix(framed, last, -1), 4)
    return out, np.concatenate([[0], ends])


def _affix(framed: np.ndarray, mark: np.ndarray, step: int) -> np.ndarray:
    """Up to three bytes beside each mark, packed."""
    key = np.zeros(len(mark), np.uint64)
    open_ = np.ones(len(mark), bool)
    for j in range(1, 4):
        b = framed[np.clip(mark + step * j, 0, len(framed) - 1)]
        open_ &= b > 1
        key = key << np.uint64(9) | np.where(open_, b, 0).astype(np.uint64)
    return key


def has_letter(words: pa.Array) -> np.ndarray:
    """Whether each word, as UTF-8 bytes, holds a letter."""
    data, offsets = text_bytes(words)
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    total, wide = (np.concatenate([[0], np.cumsum(x)]) for x in (ascii_letter, data > 127))
    out = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~out & (wide[offsets[1:]] > wide[offsets[:-1]])):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        out[i] = any(char_classes()[ord(c)] == LETTER for c in text)
    return out


def _distinct(words: Words) -> tuple[np.ndarray, pa.Array]:
    number, found = words.coded()
    return number, pa.array(found, pa.binary())


def chain_marginals(emit: np.ndarray, move: np.ndarray, rows: np.ndarray, moves: np.ndarray | None = None) -> np.ndarray:
    """Probabilities of the labels of each word, by forward-backward over chunks.

    emit: exp of the word weights (words x labels); move: exp of the transition weights;
    rows: offsets of the documents. moves: if given, the expected transitions between
    neighbouring words of a document are added to it.
    """
    n, size = emit.shape
    length = np.diff(rows)
    chunks = -(-length // CHUNK)
    total = int(chunks.sum())
    if not total:
        return np.zeros((0, size))
    doc = np.repeat(np.arange(len(length)), chunks)
    nth = np.arange(total) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = rows[doc] + nth * CHUNK
    many = np.minimum(CHUNK, rows[doc + 1] - start)
    order = np.argsort(-many, kind="stable")  # full chunks first, so that active ones are a prefix
    start, many, doc, nth = start[order], many[order], doc[order], nth[order]
    active = [int(np.searchsorted(-many, -t, "left")) for t in range(CHUNK)]  # chunks with more than t words
    # Transfer of each chunk: from the label before it to the label of its last word.
    transfer = np.broadcast_to(np.eye(size), (total, size, size)).copy()
    for t, a in enumerate(active):
        if a:
            step = (transfer[:a] @ move) * emit[start[:a] + t][:, None, :]
            transfer[:a] = step / step.sum(axis=(1, 2), keepdims=True)
    # Along each document: what comes into each chunk from the left, and from the right.
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    base = np.cumsum(chunks) - chunks
    left, right = np.ones((total, size)), np.ones((total, size))
    by_chunks = np.argsort(-chunks, kind="stable")
    sorted_chunks = -chunks[by_chunks]
    for k in range(1, int(chunks.max())):
        docs = by_chunks[: np.searchsorted(sorted_chunks, -k, "left")]  # documents with more than k chunks
        before, own = place[base[docs] + k - 1], place[base[docs] + k]
        x = np.einsum("di,dij->dj", left[before], transfer[before])
        left[own] = x / x.sum(axis=1, keepdims=True)
        own, after = place[base[docs] + chunks[docs] - 1 - k], place[base[docs] + chunks[docs] - k]
        x = np.einsum("dij,dj->di", transfer[after], right[after])
        right[own] = x / x.sum(axis=1, keepdims=True)
    forward = np.empty_like(emit)
    state = left
    for t, a in enumerate(active):
        if a:
            x = (state[:a] @ move) * emit[start[:a] + t]
            state[:a] = x / x.sum(axis=1, keepdims=True)
            forward[start[:a] + t] = state[:a]
    state = right
    out = np.empty_like(emit)
    for t in range(CHUNK - 1, -1, -1):
        a = active[t]
        if a:
            at = start[:a] + t
            x = forward[at] * state[:a]
            out[at] = x / x.sum(axis=1, keepdims=True)
            ahead = state[:a] * emit[at]
            if moves is not None:
                # A pair has the chance alpha_i * move_ij * emit_j * beta_j, up to one factor per place.
                inner = slice(None) if t else np.flatnonzero(nth[:a] > 0)
                before, after = forward[at[inner] - 1], ahead[inner]
                whole = ((before @ move) * after).sum(axis=1, keepdims=True)
                moves += move * ((before / whole).T @ after)
            y = ahead @ move.T
            state[:a] = y / y.sum(axis=1, keepdims=True)
    return out


class Crf:
    """Languages, word weights, lexicon and transitions."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.weights = np.zeros((BUCKETS, len(languages)))
        self.lexicon: dict[bytes, int] = {}
        self.entries = np.zeros((1, len(languages)))  # the last one is of words that are not in it
        self.moves = np.zeros((len(languages), len(languages)))

    def word_weights(self, words: pa.Array) -> np.ndarray:
        """Weights of distinct words; a word without a letter has none."""
        at, offsets = word_features(words)
        out = np.add.reduceat(self.weights[at], offsets[:-1], axis=0) if len(words) else np.zeros((0, len(self.languages)))
        out /= np.sqrt(np.diff(offsets))[:, None]
        own = [self.lexicon.get(w, len(self.lexicon)) for w in words.to_pylist()]
        out += self.entries[np.array(own, np.int64)]
        return out * has_letter(words)[:, None]

    def learn(self, texts: list[str], languages: list[str], lexicon: int = 3000, steps: int = 24, rate: float = 0.4, ridge: float = 1e-4, seed: int = 3) -> None:
        """Fit to documents and their languages."""
        words = Words(pa.array(texts, pa.large_string()), lower=True)
        number, distinct = _distinct(words)
        if not len(number):
            return
        size = len(self.languages)
        label = np.array([self.languages.index(x) for x in languages], np.int64)[words.row]
        often = np.bincount(number, minlength=len(distinct))
        common = np.lexsort((np.arange(len(often)), -often))[:lexicon]
        common = common[often[common] > 2]
        held = distinct.to_pylist()
        self.lexicon = {held[i]: k for k, i in enumerate(common)}
        self.entries = np.zeros((len(common) + 1, size))
        entry = np.full(len(distinct), len(common))
        entry[common] = np.arange(len(common))
        # Sentences: stretches of 3 to 24 words in an order that mixes documents.
        rng = np.random.default_rng(seed)
        stretch = rng.integers(3, 25, len(number) // 3 + 1)
        cuts = np.unique(np.concatenate([np.minimum(np.cumsum(stretch), len(number)), words.rows]))
        first, last = cuts[:-1], cuts[1:]
        order = rng.permutation(len(first))
        n = (last - first)[order]
        place = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        number, label = number[place], label[place]
        rows = np.unique(np.append(np.arange(0, len(number), 60), len(number)))
        inner = np.ones(len(number), bool)
        inner[rows[:-1]] = False
        step = np.flatnonzero(inner)  # words with one before them in their sentence
        at, offsets = word_features(distinct)
        owner = np.repeat(np.arange(len(distinct)), np.diff(offsets))
        scale = 1 / np.sqrt(np.diff(offsets))
        letters = has_letter(distinct)
        seen_moves = np.bincount(label[step - 1] * size + label[step], minlength=size * size).reshape(size, size)
        params = [self.weights, self.entries, self.moves]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for k in range(1, steps + 1):
            by_word = self.word_weights_of(at, offsets, scale, entry) * letters[:, None]
            emit = np.exp(by_word - by_word.max(axis=1, keepdims=True))[number]
            move = np.exp(self.moves)
            expected = np.zeros_like(move)
            seen = chain_marginals(emit, move, rows, expected)
            gap = -seen
            gap[np.arange(len(label)), label] += 1
            per_word = np.column_stack([np.bincount(number, gap[:, c], len(distinct)) for c in range(size)]) * letters[:, None]
            scaled = (per_word * scale[:, None])[owner]
            slopes = [
                np.column_stack([np.bincount(at, scaled[:, c], BUCKETS) for c in range(size)]),
                np.column_stack([np.bincount(entry, per_word[:, c], len(self.entries)) for c in range(size)]),
                seen_moves - expected,
            ]
            for p, g, (m, v) in zip(params, slopes, moments, strict=True):
                g = g / len(number) - ridge * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)

    def word_weights_of(self, at: np.ndarray, offsets: np.ndarray, scale: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[at], offsets[:-1], axis=0) * scale[:, None] + self.entries[entry]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        rows = len(column)
        if not self.languages:
            return [UNKNOWN] * rows, np.zeros(rows)
        words = Words(column, lower=True)
        number, distinct = _distinct(words)
        by_word = self.word_weights(distinct)
        letters = has_letter(distinct)
        emit = np.exp(by_word - by_word.max(axis=1, keepdims=True)) if len(by_word) else by_word
        seen = chain_marginals(emit[number], np.exp(self.moves), words.rows) * letters[number][:, None]
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(seen, axis=0)])
        total = total[words.rows[1:]] - total[words.rows[:-1]]
        counted = np.concatenate([[0], np.cumsum(letters[number])])
        counted = counted[words.rows[1:]] - counted[words.rows[:-1]]
        best = total.argmax(axis=1)
        score = np.where(counted > 0, total[np.arange(rows), best] / np.maximum(counted, 1), 0.0)
        return [self.languages[b] if c else UNKNOWN for b, c in zip(best, counted, strict=True)], np.clip(score, 0, 1)


def fit(docs: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = 80) -> Crf:
    """A model of the rows with text and language for which learn_from (a condition on the id) holds."""
    known = docs.filter(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash")
    )
    # Rows are chosen by narrow columns; repeated ones are one text, so no more than the bound is collected.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "hash")
    nth = known.select("id", "lang", "hash").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= fit_rows)
    chosen = F.broadcast(nth.select("id", "lang", "hash").distinct())
    texts = known.join(chosen, ["id", "lang", "hash"]).groupBy("id", "lang", "hash").agg(F.first("text").alias("text"))
    held = sorted((r["id"], r["lang"], r["text"]) for r in texts.collect())
    model = Crf(sorted({r[1] for r in held}))
    model.learn([r[2] for r in held], [r[1] for r in held])
    return model


def languages(docs: DataFrame, model: Crf, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found, score = model.predict(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "held_out": part.column("held_out"),
                        "lang_pred": pa.array(found, pa.string()),
                        "score": pa.array(score),
                    }
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
