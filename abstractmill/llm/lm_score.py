"""Language-model scores of whole documents by a gated recurrent network in numpy.

*Counts.* Every word of every training document is counted. Blocks of documents send the
hashes and counts of their distinct words to groups by hash; a group adds them up and answers
each block with the total of each of its words. So what is gathered grows with the
corpus, in the number of distinct words per block.

*Model.* A gated recurrent unit with one gate (a minimal gated unit) reads the words of a document. The `SHORT` most frequent words are
symbols of their own; all other words fall into `TAIL` symbols by their last letters, where
a word has the share (c + 0.1) / (N_t + 0.1 (V_t + 1)) of its symbol. The output softmax is factored by
class: one over classes of `IN_CLASS` symbols by frequency, then one over the symbols of the class. The counts of the whole
corpus set the biases and these shares, so before training the model is the unigram
model by classes. It is trained by truncated backpropagation through windows of `WINDOW`
steps (exact gradients in a window, state carried into the next one, Adam) on every training
document: the blocks are dealt to `ROUNDS` rounds; in each one every task goes once through its
blocks of the round, starting from the weights of the round before, and the tasks' weights are
averaged in proportion to their words, in levels of FAN_IN tasks. The first round starts from weights learned on the
driver from at most `fit_docs` training documents (those with the smallest hash of their id), which are in
a round as well. The size of the network is fixed.

*Scores.* Documents run side by side in lanes; the state is carried across windows from the
first word to the end, so a score is the log-likelihood of the complete document.

Tokens are words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, then one end. Words are told apart by
64-bit hashes.

Defined cases: a null or empty text is the end alone; a null id is not held out and not
learned from; without training documents c, N and V are 0 and both scores are those
formulas' values; ties in frequency go to the smaller hash; every row gives a row; other
columns are ignored.

Scale: texts are read once, coded as word numbers (some 2 bytes a token, compressed) and
stored. Hot words cost one entry a block and group. Driver and broadcast hold the
short list and the weights only, whose sizes are fixed. A task of training holds one block and sends
its weights (0.6 MB), which are averaged like the counts: a merging task has FAN_IN rows, the driver too.
"""

from __future__ import annotations

import copy
import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import Words, block_numbers, mix, pieces, span_hashes, text_bytes
from .rlz import _by_group, from_bytes, to_bytes
from .stored import stored

#: Words with a softmax of their own (the end is word 0), words in a class, tail classes.
SHORT, IN_CLASS, TAIL = 1024, 32, 64
#: The tail classes are symbols too, in classes of their own.
SYMBOLS = SHORT + TAIL
CLASSES = SYMBOLS // IN_CLASS
#: Size of the state, steps of backpropagation, steps scored at once.
STATE, WINDOW, SCORED = 32, 20, 64
#: Logits within this bound either way need no shift: exponentials and their sums stay normal floats.
BOUND = 70.0
#: States whose exponentials are taken at once: they stay in the cache.
SLICE = 1024
#: Blocks that are scored together: a step takes as long for few lanes as for many, and the longest document of a
#: group fixes the number of steps.
TOGETHER = 8
#: Rows of counts or weights that one task merges.
FAN_IN = 16
#: Rounds of training over all blocks, lanes of a block in them, and the rate of the first one.
ROUNDS, LANES, RATE = 4, 512, 0.004
BLOCK_BYTES = 3 << 20
CODED = "bucket int, block long, together long, hashes binary, counts binary, tails binary, docs binary, numbers binary"
TRAINED = "task int, tokens long, weights binary"
GROUPED = "block long, bucket int, together long, totals binary, n binary, v binary, words binary, top binary, tails binary"
GROUPED_NAMES = [x.split()[0] for x in GROUPED.split(", ")]
STATS_IN_GROUP = {"totals": "top"}
STATS = "bucket int, n binary, v binary, words binary, totals binary, tails binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
SCORES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def tail_class(words: pa.Array) -> np.ndarray:
    """The tail class of each word, from its last two bytes."""
    data, offsets = text_bytes(words)
    if not len(data):
        return np.zeros(len(words), np.uint8)
    last = data[np.maximum(offsets[1:] - 1, 0)].astype(np.uint64)
    before = data[np.maximum(offsets[1:] - 2, offsets[:-1])].astype(np.uint64)
    return (mix(last << np.uint64(8) | before) >> np.uint64(58)).astype(np.uint8)


def _code(buckets: int):
    """Blocks of documents as numbers of their distinct words, which are in the order of the groups.

    The row of a block (bucket -1) has all its words, the rows for the groups have theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = block_numbers(TaskContext.get().partitionId())
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                block = next(blocks)
                words = Words(part.column("text"), lower=True)
                number, held = words.coded()
                distinct = pa.array(held, pa.binary())
                data, offsets = text_bytes(distinct)
                hashes = span_hashes(data, offsets[:-1], offsets[1:])
                group = ((mix(hashes) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order, bounds = _by_group(group.astype(np.int32), buckets)
                new = np.empty(len(order), np.int32)
                new[order] = np.arange(len(order), dtype=np.int32)
                number = new[number] if len(order) else np.zeros(0, np.int32)
                train = part.column("train").to_numpy(zero_copy_only=False)
                counts = np.bincount(number, np.repeat(train, np.diff(words.rows)), len(order)).astype(np.int32)
                hashes, tails = hashes[order], tail_class(distinct)[order]
                docs = pa.RecordBatch.from_pydict(
                    {c: part.column(c) for c in ("doc_id", "held_out", "train")} | {"n": pa.array(np.diff(words.rows))}
                )
                numbers = pa.RecordBatch.from_pydict({"number": pa.array(number, pa.int32())})
                used = np.flatnonzero(np.diff(bounds))
                cuts = [slice(bounds[g], bounds[g + 1]) for g in used]
                n = len(used)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([-1, *used.tolist()], pa.int32()),
                        "block": pa.array([block] * (n + 1), pa.int64()),
                        "together": pa.array([block // TOGETHER] * (n + 1), pa.int64()),
                        "hashes": pa.array([hashes.tobytes(), *(hashes[c].tobytes() for c in cuts)], pa.binary()),
                        "counts": pa.array([None, *(counts[c].tobytes() for c in cuts)], pa.binary()),
                        "tails": pa.array([tails.tobytes(), *(tails[c].tobytes() for c in cuts)], pa.binary()),
                        "docs": pa.array([to_bytes(docs)] + [None] * n, pa.binary()),
                        "numbers": pa.array([to_bytes(numbers)] + [None] * n, pa.binary()),
                    }
                )

    return run


def _add_up(table: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Rows of one group, totals for each, and the group's distinct words: hash, total, tail class."""
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in table.column("counts").to_pylist()])
    tails = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("tails").to_pylist()])
    words, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(at, counts).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in hashes])])
    each = [total[at[a:b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return table.column("block").to_pylist(), each, words, total, tails[first]


def _grouped(table: pa.Table) -> pa.Table:
    """A row of totals for each block of a group, and one row of the group's statistics.

    The latter: counts and distinct words by tail class, and the most frequent words.
    """
    blocks, each, words, total, tails = _add_up(table)
    known = total > 0
    words, total, tails = words[known].view(np.int64), total[known], tails[known]
    n, v = np.bincount(tails, total, TAIL).astype(np.int64), np.bincount(tails, minlength=TAIL)
    stats = _stats_row(table.column("bucket")[0].as_py(), n, v, words, total, tails)
    answers = pa.table(
        {
            "block": pa.array(blocks, pa.int64()),
            "bucket": table.column("bucket"),
            "together": table.column("together"),
            "totals": pa.array([x.tobytes() for x in each], pa.binary()),
        }
    )
    return pa.concat_tables([answers, stats.rename_columns([STATS_IN_GROUP.get(c, c) for c in stats.column_names])], promote_options="default").select(GROUPED_NAMES)


def _stats_row(bucket: int, n: np.ndarray, v: np.ndarray, words: np.ndarray, total: np.ndarray, tails: np.ndarray) -> pa.Table:
    top = np.lexsort((words, -total))[:SHORT]
    held = (n, v.astype(np.int64), words[top], total[top], tails[top])
    names = ("n", "v", "words", "totals", "tails")
    return pa.table({"bucket": pa.array([bucket], pa.int32())} | {k: pa.array([x.tobytes()], pa.binary()) for k, x in zip(names, held, strict=True)})


def _merge_stats(table: pa.Table) -> pa.Table:
    """One row for the rows of several groups."""
    n, v, words, total = (
        [np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()] for c in ("n", "v", "words", "totals")
    )
    tails = [np.frombuffer(x, np.uint8) for x in table.column("tails").to_pylist()]
    both = (np.concatenate(x) for x in (words, total, tails))
    return _stats_row(min(table.column("bucket").to_pylist()), np.sum(n, axis=0), np.sum(v, axis=0), *both)


class Vocabulary:
    """The short list and the tail classes, from counts of the whole corpus."""

    def __init__(self, ends: int, tails: dict[int, tuple[int, int]], short: list[tuple[int, int, int]]):
        """ends: training documents; tails: class -> (count, words); short: (hash, count, tail class)."""
        self.n = ends + sum(n for n, _ in tails.values())
        self.v = (ends > 0) + sum(v for _, v in tails.values())
        short = short[: SHORT - 1]
        self.hashes = np.array([h for h, _, _ in short], np.int64).view(np.uint64)
        self.order = np.argsort(self.hashes)
        self.hashes = self.hashes[self.order]
        self.counts = np.zeros(SHORT)
        self.counts[0] = ends
        self.counts[1 : len(short) + 1] = [n for _, n, _ in short]
        self.size = len(short) + 1
        self.tail_n, self.tail_v = np.zeros(TAIL), np.zeros(TAIL)
        for t, (n, v) in tails.items():
            self.tail_n[t], self.tail_v[t] = n, v
        for _, n, t in short:
            self.tail_n[t] -= n
            self.tail_v[t] -= 1
        self.tail_room = self.tail_n + 0.1 * (self.tail_v + 1)

    def symbols(self, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """Input and output symbol of each word: its place in the short list, or SHORT + tail class."""
        out = SHORT + tails.astype(np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = 1 + self.order[at[hit]]
        return out

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the unigram probability of words with these counts."""
        return np.log10((count + 0.1) / (self.n + 0.1 * (self.v + 1)))


class Adam:
    """Moments of the gradients and the number of steps so far."""

    def __init__(self, params: list[np.ndarray]):
        self.k = 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def step(self, params: list[np.ndarray], slopes: list[np.ndarray], rate: Callable[[], float]) -> None:
        self.k += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in slopes))
        now = rate()
        for p, g, (m, v) in zip(params, slopes, self.moments, strict=True):
            g *= min(1.0, 1.0 / max(size, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**self.k)) / (np.sqrt(v / (1 - 0.99**self.k)) + 1e-8)


def _lanes(total: int, most: int, windows: int = 4) -> int:
    """Lanes for so many symbols, of so many windows each at least."""
    return max(1, min(most, total // (windows * WINDOW)))


class GatedUnit:
    """Gated recurrent unit with class-factored output; symbols as in Vocabulary."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 11):
        rng = np.random.default_rng(seed)

        def rand(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

        self.inputs = (0.3 * rng.standard_normal((SYMBOLS, 2 * STATE))).astype(np.float32)
        self.inputs[:, :STATE] -= 0.5  # keep the state for a start
        self.hidden = np.concatenate([rand(STATE, STATE) for _ in range(2)], axis=1)
        self.to_class = 0.05 * rand(STATE, CLASSES)
        self.to_word = 0.05 * rand(CLASSES, STATE, IN_CLASS)
        mass = vocabulary.counts + 0.1 * (np.arange(SHORT) < vocabulary.size)
        mass = np.concatenate([np.maximum(mass, 1e-12), np.maximum(vocabulary.tail_room, 1e-3)]).reshape(CLASSES, IN_CLASS)
        held = np.maximum(mass.sum(axis=1), 0.05)
        self.class_bias = np.log(held / held.sum()).astype(np.float32)
        self.word_bias = np.log(mass / mass.max(axis=1, keepdims=True)).astype(np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.to_class, self.to_word, self.class_bias, self.word_bias]

    def step(self, gate: np.ndarray, h: np.ndarray, u: np.ndarray | None = None, f: np.ndarray | None = None, c: np.ndarray | None = None) -> np.ndarray:
        """State after inputs with these gate sums. What the way back needs is put into u, f and c if given.

        f opens the state to the candidate c and the candidate to the state before.
        """
        u = np.matmul(h, self.hidden, out=u)
        f = np.add(gate[:, :STATE], u[:, :STATE], out=f)
        np.negative(f, out=f)
        np.exp(f, out=f)
        f += 1
        np.reciprocal(f, out=f)
        c = np.multiply(f, u[:, STATE:], out=c)
        c += gate[:, STATE:]
        np.tanh(c, out=c)
        new = c - h
        new *= f
        new += h
        return new

    @staticmethod
    def _wide(weights: np.ndarray, bias: np.ndarray) -> bool:
        """Whether exponentials of logits h @ weights + bias can leave the range of floats.

        Components of h lie in -1 .. 1, which bounds the logits. Where this holds, the maximum of
        each row is taken off before.
        """
        reach = np.abs(weights).sum(axis=0)
        return bool((reach + bias).max() > BOUND or (bias - reach).min() < -BOUND)

    def outputs(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """ln of the probability of the target symbols."""
        kind = target // IN_CLASS
        order = np.argsort(kind.astype(np.uint8), kind="stable")
        bounds = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        h, kind, within = h[order], kind[order], target[order] % IN_CLASS
        found = np.zeros(len(h), np.float32)

        def add(first: int, last: int, weights: np.ndarray, bias: np.ndarray, pick: np.ndarray) -> None:
            wide, ones = self._wide(weights, bias), np.ones(len(bias), np.float32)
            for at in range(first, last, SLICE):
                part = slice(at, min(at + SLICE, last))
                x = h[part] @ weights
                x += bias
                if wide:
                    x -= x.max(axis=1, keepdims=True)
                found[part] += x[np.arange(len(x)), pick[part]]
                np.exp(x, out=x)
                found[part] -= np.log(x @ ones)

        add(0, len(h), self.to_class, self.class_bias, kind)
        for c in np.flatnonzero(np.diff(bounds)):
            add(bounds[c], bounds[c + 1], self.to_word[c], self.word_bias[c], within)
        out = np.empty_like(found)
        out[order] = found
        return out

    def learn(self, documents: list[np.ndarray], epochs: int = 4, lanes: int = 64, rate: float = 0.01, seed: int = 5) -> None:
        """Truncated backpropagation over documents given as symbols, each closed by the end (0)."""
        rng = np.random.default_rng(seed)
        adam = Adam(self.params())
        total = sum(len(d) for d in documents)
        lanes = _lanes(total, lanes)
        steps = max(1, epochs * -(-total // (lanes * WINDOW)))
        for _ in range(epochs):
            flat = np.concatenate([documents[i] for i in rng.permutation(len(documents))])
            self.descend(flat, lanes, adam, lambda: rate * (1 - min(adam.k, steps) / (steps + 1)))

    def descend(self, flat: np.ndarray, lanes: int, adam: Adam, rate: Callable[[], float]) -> None:
        """One pass over symbols of documents that follow each other, side by side in lanes."""
        flat = np.concatenate([flat, np.full(-len(flat) % lanes, -1)])  # a pad is no word to learn
        target = np.ascontiguousarray(flat.reshape(lanes, -1).T)  # a step's symbols lie side by side
        source = np.zeros_like(target)
        np.maximum(target[:-1], 0, out=source[1:])
        h = np.zeros((lanes, STATE), np.float32)
        for at in range(0, len(target), WINDOW):
            slopes, h = self._slopes(source[at : at + WINDOW], target[at : at + WINDOW], h)
            adam.step(self.params(), slopes, rate)

    def _slopes(self, source: np.ndarray, target: np.ndarray, h: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Gradients of the mean loss of a window, where targets are not -1; the state after it."""
        steps, lanes = source.shape
        gates = self.inputs[source]
        alive = (source != 0).astype(np.float32)[:, :, None]  # a document starts after the end of the last one
        before, after = (np.empty((steps, lanes, STATE), np.float32) for _ in range(2))
        u, f, c = (np.empty((steps, lanes, k * STATE), np.float32) for k in (2, 1, 1))
        for t in range(steps):
            np.multiply(h, alive[t], out=before[t])
            after[t] = h = self.step(gates[t], before[t], u[t], f[t], c[t])
        aim = target.ravel()
        kind = np.where(aim < 0, CLASSES, aim // IN_CLASS)  # pads come last
        order = np.argsort(kind.astype(np.uint8), kind="stable")
        every, aim, kind = after.reshape(-1, STATE)[order], aim[order], kind[order]
        bounds = np.searchsorted(kind, np.arange(CLASSES + 1))
        n = int(bounds[-1])
        share = np.float32(1 / max(1, n))

        def back_through(first: int, last: int, weights: np.ndarray, bias: np.ndarray, pick: np.ndarray, g_weights: np.ndarray, g_bias: np.ndarray) -> None:
            """Add up the gradients of a softmax over these states."""
            wide, ones = self._wide(weights, bias), np.ones(len(bias), np.float32)
            for at in range(first, last, SLICE):
                part = slice(at, min(at + SLICE, last))
                p = every[part] @ weights
                p += bias
                if wide:
                    p -= p.max(axis=1, keepdims=True)
                np.exp(p, out=p)
                p *= (share / (p @ ones))[:, None]
                p[np.arange(len(p)), pick[part]] -= share
                g_weights += every[part].T @ p
                g_bias += p.sum(axis=0)
                back[part] += p @ weights.T

        back = np.zeros_like(every)
        g_class, g_bias, g_word, g_word_bias = (np.zeros_like(p) for p in (self.to_class, self.class_bias, self.to_word, self.word_bias))
        back_through(0, n, self.to_class, self.class_bias, kind, g_class, g_bias)
        within = aim % IN_CLASS
        for k in np.flatnonzero(np.diff(bounds)):
            back_through(bounds[k], bounds[k + 1], self.to_word[k], self.word_bias[k], within, g_word[k], g_word_bias[k])
        slope = np.empty_like(back)
        slope[order] = back
        slope = slope.reshape(steps, lanes, STATE)
        through = u  # as the gradient of h @ hidden
        carry = np.zeros_like(h)
        back_hidden = np.ascontiguousarray(self.hidden.T)
        room = [np.empty_like(h) for _ in range(2)]
        for t in range(steps - 1, -1, -1):
            dh = slope[t]
            dh += carry
            gate, way, state, open_ = gates[t], through[t], c[t], f[t]
            # From here on the gate sums are replaced by their gradients.
            dc = np.multiply(state, state, out=room[0])
            np.subtract(1, dc, out=dc)
            dc *= open_
            dc *= dh
            gate[:, STATE:] = dc
            state -= before[t]
            state *= dh
            way[:, STATE:] *= dc
            state += way[:, STATE:]
            state *= open_
            keep = np.subtract(1, open_, out=room[1])
            np.multiply(state, keep, out=gate[:, :STATE])
            way[:, :STATE] = gate[:, :STATE]
            np.multiply(dc, open_, out=way[:, STATE:])
            carry = way @ back_hidden
            dh *= keep
            carry += dh
            carry *= alive[t]
        g_hidden = before.reshape(-1, STATE).T @ through.reshape(-1, 2 * STATE)
        # Rows of the input table add up the gradients of their steps.
        by_symbol = np.argsort(source.ravel().astype(np.uint16), kind="stable")
        symbols = source.ravel()[by_symbol]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        g_inputs = np.zeros_like(self.inputs)
        g_inputs[symbols[first]] = np.add.reduceat(gates.reshape(-1, 2 * STATE)[by_symbol], first, axis=0)
        return [g_inputs, g_hidden, g_class, g_word, g_bias, g_word_bias], h

    def score(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """ln probability of each document's symbols (closed by the end), states carried through."""
        length = np.diff(rows)
        if not len(length):
            return np.zeros(0)
        count = int(max(1, min(len(length), -(-int(length.sum()) // int(length.max())), 1024)))
        lanes: list[list[int]] = [[] for _ in range(count)]
        load = [(0, i) for i in range(count)]
        for d in np.argsort(-length, kind="stable"):
            n, i = heapq.heappop(load)
            lanes[i].append(int(d))
            heapq.heappush(load, (n + int(length[d]), i))
        lanes.sort(key=lambda x: -sum(int(length[d]) for d in x))
        long = [sum(int(length[d]) for d in lane) for lane in lanes]
        grid = np.zeros((long[0], count), np.int32)  # the place of the symbol at each step and lane
        for i, lane in enumerate(lanes):
            at = 0
            for d in lane:
                grid[at : at + length[d], i] = np.arange(rows[d], rows[d + 1], dtype=np.int32)
                at += int(length[d])
        active = np.searchsorted(-np.array(long), -np.arange(long[0]), "left")
        starts = np.zeros(len(symbols), bool)
        starts[rows[:-1]] = True
        source = np.empty_like(symbols)
        source[1:] = symbols[:-1]
        source[rows[:-1]] = 0
        out = np.empty(len(symbols), np.float32)
        h = np.zeros((count, STATE), np.float32)
        for at in range(0, long[0], SCORED):
            states, seen = [], []
            for t in range(at, min(at + SCORED, long[0])):
                own = grid[t, : active[t]]
                before = h[: active[t]] * ~starts[own][:, None]
                h = self.step(self.inputs[source[own]], before)
                states.append(h)
                seen.append(own)
            every = np.concatenate(seen)
            out[every] = self.outputs(np.concatenate(states), symbols[every])
        return np.add.reduceat(out.astype(np.float64), rows[:-1])


def _statistics(merged: list) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int, int]]]:
    """Counts and distinct words by tail class; the most frequent words: hash, count and tail class."""
    if not merged:
        return {}, []
    columns = {c: pa.array([r[c] for r in merged], pa.int32() if c == "bucket" else pa.binary()) for c in merged[0].asDict()}
    row = _merge_stats(pa.table(columns)).to_pylist()[0]
    n, v, words, totals = (np.frombuffer(row[c], np.int64).tolist() for c in ("n", "v", "words", "totals"))
    return {t: (n[t], v[t]) for t in range(TAIL)}, list(zip(words, totals, np.frombuffer(row["tails"], np.uint8).tolist(), strict=True))


def _sample(docs: DataFrame, fit_docs: int, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Symbols of a bounded sample of the training documents, whole texts."""
    rows = docs.filter("train").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_text", F.xxhash64("text"))
    # Rows are chosen by narrow columns; repeated ones are one text, so no more than the bound is collected.
    narrow = rows.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"))
    chosen = narrow.orderBy(F.xxhash64("_id"), "_id", "_hash").limit(fit_docs).distinct()
    found = rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_hash")))
    held = found.groupBy("doc_id", "_text").agg(F.first("text").alias("text")).collect()
    texts = [r["text"] for r in sorted(held, key=lambda r: (r["doc_id"], r["_text"]))]
    out = []
    for text in texts:
        words = Words(pa.array([text], pa.large_string()), lower=True)
        held = pa.array([words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)], pa.binary())
        out.append(np.append(vocabulary.symbols(words.hashes(), tail_class(held)), 0))
    return out


def _block_symbols(vocabulary: Vocabulary, hashes: bytes, tails: bytes, docs: bytes, numbers: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """A block's documents, the symbols of its distinct words, and each word's number."""
    symbol = vocabulary.symbols(np.frombuffer(hashes, np.uint64), np.frombuffer(tails, np.uint8))
    return from_bytes(docs), symbol, from_bytes(numbers).column(0).to_numpy()


def _trained(task: int, tokens: int, params: list[np.ndarray]) -> pa.RecordBatch:
    columns = ([task], [tokens], [b"".join(p.astype(np.float32).tobytes() for p in params)])
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["task", "tokens", "weights"])


def _mean_weights(rows: list[tuple[int, int, bytes]]) -> tuple[int, np.ndarray]:
    """Tokens of all tasks and the mean of their weights, in proportion to the tokens."""
    tokens, total = 0, 0.0
    for _, n, weights in sorted(rows):
        tokens += n
        total = total + n * np.frombuffer(weights, np.float32).astype(np.float64)
    return tokens, total / tokens


def _merge_weights(table: pa.Table) -> pa.Table:
    rows = list(zip(*(table.column(c).to_pylist() for c in ("task", "tokens", "weights")), strict=True))
    tokens, mean = _mean_weights(rows)
    return pa.Table.from_batches([_trained(min(r[0] for r in rows), tokens, [mean])])


def _by_levels(rows: DataFrame, key: str, most: int, merge: Callable, schema: str) -> list:
    """Rows with keys below `most` merged to FAN_IN rows at most, by tasks of FAN_IN rows each."""
    scale = 1
    while most > FAN_IN * scale:
        scale *= FAN_IN
        rows = rows.groupBy(F.expr(f"{key} div {scale}").alias("part")).applyInArrow(merge, schema)
    return rows.collect()


def _train(coded: DataFrame, vocabulary: Vocabulary, model: GatedUnit) -> int:
    """Train the model on all training documents of the blocks; the number of their symbols."""
    spark = coded.sparkSession
    rest, total = coded.filter("bucket < 0").select("block", "hashes", "tails", "docs", "numbers"), 0
    for nth in range(ROUNDS):
        start = spark.sparkContext.broadcast((vocabulary, model))
        rate = RATE * (1 - nth / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch], start=start, rate=rate) -> Iterator[pa.RecordBatch]:
            vocabulary, model = start.value
            model, tokens = copy.deepcopy(model), 0
            adam = Adam(model.params())
            for batch in batches:
                for row in zip(*(batch.column(c) for c in ("hashes", "tails", "docs", "numbers")), strict=True):
                    docs, symbol, number = _block_symbols(vocabulary, *(x.as_py() for x in row))
                    n = docs.column("n").to_numpy()
                    flat = np.insert(symbol[number], np.cumsum(n), 0)
                    flat = flat[np.repeat(docs.column("train").to_numpy(zero_copy_only=False), n + 1)]
                    if len(flat):
                        model.descend(flat, _lanes(len(flat), LANES, 16), adam, lambda: rate)
                        tokens += len(flat)
            if tokens:
                yield _trained(TaskContext.get().partitionId(), tokens, model.params())

        # Neighbouring blocks of a partition and first blocks of partitions are in different rounds.
        own = rest.filter(F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1), F.lit(ROUNDS)) == nth)
        found = _by_levels(own.mapInArrow(run, TRAINED), "task", own.rdd.getNumPartitions(), _merge_weights, TRAINED)
        if found:
            tokens, mean = _mean_weights([tuple(r) for r in found])
            total += tokens
            at = 0
            for p in model.params():
                p[:] = mean[at : at + p.size].reshape(p.shape)
                at += p.size
        start.unpersist()
    return total


def document_scores(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", fit_docs: int = 500, buckets: int | None = None
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    held_out: a condition on the id; rows for which it does not hold are learned from.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(~held_out, F.lit(False)).alias("train"),
        F.col(text).alias("text"),
    )
    coded = stored(rows.mapInArrow(_code(buckets), CODED), "coded")
    asked = coded.filter("bucket >= 0").select("bucket", "block", "together", "hashes", "counts", "tails").groupBy("bucket")
    # The groups' statistics are of a fixed size each.
    grouped = stored(asked.applyInArrow(_grouped, GROUPED), "counts")
    stats = grouped.filter("n IS NOT NULL").select("bucket", "n", "v", "words", F.col("top").alias("totals"), "tails")
    merged = _by_levels(stats, "bucket", buckets, _merge_stats, STATS)
    ends = rows.filter("train").count()
    vocabulary = Vocabulary(ends, *_statistics(merged))
    model = GatedUnit(vocabulary)
    sample = _sample(rows, fit_docs, vocabulary)
    if sample:
        model.learn(sample)
    _train(coded, vocabulary, model)

    def score(key: tuple, sent: pa.Table, answers: pa.Table) -> pa.Table:
        totals = {(b, g): np.frombuffer(x, np.int64) for b, g, x in zip(*(answers.column(c).to_pylist() for c in ("block", "bucket", "totals")), strict=True)}
        groups: dict[int, list[int]] = defaultdict(list)
        for b, g in sorted(totals):
            groups[b].append(g)
        names = ("block", "hashes", "tails", "docs", "numbers")
        symbols, docs, per_doc = [], [], []
        for b, *held in sorted(zip(*(sent.column(c).to_pylist() for c in names), strict=True)):
            d, symbol, number = _block_symbols(vocabulary, *held)
            total = np.concatenate([np.zeros(0, np.int64), *(totals[b, g] for g in groups[b])])
            tail = symbol >= SHORT
            share = np.zeros(len(symbol))
            share[tail] = np.log((total[tail] + 0.1) / vocabulary.tail_room[symbol[tail] - SHORT])
            n = d.column("n").to_numpy()
            bounds = np.concatenate([[0], np.cumsum(n)])

            def summed(by_word: np.ndarray, number: np.ndarray = number, bounds: np.ndarray = bounds) -> np.ndarray:
                """Sums over the words of each document."""
                out = np.add.reduceat(np.append(by_word[number], 0), bounds[:-1]) if len(bounds) > 1 else by_word[:0]
                out[np.diff(bounds) == 0] = 0
                return out

            # Each document's words, then its end.
            symbols.append(np.insert(symbol.astype(np.uint16)[number], bounds[1:], 0))
            known = summed((total > 0).astype(np.int64)) + (ends > 0)
            per_doc.append((n + 1, known, summed(vocabulary.base(total)) + vocabulary.base(np.float64(ends)), summed(share)))
            docs.append(d)
        table = pa.Table.from_batches(docs) if docs else None
        if table is None or not table.num_rows:
            return pa.Table.from_batches([], SCORES_ARROW)
        length, known, base, tails = (np.concatenate(x) for x in zip(*per_doc, strict=True))
        log_p = model.score(np.concatenate(symbols), np.concatenate([[0], np.cumsum(length)])) + tails
        columns = [table.column("doc_id"), table.column("held_out"), *(x.astype(np.int64) for x in (length, known)), base, log_p / np.log(10)]
        return pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], schema=SCORES_ARROW)

    totals = grouped.filter("totals IS NOT NULL").select("block", "bucket", "together", "totals")
    sent = coded.filter("bucket < 0").select("block", "together", "hashes", "tails", "docs", "numbers")
    scored = sent.groupBy("together").cogroup(totals.groupBy("together")).applyInArrow(score, SCORES)
    return scored.withColumn("train_tokens", F.lit(vocabulary.n).cast("long"))
