"""Plain-Python versions of what the operators compute."""

import hashlib
import random
from collections import Counter


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def shingles(text):
    w = words(text, lower=True)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(texts):
    """Smallest index reachable by links of Jaccard similarity 0.8, for each text."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]


def cut_repeats(texts, window=35):
    """(words, removed, hash of kept words) of each text."""
    held = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in held for i in range(len(w) - window + 1))
    out = []
    for w in held:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, edits):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def odd_texts():
    """Nulls, blanks, short, repeated, long and unusual texts."""
    base, passage = prose(1, 200), prose(2, 60)
    return [
        None, "", " \n\t ", "One two", "one TWO", "one two three", prose(3, 9), prose(3, 9), prose(3, 10),
        base, base, edited(base, 1, 2), edited(base, 2, 3), edited(base, 3, 8), prose(4, 30) + " " + passage,
        passage + " " + prose(5, 40), prose(6, 20) + "\n" + passage + " " + prose(7, 25), passage + " " + passage,
        prose(8, 20000, 50), "É <|endoftext|> it's we're\x1f 日本語 😀 'll", "!!! ### 123 456", prose(9, 34), prose(9, 35), prose(9, 35),
    ]


def drop_lines(rows, least_chars=20, min_docs=3):
    """(doc_id, lines, dropped, kept text) of rows (doc_id, text)."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda line: line.strip(" \t\n\v\f\r").translate(table)
    holders = {}
    for i, (d, lines) in enumerate(split):
        for k in {key(x) for x in lines if len(key(x)) >= least_chars}:
            holders.setdefault(k, []).append(d)
    none = -(10**30)
    keeper = {k: max(none if d is None else d for d in v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, lines in split:
        kept = [x for x in lines if keeper.get(key(x), none if d is None else d) == (none if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def filter_counts(rows, labels):
    """Rows of the audit by plain application of every order; rows are (doc_id, lang, text)."""
    from itertools import permutations

    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    least = {}
    for d, _, t in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    docs = []
    for d, lang, t in rows:
        t = t or ""
        w = words(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": t in least and (d is None or d > least[t]),
        }
        docs.append((lang or "", {x for x, f in fails.items() if f}, d in good, d in toxic))
    out, removed_by = [], Counter()
    for part in sorted({p for p, *_ in docs}):
        own = [x for x in docs if x[0] == part]
        for order in permutations("ABCDE"):
            kept = own
            for step, x in enumerate(order, 1):
                gone = [y for y in kept if x in y[1]]
                kept = [y for y in kept if x not in y[1]]
                redundant = sum(x in y[1] for y in own) - len(gone)
                unique = sum(y[1] == {x} for y in own)
                removed_by[part, x] += len(gone)
                out.append((part, "".join(order), step, len(kept), len(gone), redundant, unique, sum(y[2] for y in gone), sum(y[3] for y in gone)))
    return Counter((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def vector_codes(rows, parts, entries, rounds, scale=1024):
    """(vec_id, code, error) of each row (vec_id, vector) in id order, and the codebooks."""
    import math

    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    w = len(whole[0]) // parts
    cut = [[x[p * w : p * w + w] for p in range(parts)] for x in whole]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for x in cut:
                got.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(got[i]) for c in zip(*got[i], strict=True)] if i in got else e for i, e in enumerate(books[p])]
    out = []
    for (i, _), x in zip(rows, cut, strict=True):
        best = [nearest(x[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return out, books
