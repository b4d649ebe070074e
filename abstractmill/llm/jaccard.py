"""N-gram Jaccard join: size-aware, light sets by subsets, heavy sets by inverted lists.

Documents link when their sets of distinct five-word shingles satisfy
100 * |intersection| >= 80 * |union|, that is when they share
c(r, s) = ceil(4 (r + s) / 9) shingles or more, r and s being their sizes.

1. *Repeated shingles.* Each block of documents sends its shingle hashes to groups; a
   group answers which of them occur in other documents. A document with less than
   80 % repeated shingles can link with nothing and leaves; its equals are one set from here on.
   The rest are counted once more among themselves, which gives each shingle its frequency.
2. *Light sets*, up to the boundary: for each size s of a partner every subset of c(r, s)
   repeated shingles is enumerated. Two sets of sizes r and s that have such a subset in
   common are linked, and sets that share none are not: no pair is compared, a group of sets
   is linked to one of its members.
3. *Heavy sets*: inverted lists over a prefix. In the order of rising frequency, sets that
   link share one of their first r - ceil(0.8 r) + 1 shingles. Each list is scanned against its
   most central set (of the most frequent shingles) first; these pairs are verified and
   joined to components. Then all pairs of a list that are in different components, and that
   their sizes and repeated shingles allow, are verified too, so no link is lost; members of
   one component need no comparison.
4. *Boundary*: the size that gives the least sum of subsets to enumerate below and list
   entries to scan above, from counts by size.

Defined cases: null and empty texts have no shingle, link with nothing and are their own
component; a text of less than five words is one shingle; equal sets are linked; a row
with a null id belongs to the component of its set (null if no member has an id); every
row gives a row; other columns are ignored. Sets are told apart by a 64-bit sum of mixed
hashes, shingles by 48 bits of their hash and their group.

Scale: texts are read once (twice by one_per_component) and only hashes of 6 bytes are shuffled, dealt by hash, so a
shingle that many documents hold is one entry per document in one of `buckets` groups and
the shingles of a common passage lie in different groups. Sets that may link are stored. Memory
of a task is one group or one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Words, block_numbers, mix, pieces, shingles, spread
from .components import components
from .rlz import _by_group, _pack, _unpack, from_bytes, to_bytes
from .stored import Scratch, discard, free_name, stored, viewed

BLOCK_BYTES = 2 << 20
#: Light sets have at most this many shingles, whatever the costs.
MOST_LIGHT = 24
#: Scanning and verifying a list entry costs as much as enumerating so many subsets.
ENTRY_COST = 8
SENT = "bucket int, block long, hashes binary, rows binary, docs binary"
ANSWER = "block long, bucket int, hashes binary, rows binary, counts binary, docs binary"


def least_shared(r: int, s: int) -> int:
    """Shingles that sets of sizes r and s must share to link."""
    return -(-4 * (r + s) // 9)


def _set_numbers(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A number for each set of shingles, by which equal sets are found."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h), out=total[1:])
    return mix((total[rows[1:]] - total[rows[:-1]]) ^ mix(np.diff(rows).astype(np.uint64))).view(np.int64)


def _text_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Shingle keys, offsets of the documents in them, and what is known of the documents."""
    for part in pieces(batch, "text", BLOCK_BYTES):
        words = Words(part.column("text"), lower=True)
        h, rows = shingles(words.hashes(), words.rows)
        yield h, rows, pa.RecordBatch.from_pydict(
            {"doc_id": part.column("doc_id"), "n": pa.array(np.diff(rows), pa.int64()), "same": pa.array(_set_numbers(h, rows))}
        )


def _stored_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """The same of sets that were stored with their keys."""
    for part in pieces(batch, "keys", BLOCK_BYTES):
        held = part.column("keys").to_pylist()
        rows = np.concatenate([[0], np.cumsum([len(x) // 8 for x in held])])
        yield np.frombuffer(b"".join(held), np.uint64), rows, part.select(["n", "same"])


def _send(sets: Callable, buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = block_numbers(TaskContext.get().partitionId())
        for batch in batches:
            for keys, rows, docs in sets(batch):
                block = next(blocks)
                group = ((mix(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order, bounds = _by_group(group.astype(np.int32), buckets)
                keys = keys[order]
                row = np.repeat(np.arange(len(rows) - 1, dtype=np.uint16), np.diff(rows))[order]
                used = np.flatnonzero(np.diff(bounds))
                cuts = [slice(bounds[g], bounds[g + 1]) for g in used]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([spread(block, buckets), *used.tolist()], pa.int32()),
                        "block": pa.array([block] * (len(used) + 1), pa.int64()),
                        "hashes": pa.array([None, *(_pack(keys[c], width) for c in cuts)], pa.binary()),
                        "rows": pa.array([None, *(row[c].tobytes() for c in cuts)], pa.binary()),
                        "docs": pa.array([to_bytes(docs)] + [None] * len(used), pa.binary()),
                    }
                )

    return run


def _look_up(width: int, counted: bool):
    def run(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {"block": [], "bucket": [], "hashes": [], "rows": [], "counts": [], "docs": []}
        blocks = table.column("block").to_pylist()
        sent, rows = table.column("hashes").to_pylist(), table.column("rows").to_pylist()
        for block, docs in zip(blocks, table.column("docs").to_pylist(), strict=True):
            if docs is not None:
                for name, x in zip(out, (block, None, None, None, None, docs), strict=True):
                    out[name].append(x)
        asked = [i for i, x in enumerate(sent) if x is not None]
        if asked:
            values = [_unpack(sent[i], width) for i in asked]
            bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])])
            _, at, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
            count = count[at].astype(np.int32)
            bucket = table.column("bucket")[0].as_py()
            for n, i in enumerate(asked):
                own = count[bounds[n] : bounds[n + 1]]
                several = own > 1
                if several.any():
                    row = np.frombuffer(rows[i], np.uint16)[several].tobytes()
                    counts = own[several].tobytes() if counted else None
                    for name, x in zip(out, (blocks[i], bucket, _pack(values[n][several], width), row, counts, None), strict=True):
                        out[name].append(x)
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
        return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})

    return run


def _repeated(table: pa.Table, width: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """A block's documents; offsets, keys and counts of their repeated shingles."""
    docs = from_bytes(next(x for x in table.column("docs").to_pylist() if x is not None))
    answers = table.filter(table.column("hashes").is_valid())
    keys, rows, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int32)]
    for g, h, r, c in zip(*(answers.column(x).to_pylist() for x in ("bucket", "hashes", "rows", "counts")), strict=True):
        key = _unpack(h, width)
        keys.append(key | np.uint64((g & 0xFFFF) << 48) if width == 6 else key)
        rows.append(np.frombuffer(r, np.uint16))
        counts.append(np.frombuffer(c, np.int32) if c is not None else np.zeros(len(key), np.int32))
    keys, rows, counts = np.concatenate(keys), np.concatenate(rows), np.concatenate(counts)
    order = np.lexsort((keys, counts, rows))
    bounds = np.searchsorted(rows[order], np.arange(docs.num_rows + 1))
    return docs, bounds, keys[order], counts[order]


def _maybe_linked(table: pa.Table) -> pa.Table:
    """All documents of a block; the repeated keys of those that may link with another."""
    docs, bounds, keys, _ = _repeated(table, 6)
    n = docs.column("n").to_numpy()
    fine = (n > 0) & (5 * np.diff(bounds) >= 4 * n)
    held = [keys[a:b].tobytes() if ok else None for a, b, ok in zip(bounds[:-1], bounds[1:], fine, strict=True)]
    return pa.table({name: docs.column(name) for name in docs.schema.names} | {"keys": pa.array(held, pa.binary())})


def _ranked(table: pa.Table) -> pa.Table:
    """Sets that may still link: keys by rising frequency, how many of them are in the prefix."""
    docs, bounds, keys, counts = _repeated(table, 8)
    n, same = docs.column("n").to_numpy(), docs.column("same").to_numpy()
    held = np.diff(bounds)
    out: dict[str, list] = {x: [] for x in ("same", "n", "held", "prefix", "score", "bits0", "bits1", "keys")}
    # A parity bit for each of 128 parts of the keys; see _may_link.
    bit = mix(keys ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(127)
    flag = np.uint64(1) << (bit & np.uint64(63))
    halves = [np.append(np.where(half, flag, np.uint64(0)), np.uint64(0)) for half in (bit < 64, bit >= 64)]
    low, high = (np.bitwise_xor.reduceat(x, bounds[:-1]).view(np.int64) for x in halves)
    for i in np.flatnonzero(5 * held >= 4 * n):
        own = counts[bounds[i] : bounds[i + 1]]
        prefix = max(0, int(n[i] + (-4 * n[i] // 5) + 1 - (n[i] - held[i])))
        row = (same[i], n[i], held[i], prefix, float(np.log(own).sum() / n[i]), low[i], high[i], keys[bounds[i] : bounds[i + 1]].tobytes())
        for name, x in zip(out, row, strict=True):
            out[name].append(x)
    kinds = (*[pa.int64()] * 4, pa.float64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})


def _subsets(n: int, held: int, most: int) -> list[tuple[int, int]]:
    """Partner sizes up to `most` of a light set, and the size of the subsets they must share."""
    sizes = range(-(-4 * n // 5), min(5 * n // 4, most) + 1)
    return [(s, least_shared(n, s)) for s in sizes if least_shared(n, s) <= min(n, s, held)]


def light_boundary(by_size: list[tuple[int, int, int, int]]) -> int:
    """The largest light size, from rows (size, repeated shingles, sets, their entries in lists)."""
    best, least = 0, float("inf")
    for x in range(MOST_LIGHT + 1):
        light = sum(count * sum(comb(held, c) for _, c in _subsets(n, held, x)) for n, held, count, _ in by_size if n <= x)
        heavy = sum(ENTRY_COST * entries for n, _, _, entries in by_size if 5 * n > 4 * x)
        if light + heavy < least:
            best, least = x, light + heavy
    return best


def _light_links(sets: DataFrame, most: int) -> DataFrame:
    """Edges between sets of at most `most` shingles."""

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, held, same = (batch.column(c)[i].as_py() for c in ("n", "held", "same"))
                keys = mix(np.frombuffer(batch.column("keys")[i].as_py(), np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
                for s, c in _subsets(n, held, most):
                    chosen = np.array(list(combinations(range(held), c)), np.int64).reshape(-1, c)
                    subset = mix(keys[chosen].sum(axis=1, dtype=np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "low": pa.array(np.full(len(subset), min(n, s)), pa.int64()),
                            "high": pa.array(np.full(len(subset), max(n, s)), pa.int64()),
                            "subset": pa.array(subset),
                            "same": pa.array(np.full(len(subset), same), pa.int64()),
                            "n": pa.array(np.full(len(subset), n), pa.int64()),
                        }
                    )

    found = sets.filter(F.col("n") <= most).mapInArrow(enumerate_subsets, "low long, high long, subset long, same long, n long")
    key = ["low", "high", "subset"]
    groups = found.groupBy(*key).agg(F.min("same").alias("m"), F.min("n").alias("a"), F.max("n").alias("b"))
    linked = groups.filter((F.col("a") == F.col("low")) & (F.col("b") == F.col("high")))
    return found.join(linked, key).filter("same != m").select(F.col("same").alias("u"), F.col("m").alias("v")).distinct()


def _may_link(a: str, b: str) -> Column:
    """Whether sizes and repeated shingles allow a link of the sets in columns `a` and `b`.

    Sets share no more than the repeated shingles of either. Each shingle that only one of
    them has flips one parity bit, so they differ in as many shingles at least as in bits.
    """
    x, y = ({c: F.col(f"{p}.{c}") for c in ("n", "held", "bits0", "bits1")} for p in (a, b))
    differ = sum(F.bit_count(x[c].bitwiseXOR(y[c])) for c in ("bits0", "bits1"))
    total = x["n"] + y["n"]
    return (9 * F.least(x["held"], y["held"]) >= 4 * total) & (9 * (x["held"] + y["held"] - differ) >= 8 * total)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that share enough of their shingles."""
    keys = sets.select("same", "n", "keys")
    both = pairs.join(keys.toDF("u", "n_u", "keys_u"), "u").join(keys.toDF("v", "n_v", "keys_v"), "v")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_pylist() for c in ("n_u", "n_v"))
            x, y = batch.column("keys_u"), batch.column("keys_v")
            linked = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(z[i].as_buffer(), np.uint64) for z in (x, y))
                all_keys = np.sort(np.concatenate([a, b]))
                shared = int((all_keys[1:] == all_keys[:-1]).sum())
                linked.append(9 * shared >= 4 * (n[i] + m[i]))
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(verify, "u long, v long")


def _heavy_links(sets: DataFrame, most_light: int) -> DataFrame:
    """Edges that connect all sets of which one at least is heavy."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("same", "n", "held", "score", "bits0", "bits1")
        for batch in batches:
            size = batch.column("prefix").to_numpy()
            keys = [np.frombuffer(k, np.int64)[:p] for k, p in zip(batch.column("keys").to_pylist(), size, strict=True)]
            row = pa.array(np.repeat(np.arange(batch.num_rows), size))
            key = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_pydict({"key": pa.array(key)} | {c: batch.column(c).take(row) for c in names})

    heavy = sets.filter(5 * F.col("n") > 4 * F.lit(most_light)).filter("prefix > 0")
    entries = stored(heavy.mapInArrow(prefixes, "key long, same long, n long, held long, score double, bits0 long, bits1 long"), "lists")

    centre = F.max(F.struct("score", "same", "n", "held", "bits0", "bits1")).alias("c")
    centres = entries.groupBy("key").agg(centre, F.count("*").alias("size")).filter("size > 1")
    first = (
        entries.alias("e")
        .join(centres, "key")
        .filter((F.col("e.same") != F.col("c.same")) & _may_link("e", "c"))
        .select(F.col("e.same").alias("u"), F.col("c.same").alias("v"))
        .distinct()
    )
    links = stored(_verified(first, sets), "links")
    labels = components(links)

    placed = entries.join(labels.withColumnRenamed("node", "same"), "same", "left").withColumn(
        "component", F.coalesce("component", "same")
    )
    lists = placed.groupBy("key").agg(
        F.max(F.struct("score", "same", "component"))["component"].alias("main"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("n").alias("least_n"),
    )
    open_lists = lists.filter("low != high").select("key", "main", "least_n")
    # A set outside the list's main component that could still link with its smallest one.
    loose = placed.join(open_lists, "key").filter((F.col("component") != F.col("main")) & (9 * F.col("held") >= 4 * (F.col("n") + F.col("least_n"))))
    member = ["key", "same", "n", "held", "bits0", "bits1", "component"]
    loose = stored(loose.select(*member), "loose", narrow=True)
    a, b = loose.alias("a"), placed.select(*member).alias("b")
    rest = (
        a.join(b, F.col("a.key") == F.col("b.key"))
        .filter((F.col("a.component") != F.col("b.component")) & _may_link("a", "b"))
        .select(F.least("a.same", "b.same").alias("u"), F.greatest("a.same", "b.same").alias("v"))
        .distinct()
    )
    return links.union(_verified(rest, sets))


def _linked_sets(docs: DataFrame, doc_id: str, text: str, buckets: int | None) -> tuple[DataFrame, DataFrame]:
    """doc_id, n and same (the number of its set) of every row; same and component of linked sets.

    All other tables on the way are deleted.
    """
    buckets = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def exchange(df: DataFrame, sets: Callable, width: int, counted: bool, finish: Callable, schema: str) -> DataFrame:
        sent = df.mapInArrow(_send(sets, buckets, width), SENT)
        answers = sent.groupBy("bucket").applyInArrow(_look_up(width, counted), ANSWER)
        return answers.groupBy("block").applyInArrow(finish, schema)

    with Scratch() as scratch:
        held = stored(exchange(texts, _text_sets, 6, False, _maybe_linked, "doc_id long, n long, same long, keys binary"), "members")
        members = scratch.keep(stored(held.select("doc_id", "n", "same"), "members", narrow=True))
        equal = held.filter("keys is not null").groupBy("same").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
        ranked = exchange(
            equal, _stored_sets, 8, True, _ranked, "same long, n long, held long, prefix long, score double, bits0 long, bits1 long, keys binary"
        )
        sets = stored(ranked, "sets")
        discard(held)

        small = sets.filter(F.col("n") <= 2 * MOST_LIGHT).groupBy("n", "held")
        by_size = [tuple(r) for r in small.agg(F.count("*"), F.sum("prefix")).collect()]  # bounded by the sizes
        boundary = light_boundary(by_size)
        links = _heavy_links(sets, boundary).union(_light_links(sets, boundary)) if boundary else _heavy_links(sets, 0)
        labels = scratch.keep(components(links))
    return members, viewed(labels.withColumnRenamed("node", "same"), labels)


def shingle_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every row.

    buckets: groups that shingles are dealt to, four times the shuffle partitions if unset.
    """
    members, labels = _linked_sets(docs, doc_id, text, buckets)
    filled = members.filter("n > 0")
    smallest = filled.groupBy("same").agg(F.min("doc_id").alias("own"))
    placed = smallest.join(labels, "same", "left").withColumn("component", F.coalesce("component", "same"))
    ids = placed.groupBy("component").agg(F.min("own").alias("component_id"))
    by_set = placed.join(ids, "component").select("same", "component_id")
    return (
        filled.join(by_set, "same")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .union(members.filter("n = 0").select("doc_id", "n", "doc_id"))
    )


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs of each component, with all its columns, and all rows without a word.

    Rows are told apart by id and set of shingles: of a component the smallest id (null is the
    largest) stays, of its sets the one with the smallest number, of rows with this id and set
    one. The texts are read again for that, no copy of them is stored.
    """
    members, labels = _linked_sets(docs, doc_id, text, None)
    placed = members.filter("n > 0").join(labels, "same", "left").withColumn("component", F.coalesce("component", "same"))
    rows = placed.groupBy("component", "doc_id", "same").agg(F.count("*").alias("rows"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("same").alias("set"))
    first = rows.groupBy("component").agg(F.min(rank).alias("first"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("same") == F.col("first.set"))
    judged = rows.join(first, "component").select(F.col("doc_id").alias("id"), F.col("same").alias("set"), kept.alias("kept"), "rows")
    # Rows that go, and kept ones that come more than once; the rest of the documents is in neither.
    judged = stored(judged.filter("not kept or rows > 1").select("id", "set", "kept"), "judged", narrow=True)
    discard(members, labels)

    name = free_name(docs.columns, "same")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, BLOCK_BYTES):
                words = Words(part.column(text), lower=True)
                h, bounds = shingles(words.hashes(), words.rows)
                same = pa.array(_set_numbers(h, bounds), mask=np.diff(bounds) == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, same], [*part.schema.names, name])

    keyed = docs.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
    fits = keyed[doc_id].cast("long").eqNullSafe(F.col("id")) & (keyed[name] == F.col("set"))
    left = keyed.join(judged.filter("not kept").select("id", "set"), fits, "left_anti")
    twice = judged.filter("kept").select("id", "set")
    if not twice.take(1):
        return left.select(*docs.columns)
    several = left.join(twice, fits, "left_semi").groupBy(doc_id, name)
    one = several.agg(F.min_by(F.struct(*docs.columns), F.xxhash64(text)).alias("row")).select("row.*")
    return left.join(twice, fits, "left_anti").select(*docs.columns).union(one)
