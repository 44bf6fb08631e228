"""Removal of passages of LENGTH bytes that start anywhere else too, by parsing at rolling-hash triggers.

Every window of LENGTH bytes has a trigger: the gram of GRAM bytes in it with
the least rolling hash, the leftmost of equal ones. The trigger depends on the
window's bytes alone, so equal windows have theirs at the same offset and split
there into equal left and right parts: it is enough to compare windows at
triggers. The triggers cut a text into phrases, about one per 93 bytes.

A trigger's context is what its windows can see. Equal contexts are one class
of the dictionary, whose windows are all repeated if the class has two members.
Windows that cross the edge of a repeated passage belong to classes that share
only one side with others. Those are sorted on both sides: by what follows the
trigger (the order of the parse) and by what precedes it, read backwards (the
order of the phrases' ends). Common lengths of neighbours in the two orders
combine into the groups of equal windows, as in a suffix array, but only
contexts at passages' edges are ever ordered. Texts without a repeated side are
never touched again after one scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, map_batches

LENGTH, GRAM = 200, 16
GRAMS = LENGTH - GRAM + 1
#: Bytes after (or before) a trigger that a repeated window must repeat: one side has at least half.
SIDE = LENGTH // 2
#: Classes that are compared with each other in one task; the windows of larger groups are counted by their hashes.
GROUP, PAIRWISE = 4_096, 48
#: Window starts that are handled at once in a very long text.
SEGMENT = 1 << 22

_LOW = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from running minima of blocks in both directions."""
    size = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:size], ahead[width - 1 : width - 1 + size])


def triggers(data: bytes) -> tuple[np.ndarray, ...] | None:
    """(position, least and greatest left part, hash of the SIDE bytes after, hash of those before) of each trigger.

    A hash is 0 where the text is too short for it.
    """
    n = len(data)
    if n < LENGTH:
        return None
    size = 1 << max(12, int(n).bit_length())
    values = _TABLE[np.frombuffer(data, dtype=np.uint8)]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.add.accumulate(values * _powers(_BASE, size)[:n], out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), size)
    hashed = lambda begin, end: (sums[end] - sums[begin]) * inverse[begin]
    places = []
    for first in range(0, n - LENGTH + 1, SEGMENT):
        last = min(first + SEGMENT, n - LENGTH + 1)
        at = np.arange(first, last + GRAMS - 1)
        keyed = (_mixed(hashed(at, at + GRAM)) & ~_LOW) | (at - first).astype(np.uint64)
        places.append((_sliding_least(keyed, GRAMS) & _LOW).astype(np.int64) + first)
    of_window = np.concatenate(places)
    position, start, many = np.unique(of_window, return_index=True, return_counts=True)
    after = np.where(position + SIDE <= n, _mixed(hashed(position, np.minimum(position + SIDE, n))), 0)
    before = np.where(position >= SIDE, _mixed(hashed(np.maximum(position - SIDE, 0), position) + np.uint64(77)), 0)
    return position, position - (start + many - 1), position - start, after.view(np.int64), before.view(np.int64)


def _context(data: bytes, position: int) -> tuple[bytes, bytes]:
    return data[max(0, position - GRAMS + 1) : position], data[position : position + LENGTH]


def _class(data: bytes, position: int) -> bytes:
    left, right = _context(data, position)
    return hashlib.blake2b(len(left).to_bytes(2, "big") + left + right, digest_size=16).digest()


def _same(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def _orders(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of texts and each one's common length with the one before it."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    common = [0, *[_same(texts[a], texts[b]) for a, b in zip(order, order[1:])]]
    return np.array(order), np.array(common)


def repeated_parts(lows: list[int], highs: list[int], lefts: list[bytes], rights: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each context the ranges of left lengths l whose windows another context has too.

    A window is the last l bytes of the left and the first LENGTH - l of the right part.
    """
    n = len(lows)
    backwards = [left[::-1] for left in lefts]
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n <= PAIRWISE:
        for i in range(n):
            for j in range(i):
                low, high = max(lows[i], lows[j]), min(highs[i], highs[j])
                if low > high:
                    continue
                low = max(low, LENGTH - _same(rights[i], rights[j]))
                if low > high:
                    continue
                high = min(high, _same(backwards[i], backwards[j]))
                if low <= high:
                    out[i].append((low, high))
                    out[j].append((low, high))
        return [_merged(ranges) for ranges in out]
    low, high = np.array(lows), np.array(highs)
    by_right, with_right = _orders(rights)
    by_left, with_left = _orders(backwards)
    right, left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for l in range(int(low.min()), int(high.max()) + 1):
        right[by_right] = np.cumsum(with_right < LENGTH - l)
        left[by_left] = np.cumsum(with_left < l)
        at = np.flatnonzero((low <= l) & (l <= high))
        _, index, many = np.unique(left[at] * (n + 1) + right[at], return_inverse=True, return_counts=True)
        for i in at[many[index] > 1]:
            out[i].append((l, l))
    return [_merged(ranges) for ranges in out]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _sides(docs: DataFrame) -> DataFrame:
    """(h, key, at): the hashes on both sides of every trigger; at is twice its position, plus 1 for what precedes."""

    def start():
        def work(keys, texts):
            h, at, many = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], []
            for text in texts:
                found = triggers((text or "").encode())
                before = len(h)
                if found is not None:
                    position, _, _, after, preceding = found
                    for side, hashes in enumerate((after, preceding)):
                        there = hashes != 0
                        h.append(hashes[there])
                        at.append(position[there] * 2 + side)
                many.append(sum(map(len, h[before:])))
            return np.concatenate(h), pa.array(keys, pa.int64()).take(np.repeat(np.arange(len(keys)), np.array(many, dtype=np.int64))), np.concatenate(at)

        return work

    return map_batches(docs, [("h", "long"), ("key", "long"), ("at", "long")], start)


def _candidates(rows: DataFrame) -> DataFrame:
    """(key, print, pos, low, high, class, after, before) of the triggers with a repeated side, from texts and their lists `at`."""

    def start():
        def work(keys, prints, texts, lists):
            out = [[] for _ in range(8)]
            for key, mark, text, at in zip(keys, prints, texts, lists):
                data = (text or "").encode()
                found = triggers(data)
                if found is None:
                    continue
                marked = set(at)
                for position, low, high, after, before in zip(*[column.tolist() for column in found]):
                    sides = (after if position * 2 in marked else None, before if position * 2 + 1 in marked else None)
                    if sides != (None, None):
                        for column, value in zip(out, (key, mark, position, low, high, _class(data, position), *sides)):
                            column.append(value)
            return out

        return work

    schema = [("key", "long"), ("print", "long"), ("pos", "long"), ("low", "int"), ("high", "int"), ("class", "binary"), ("after", "long"), ("before", "long")]
    return map_batches(rows.select("key", "print", "text", "at"), schema, start)


def _contexts(rows: DataFrame, largest: int) -> DataFrame:
    """The contexts of the classes that share a side, once for each side, or window by window where the group is large."""

    def start():
        def work(keys, prints, texts, lists):
            out = [[] for _ in range(11)]
            for key, mark, text, edges in zip(keys, prints, texts, lists):
                data = (text or "").encode()
                for edge in edges:
                    position = edge["pos"]
                    if position > len(data) or _class(data, position) != edge["class"]:
                        continue
                    left, right = _context(data, position)
                    sides = (("after", "n_after", 0, SIDE), ("before", "n_before", SIDE + 1, LENGTH))
                    for side, (name, many, least, most) in enumerate(sides):
                        low, high = max(edge["low"], least), min(edge["high"], most)
                        if edge[many] is None or low > high:
                            continue
                        if edge[many] <= largest:
                            parts = [(edge[name], None, low, high, left, right)]
                        else:
                            digest = lambda l: hashlib.blake2b(data[position - l : position - l + LENGTH], digest_size=16).digest()  # noqa: B023, E731
                            parts = [(None, digest(l), l, l, None, None) for l in range(low, high + 1)]
                        for part in parts:
                            for column, value in zip(out, (part[0], side, part[1], key, mark, position, edge["n"], *part[2:])):
                                column.append(value)
            return out

        return work

    schema = [("group", "long"), ("side", "int"), ("window", "binary"), ("key", "long"), ("print", "long"), ("pos", "long"), ("n", "long"), ("low", "int"), ("high", "int"), ("left", "binary"), ("right", "binary")]
    return map_batches(rows.select("key", "print", "text", "edges"), schema, start)


def _edge_ranges(contexts: DataFrame) -> DataFrame:
    """(key, print, begin, end): bytes of the repeated windows of single contexts, group by group."""
    rows = contexts.repartition("group", "side").sortWithinPartitions("group", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            found = repeated_parts([r[3] for r in held], [r[4] for r in held], [r[5] for r in held], [r[6] for r in held])
            return [
                (own, mark, position - high, position - low + LENGTH)
                for (own, (mark, position), many, *_), ranges in zip(held, found)
                if many == 1
                for low, high in ranges
            ]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["key", "print", "begin", "end"])

        for batch in batches:
            out = []
            for group, side, own, mark, position, many, low, high, left, right in zip(*[c.to_pylist() for c in batch.columns]):
                if (group, side) != key:
                    out += done() if len(held) > 1 else []
                    key, held = (group, side), []
                held.append((own, (mark, position), many, low, high, left, right))
            yield batch_of(out)
        if len(held) > 1:
            yield batch_of(done())

    columns = ["group", "side", "key", "print", "pos", "n", "low", "high", "left", "right"]
    return rows.select(*columns).mapInArrow(run, "key long, print long, begin long, end long")


def repeated_ranges(docs: DataFrame, largest: int = GROUP) -> DataFrame:
    """(key, print, ranges): for texts with repeated passages, the sorted disjoint byte ranges they cover.

    `docs` has (key, print, text); equal rows are occurrences of their own.
    """
    sides = Stored(_sides(docs.select("key", "text")), "passage-hashes", small=True)
    often = sides.df.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    listed = Stored(sides.df.join(often, "h", "left_semi").groupBy("key").agg(F.collect_set("at").alias("at")), "passage-sides")
    sides.remove()
    found = Stored(_candidates(docs.join(listed.df, "key")), "passage-triggers", small=True)
    listed.remove()
    one = F.min(F.struct("key", "print", "pos", "low", "high", "after", "before")).alias("one")
    classes = Stored(found.df.groupBy("class").agg(F.count("*").alias("n"), one).select("class", "n", "one.*"), "passage-classes")
    edges = classes.df
    for name in ("after", "before"):
        groups = classes.df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias(f"n_{name}")).where(f"n_{name} > 1")
        edges = edges.join(groups, name, "left")
    edges = edges.where("n_after is not null or n_before is not null")
    fields = ["pos", "class", "n", "low", "high", "after", "before", "n_after", "n_before"]
    lists = Stored(edges.groupBy("key", "print").agg(F.collect_list(F.struct(*fields)).alias("edges")), "passage-edges")
    # A context comes once even where equal rows of docs share key and print.
    contexts = Stored(_contexts(docs.join(lists.df, ["key", "print"]).dropDuplicates(["key", "print"]), largest), "passage-contexts", small=True)
    windows = contexts.df.where(F.col("window").isNotNull())
    twice = windows.groupBy("window").agg(F.count("*").alias("c")).where("c > 1").select("window")
    counted = windows.where("n = 1").join(twice, "window", "left_semi").select(
        "key", "print", (F.col("pos") - F.col("high")).alias("begin"), (F.col("pos") - F.col("low") + LENGTH).alias("end")
    )
    whole = found.df.join(classes.df.where("n > 1").select("class"), "class", "left_semi").select(
        "key", "print", (F.col("pos") - F.col("high")).alias("begin"), (F.col("pos") - F.col("low") + LENGTH).alias("end")
    )
    ranges = _edge_ranges(contexts.df.where(F.col("window").isNull())).unionByName(counted).unionByName(whole)
    out = Stored(ranges.groupBy("key", "print").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")), "passage-ranges", small=True)
    for step in (found, classes, lists, contexts):
        step.remove()
    return out.df


def remove_repeated(docs: DataFrame, keep_bytes: bool = True, largest: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]) for every row of docs (doc_id, text).

    A null text is empty; texts shorter than LENGTH lose nothing; equal rows
    are occurrences of each other and lose all if long enough. Ids may be null
    or repeated. Other columns are not read.
    """
    marked = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", F.coalesce("doc_id", marked).alias("key"), marked.alias("print"), "text")
    ranges = repeated_ranges(rows.select("key", "print", "text"), largest)

    def start():
        def work(ids, texts, lists):
            out = [[] for _ in range(6)]
            for doc, text, found in zip(ids, texts, lists):
                data = (text or "").encode()
                spans = _merged([(r["begin"], r["end"] - 1) for r in found or ()])
                kept, at = [], 0
                for low, high in spans:
                    kept.append(data[at:low])
                    at = high + 1
                kept = b"".join([*kept, data[at:]])
                row = (doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None)
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    schema = [("doc_id", "long"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "binary")]
    joined = rows.join(ranges, ["key", "print"], "left").select("doc_id", "text", "ranges")
    done = map_batches(joined, schema, start)
    # Digests are stored, as only so their workers are handed small batches without a change of the caller's session.
    return done if keep_bytes else Stored(done.drop("kept"), "passage-digests", small=True).df
