"""Near-duplicate vectors through spherical-cap filters of random product codes.

Filter directions are all concatenations of one code word per half of the
(rotated) space, so that many directions cost few inner products: a vector's
inner product with a direction is a sum of two, and the directions above the
cap's height are listed by sorting one half's sums and cutting the list for
each word of the other. Vectors meet in the filters they share and are
verified there by their exact cosine. The number of directions follows the
number of vectors, and the height is calibrated on simulated pairs right at the
threshold, so that buckets stay small and the recall stays the same at every
size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, connected_components

COSINE = 0.9
#: Share of pairs right at the threshold that must meet in a filter, and the simulated pairs it is calibrated on.
RECALL, PAIRS = 0.95, 600
#: Rows of a filter that one run compares; larger filters are cut into blocks of rows, compared block by block.
BLOCK = 2_048


class ProductCode:
    """Random directions, the same for every task from the same seed."""

    def __init__(self, dimension: int, words: int, cosine: float = COSINE, recall: float = RECALL, seed: int = 7):
        random = np.random.default_rng([seed, dimension])
        self.rotation = np.linalg.qr(random.standard_normal((dimension, dimension)))[0]
        self.half = max(1, dimension // 2)
        parts = [self.half, dimension - self.half] if dimension > 1 else [1]
        self.codes = []
        for part in parts:
            self.codes.append(random.standard_normal((words, part)))
        self.words = words
        self.height = self._calibrated(cosine, recall, random)

    def _sums(self, rows: np.ndarray) -> list[np.ndarray]:
        turned = rows @ self.rotation
        return [turned[:, : self.half] @ self.codes[0].T, *([turned[:, self.half :] @ self.codes[1].T] if len(self.codes) > 1 else [])]

    def _calibrated(self, cosine: float, recall: float, random) -> float:
        """The height at which this share of random pairs right at the threshold has a direction in common.

        A pair's height is the greatest, over directions, of the lesser of its
        two inner products; with long codes it is sought among the best words
        of each half, which can only lower it.
        """
        u, w = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in random.standard_normal((2, PAIRS, self.rotation.shape[0])))
        w = w - (w * u).sum(axis=1, keepdims=True) * u
        w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
        heights = []
        for one, two in zip(zip(*self._sums(u)), zip(*self._sums(cosine * u + math.sqrt(1 - cosine * cosine) * w))):
            best = [np.argsort(-(a + b))[:256] for a, b in zip(one, two)]
            a, b = ([x[i] for x, i in zip(side, best)] for side in (one, two))
            if len(a) == 1:
                heights.append(np.minimum(a[0], b[0]).max())
            else:
                heights.append(np.minimum(a[0][:, None] + a[1], b[0][:, None] + b[1]).max())
        return float(np.quantile(heights, 1 - recall))

    def decode(self, rows: np.ndarray) -> list[np.ndarray]:
        """All directions above the height for each unit row, ascending."""
        first, *rest = self._sums(rows)
        if not rest:
            return [np.flatnonzero(row >= self.height) for row in first]
        second = rest[0]
        order = np.argsort(-second, axis=1)
        out = []
        for a, b, by in zip(first, second, order):
            ranked = -b[by]
            able = np.flatnonzero(a - ranked[0] >= self.height)
            ends = np.searchsorted(ranked, a[able] - self.height, side="right")
            found = [word * self.words + by[:end] for word, end in zip(able, ends)]
            out.append(np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64))
        return out


def _units(column: pa.Array) -> np.ndarray:
    rows = np.array(column.to_pylist(), dtype=float)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _verify(ids, sizes, sides, rows, listed, bucket: int, cross: bool, cosine: float):
    """Links counted in this filter and labels of its linked rows.

    A pair counts in the first filter it shares only, so that sums over filters count it once.
    """
    linked = rows @ rows.T >= cosine
    np.fill_diagonal(linked, False)
    if cross:
        linked &= sides[:, None] != sides[None, :]
    at = np.flatnonzero(linked.any(axis=1))
    if not len(at):
        return None
    linked, ids, sizes = linked[np.ix_(at, at)], ids[at], sizes[at]
    earlier = [listed[i][listed[i] < bucket] for i in at]
    known, flat = np.unique(np.concatenate(earlier), return_inverse=True)
    counted = linked
    if len(known):
        has = np.zeros((len(at), len(known)), dtype=np.float32)
        has[np.repeat(np.arange(len(at)), [len(e) for e in earlier]), flat] = 1
        counted = linked & (has @ has.T < 0.5)
    label = ids.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            break
        label = low
    return ids, counted @ sizes, label


def link_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of vectors (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and stay, as do those of another dimension. Equal vectors
    are one class, compared once and counted by its size. A hub filter is cut
    into blocks of rows; nothing is capped.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"))
    kind = rows.schema["v"].dataType.simpleString()
    sound = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))
    classes = Stored(
        rows.where(sound).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "vector-classes"
    ).df
    words = max(64, math.ceil(math.sqrt(1.3 * max(1, classes.count()))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            size = np.array([len(v) for v in batch.column(2).to_pylist()])
            for d in np.unique(size):
                if d not in codes:
                    codes[d] = ProductCode(int(d), words, cosine, recall)
                at = np.flatnonzero(size == d)
                part = batch.take(pa.array(at))
                listed = codes[d].decode(_units(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([e.tolist() for e in listed], pa.list_(pa.int64()))],
                    names=["rep", "size", "v", "listed"],
                )

    assigned = Stored(
        classes.select("rep", "size", "v").mapInArrow(assign, f"rep long, size long, v {kind}, listed array<long>"), "vector-filters"
    ).df
    entries = assigned.withColumn("d", F.size("v")).withColumn("f", F.explode("listed"))
    many = entries.groupBy("d", "f").agg(F.count("*").alias("n")).where("n > 1").withColumn("c", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = entries.join(many, ["d", "f"]).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("c")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda o: F.struct(F.least("side", o).alias("a"), F.greatest("side", o).alias("b")))
    runs = placed.withColumn("_p", F.explode(pairs)).select("d", "f", "_p.a", "_p.b", "side", "rep", "size", "v", "listed")
    runs = runs.repartition("d", "f", "a", "b").sortWithinPartitions("d", "f", "a", "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            table = pa.Table.from_batches(held)
            result = _verify(
                table["rep"].to_numpy(), table["size"].to_numpy().astype(float), table["side"].to_numpy(), _units(table["v"].combine_chunks()),
                [np.array(e) for e in table["listed"].to_pylist()], key[1], key[2] != key[3], cosine,
            )
            if result is None:
                return []
            ids, links, label = result
            return [pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(label)], names=["rep", "links", "label"])]

        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            change = np.zeros(batch.num_rows, dtype=bool)
            for column in columns:
                change[1:] |= column[1:] != column[:-1]
            starts = [0, *np.flatnonzero(change), batch.num_rows]
            for begin, end in zip(starts, starts[1:]):
                if begin == end:
                    continue
                this = tuple(int(column[begin]) for column in columns)
                if this != key:
                    if held:
                        yield from done()
                    key, held = this, []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from done()

    verified = Stored(runs.mapInArrow(verify, "rep long, links long, label long"), "vector-links").df
    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(verified.select(F.col("rep").alias("a"), F.col("label").alias("b")))
    per_class = (
        classes.join(links, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = rows.where(sound).join(per_class, "v").select("vec_id", "n_links", "component_id").unionByName(alone)
    return joined.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
