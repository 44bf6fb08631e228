"""k-means with many starts and many k in one pass an iteration.

A pass sends all sets of centres to the rows, not the rows to the sets: every task
adds up, for each (set, centre), its nearest rows' number, coordinates and squared
distances, and one combined sum per (set, centre) reaches the driver. Sets that no
longer move take no part in further passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which starting centres are drawn, and the parts of the hash range that choose them.
SAMPLE, PARTS = 4096, 1 << 20
#: Rows worth a task of their own, and the tasks whose sums the driver adds up without a shuffle.
TASK, FEW = 1 << 16, 16


@dataclass(frozen=True)
class Centres:
    """One set of centres and the sum of squared distances to them."""

    columns: list[str]
    points: np.ndarray
    cost: float

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add `cluster`, the number of the nearest centre (the first, if several are)."""
        distances = [sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(self.columns, p, strict=True)), F.lit(0.0)) for p in self.points]
        distances = F.array(*distances)
        return rows.withColumn("cluster", (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(points)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - points[None, :, i]) ** 2
    return out


def _spread_out(sample: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """k rows of the sample, each drawn in proportion to its squared distance from those before."""
    chosen = [sample[random.integers(len(sample))]]
    nearest = _distances(sample, np.array(chosen))[:, 0]
    for _ in range(k - 1):
        total = nearest.sum()
        at = random.choice(len(sample), p=nearest / total) if total > 0 else random.integers(len(sample))
        chosen.append(sample[at])
        nearest = np.minimum(nearest, _distances(sample, sample[at : at + 1])[:, 0])
    return np.array(chosen)


def _moved(points: np.ndarray, sizes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The means of the centres' rows; a centre without rows stays."""
    return np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], points)


def _settled(sample: np.ndarray, points: np.ndarray, iterations: int) -> np.ndarray:
    """Centres moved on the sample until they rest, to begin near where they will end."""
    for _ in range(iterations):
        nearest = _distances(sample, points).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(points)).astype(float)
        sums = np.column_stack([np.bincount(nearest, weights=v, minlength=len(points)) for v in sample.T])
        before, points = points, _moved(points, sizes, sums)
        if np.array_equal(before, points):
            break
    return points


def _sums(rows: DataFrame, columns: list[str], tasks: int, sets: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each set the rows and coordinate sums by centre, and the cost."""
    names = ["set", "centre", "rows", "cost", *[f"s{i}" for i in range(len(columns))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            for number, points in sets.items():
                distances = _distances(x, points)
                nearest = distances.argmin(axis=1)
                values = [np.ones(len(x)), distances[np.arange(len(x)), nearest], *x.T]
                held[number] = held.get(number, 0.0) + np.column_stack([np.bincount(nearest, weights=v, minlength=len(points)) for v in values])
        out = np.array([(number, centre, *line) for number, lines in held.items() for centre, line in enumerate(lines)]).reshape(-1, len(names))
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in out.T], names=names)

    parts = rows.mapInArrow(run, ", ".join(f"`{n}` double" for n in names))
    if tasks > FEW:
        parts = parts.groupBy("set", "centre").agg(*[F.sum(n).alias(n) for n in names[2:]])
    found = {number: (np.zeros(len(p)), np.zeros(p.shape), 0.0) for number, p in sets.items()}
    for number, centre, count, cost, *coordinates in parts.collect():
        sizes, sums, before = found[int(number)]
        sizes[int(centre)] += count
        sums[int(centre)] += coordinates
        found[int(number)] = sizes, sums, before + cost
    return found


def best_centres(rows: DataFrame, columns: list[str], ks: list[int], restarts: int, seed: int, key: str = "stop", iterations: int = 50, still: float = 1e-4) -> dict[int, Centres]:
    """For each k the cheapest of `restarts` runs.

    Starts are drawn from rows chosen by a hash of the key, about SAMPLE of them, and settled among these; everything after looks at all rows.
    """
    total = max(rows.count(), 1)
    chosen = F.pmod(F.xxhash64(key), F.lit(PARTS)) < min(PARTS, -(-SAMPLE * PARTS // total))
    sample = np.array([list(r) for r in rows.where(chosen).orderBy(key).select(*columns).collect()], dtype=float).reshape(-1, len(columns))
    if not len(sample):
        raise ValueError("no rows to cluster")
    tasks = -(-total // TASK)
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).coalesce(tasks).persist()
    plan = [(k, restart) for k in ks for restart in range(restarts)]
    sets = {i: _settled(sample, _spread_out(sample, k, np.random.default_rng([seed, k, restart])), iterations) for i, (k, restart) in enumerate(plan)}
    moving = set(sets)
    for _ in range(iterations):
        if not moving:
            break
        for number, (sizes, sums, _) in _sums(rows, columns, tasks, {i: sets[i] for i in sorted(moving)}).items():
            new = _moved(sets[number], sizes, sums)
            if np.square(new - sets[number]).sum(axis=1).max() <= still**2:
                moving.discard(number)
            sets[number] = new
    best: dict[int, Centres] = {}
    for number, (_, _, cost) in _sums(rows, columns, tasks, sets).items():
        k = plan[number][0]
        if k not in best or cost < best[k].cost:
            best[k] = Centres(columns, sets[number], cost)
    rows.unpersist()
    return best
