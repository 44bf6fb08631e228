"""Sums of products of columns, from which least squares, components and correlations follow."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gram:
    """Number of rows, means, and sums of products of distances to the means."""

    columns: list[str]
    rows: int
    means: np.ndarray
    products: np.ndarray

    def correlation(self, a: str, b: str) -> float | None:
        i, j = self.columns.index(a), self.columns.index(b)
        spread = self.products[i, i] * self.products[j, j]
        return float(self.products[i, j] / np.sqrt(spread)) if spread > 0 else None

    def least_squares(self, target: str) -> tuple[np.ndarray, float]:
        """Coefficients of all other columns and the intercept; the shortest solution if columns depend on each other."""
        t = self.columns.index(target)
        rest = [i for i in range(len(self.columns)) if i != t]
        scale = np.sqrt(np.where(self.products.diagonal()[rest] > 0, self.products.diagonal()[rest], 1.0))
        inner = self.products[np.ix_(rest, rest)] / np.outer(scale, scale)
        solved = np.linalg.lstsq(inner, self.products[rest, t] / scale, rcond=1e-12)[0] / scale
        return solved, float(self.means[t] - solved @ self.means[rest])

    def components(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, k) directions of greatest variance, their largest entries positive, and their shares of the variance."""
        values, vectors = np.linalg.eigh(self.products)
        order = np.argsort(values)[::-1][:k]
        vectors = vectors[:, order]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(k)])
        return vectors, values[order] / values.sum()


def gram(df: DataFrame, columns: list[str]) -> Gram:
    """All means in one pass, all products in a second; rows with a null in any column are left out.

    Each pass is one aggregation without keys, combined per task, of at most
    columns² / 2 sums; only these reach the driver.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    first = rows.agg(F.count("*").alias("_rows"), *[F.avg(c).alias(c) for c in columns]).first()
    means = np.array([first[c] if first[c] is not None else 0.0 for c in columns])
    away = [F.col(c) - F.lit(float(m)) for c, m in zip(columns, means, strict=True)]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = rows.agg(*[F.sum(away[i] * away[j]).alias(f"_{i}_{j}") for i, j in pairs]).first()
    products = np.zeros((len(columns), len(columns)))
    for (i, j), value in zip(pairs, sums, strict=True):
        products[i, j] = products[j, i] = value or 0.0
    return Gram(columns, first["_rows"], means, products)
