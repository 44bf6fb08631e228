"""A quality classifier: a generalised additive model with pairwise interactions.

Features of a whole text are cut into bins at quantiles of the training rows.
Shallow trees are boosted cyclically, one feature after another with a small
rate, and each tree only adds to its feature's lookup table. Then the pairs of
features that explain most of what remains get tables over two coarser sets of
bins, learnt the same way. A score is a sum of looked-up numbers, one per
feature and pair, through the logistic function.
"""

from __future__ import annotations

import json
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, map_batches

#: Labelled rows the model is fitted on, at most, chosen by a hash of the id.
TRAINING_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = (
    "log_words log_chars mean_word long_words distinct_words top_word repeated_next upper capital_words digits "
    "punctuation symbols white marks_per_word bars lines mean_line distinct_lines non_ascii top_char"
).split()


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; an empty or null text gives zeros."""
    text = text or ""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    many = len(words)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.bincount(np.minimum(data, 128), minlength=129)
    total = float(n)
    upper = low[65:91].sum()
    digits = low[48:58].sum()
    common = low[[33, 34, 39, 44, 45, 46, 58, 59, 63]].sum()
    white = low[[9, 10, 11, 12, 13, 32]].sum()
    letters = low[97:123].sum() + upper + low[128]
    symbols = total - letters - digits - common - white
    lines = text.split("\n")
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        float(np.log1p(many)),
        float(np.log1p(n)),
        (total - white) / many,
        sum(len(word) > 20 for word in counts) / len(counts),
        len(counts) / many,
        max(counts.values()) / many,
        same / many,
        upper / total,
        sum(map(str.isupper, words)) / many,
        digits / total,
        common / total,
        symbols / total,
        white / total,
        (low[33] + low[63]) / many,
        low[124] / many,
        float(np.log1p(len(lines))),
        float(np.log1p(n / len(lines))),
        len({*lines}) / len(lines),
        low[128] / total,
        float(low[:128][[*range(33, 128)]].max()) / total,
    ]


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, cuts, tables, pairs, pair_tables, base):
        self.cuts, self.tables, self.pairs, self.pair_tables, self.base = cuts, tables, pairs, pair_tables, base

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cut, x[:, j], side="right") for j, cut in enumerate(self.cuts)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        out = np.full(len(x), self.base)
        for j, lookup in enumerate(self.tables):
            out += lookup[at[:, j]]
        for (i, j), lookup in zip(self.pairs, self.pair_tables):
            out += lookup[at[:, i] >> 2, at[:, j] >> 2]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))

    def to_json(self) -> str:
        arrays = lambda rows: [np.asarray(row).tolist() for row in rows]
        return json.dumps([arrays(self.cuts), arrays(self.tables), self.pairs, arrays(self.pair_tables), self.base])

    @classmethod
    def from_json(cls, data: str) -> AdditiveModel:
        cuts, tables, pairs, pair_tables, base = json.loads(data)
        return cls([np.array(c) for c in cuts], [np.array(t) for t in tables], [tuple(p) for p in pairs], [np.array(t) for t in pair_tables], base)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """The values of a shallow tree over ordered bins: best splits first, up to so many leaves."""
    parts = [(0, len(gradient))]
    g, h = np.concatenate([[0], gradient.cumsum()]), np.concatenate([[0], weight.cumsum()])
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    while len(parts) < leaves:
        best = None
        for part in parts:
            a, b = part
            if b - a < 2:
                continue
            middle = np.arange(a + 1, b)
            gain = worth(a, middle) + worth(middle, b) - worth(a, b)
            at = int(gain.argmax())
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                best = (gain[at], part, int(middle[at]))
        if best is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, leaves: int = 3, max_bins: int = 32, n_pairs: int = 8, ridge: float = 2.0) -> AdditiveModel:
    """Cyclic boosting of logistic loss; without rows of both labels the model is a constant."""
    d = x.shape[1]
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, max_bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(d)]
    model = AdditiveModel(cuts, [np.zeros(len(c) + 1) for c in cuts], [], [], base)
    if not len(y) or y.min() == y.max():
        return model
    at = model.bins(x)
    margin = np.full(len(y), base)

    def step(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(rounds):
        for j in range(d):
            change = rate * _tree(*step(at[:, j], len(model.tables[j])), leaves, ridge)
            model.tables[j] += change
            margin += change[at[:, j]]
    coarse, wide = at >> 2, max_bins // 4 + 1
    gains = []
    for i, j in combinations(range(d), 2):
        g, h = step(coarse[:, i] * wide + coarse[:, j], wide * wide)
        gains.append((float((g * g / (h + ridge)).sum()), i, j))
    for _, i, j in sorted(gains, reverse=True)[:n_pairs]:
        model.pairs.append((i, j))
        model.pair_tables.append(np.zeros((wide, wide)))
    for _ in range(rounds // 3):
        for (i, j), lookup in zip(model.pairs, model.pair_tables):
            index = coarse[:, i] * wide + coarse[:, j]
            g, h = (a.reshape(wide, wide) for a in step(index, wide * wide))
            # A tree of two levels: the better of both first features, then a split of the other on each side.
            change = _pair_tree(g, h, ridge) * rate
            lookup += change
            margin += change.ravel()[index]
    return model


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    best = None
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            out = np.empty_like(a)
            gain = 0.0
            for side in (slice(0, cut), slice(cut, None)):
                values = _tree(a[side].sum(axis=0), b[side].sum(axis=0), 2, ridge)
                gain += float((values * a[side].sum(axis=0)).sum())
                out[side] = values
            if best is None or gain > best[0]:
                best = (gain, out.T if turned else out)
    return best[1]


def document_features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): one row per row of docs, whole texts."""

    def start():
        return lambda ids, texts: (ids, [features(text) for text in texts])

    return map_batches(docs.select("doc_id", "text"), [("doc_id", "long"), ("x", "array<double>")], start)


def held_out() -> F.Column:
    """Rows that no label is learnt from: crc32 of the id as text leaves 2 when divided by 4; null ids are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def train(described: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Fit on at most `rows` labelled rows outside the held-out fold: those with the least hash of their id.

    Labels other than 0 and 1, and repeated ids with both labels, are left out.
    """
    clean = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("_m")).where("y = _m")
    usable = described.where(~held_out()).join(clean.select("doc_id", "y"), "doc_id").withColumn("_hash", F.xxhash64("doc_id"))
    total, share, chosen = usable.count(), 0.0, []
    # Hashes below a bound are asked for, so that no more than about `rows` leave all tasks together.
    while len(chosen) < min(rows, total):
        share = min(1.0, max(2 * share, (rows + 6 * rows**0.5) / total))
        bound = min(int(share * 2**64) - 2**63, 2**63 - 1)
        chosen = usable.where(F.col("_hash") <= bound).select("_hash", "doc_id", "x", "y").collect()
    chosen = sorted(chosen, key=lambda row: (row["_hash"], row["doc_id"]))[:rows]
    return fit(np.array([row["x"] for row in chosen]).reshape(-1, len(FEATURES)), np.array([float(row["y"]) for row in chosen]))


def score_documents(described: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score) by vectorised lookups and additions."""
    data = model.to_json()

    def start():
        own = AdditiveModel.from_json(data)

        def work(ids, x):
            return ids, own.score(np.array(x, dtype=float).reshape(-1, len(FEATURES))).tolist()

        return work

    return map_batches(described, [("doc_id", "long"), ("score", "double")], start)


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): features are computed once and stored, then read to fit and to score.

    Null and empty texts get a score like any other; repeated rows give their
    rows; other columns are not read. Without usable labels every score is 0.5.
    """
    described = Stored(document_features(docs), "features", small=True).df
    scored = score_documents(described, train(described, labels, rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores at least `threshold`, all columns; texts are described where they lie, without a join."""
    described = Stored(document_features(docs), "features", small=True)
    data = train(described.df, labels, rows).to_json()
    described.remove()
    own: dict[str, AdditiveModel] = {}

    def score(texts):
        import pandas as pd

        model = own.setdefault(data, AdditiveModel.from_json(data))
        return pd.Series(model.score(np.array([features(text) for text in texts]).reshape(-1, len(FEATURES))))

    scored = F.pandas_udf(score, "double")
    return docs.where(scored("text") >= threshold)
