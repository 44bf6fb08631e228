"""Operators over embeddings against brute force."""

import time

import numpy as np
import pytest

from stopflow.llm import cap_filters, topk
from stopflow.llm.common import connected_components

SCHEMA = "vec_id long, embedding array<float>, label int, q string, v string"


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(5)
    centres = random.standard_normal((40, 16))
    rows = [c + 0.25 * random.standard_normal(16) for c in centres for _ in range(12)]
    out = [(i, np.float32(r).tolist()) for i, r in enumerate(rows)]
    out += [(1000 + i, out[i * 3][1]) for i in range(20)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf"), *[1.0] * 15], [None, *[1.0] * 15], [1.0, 2.0]]
    return out + [(2000 + i, b) for i, b in enumerate(bad)]


@pytest.fixture(scope="module")
def table(spark, vectors):
    return spark.createDataFrame([(i, e, 1, "a", "b") for i, e in vectors], SCHEMA).repartition(4)


def test_links(spark, table, vectors):
    sound = [(i, np.array(e, dtype=float)) for i, e in vectors if i < 2000]
    ids = np.array([i for i, _ in sound])
    unit = np.array([e / np.linalg.norm(e) for _, e in sound])
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    rows = {r["vec_id"]: r for r in cap_filters.link_vectors(table).collect()}
    assert len(rows) == len(vectors)
    got = np.array([rows[i]["n_links"] for i in ids])
    assert (got <= linked.sum(1)).all() and got.sum() >= 0.9 * linked.sum() > 1000
    label = ids.copy()
    for _ in range(50):
        label = np.minimum(label, np.where(linked, label[None, :], 1 << 40).min(1))
    same = np.array([rows[i]["component_id"] for i in ids]) == label
    assert same.mean() > 0.9
    for i, _ in vectors[len(sound) :]:
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (0, i, True)
    assert cap_filters.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_in_blocks(table, monkeypatch):
    whole = sorted(map(tuple, cap_filters.link_vectors(table).collect()))
    monkeypatch.setattr(cap_filters, "BLOCK", 3)
    assert sorted(map(tuple, cap_filters.link_vectors(table).collect())) == whole


def test_topk(spark, table, vectors, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 100)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = topk.scaled(table)
    got = {}
    for r in sorted(topk.exact_topk(rows, rows.where("vec_id % 100 = 0")).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    whole = {i: np.floor(1024 * np.array(e, dtype=float)) for i, e in vectors if e and len(e) == 16 and None not in e and np.isfinite(e).all()}
    for query in [i for i in whole if i % 100 == 0]:
        scores = sorted((-int(whole[query] @ v), i) for i, v in whole.items() if i != query)[:10]
        assert got[query] == [(i, -s) for s, i in scores]
    assert topk.exact_topk(rows.limit(0), rows).count() == 0


@pytest.mark.parametrize("together", [1, 3, 64])
def test_topk_of_a_block_with_ties_zeros_and_repeated_ids(monkeypatch, together):
    monkeypatch.setattr(topk, "TOGETHER", together)
    random = np.random.default_rng(1)
    for _ in range(100):
        n, d, asked, k = random.integers(1, [60, 5, 9, 12])
        ids, query_ids = random.integers(0, 70, n), random.integers(0, 70, asked)
        rows, queries = random.integers(-3, 4, (n, d)).astype(float), random.integers(-2, 3, (asked, d)).astype(float)
        want = []
        for own, q in zip(query_ids, queries):
            found = sorted((-int(r @ q), int(i)) for r, i in zip(rows, ids) if i != own)[:k]
            want += [(int(own), i, -s) for s, i in found]
        assert topk._block_topk(ids, rows, query_ids, queries, int(k)) == want


def test_topk_of_a_block_costs_about_a_sort_of_its_scores():
    """Lists of 64 unrelated dimensions end no walk early: all rows are met, which must not cost far more than ordering them."""
    random = np.random.default_rng(2)
    rows = np.floor(128 * random.standard_normal((8192, 64)))
    ids, queries = np.arange(len(rows)), rows[:128]
    walks, sorts = [], []
    for _ in range(3):
        began = time.thread_time()
        found = topk._block_topk(ids, rows, ids[:128], queries, 10)
        walks.append(time.thread_time() - began)
        began = time.thread_time()
        want = []
        for own, q in enumerate(queries):
            scores = rows @ q
            order = [i for i in np.lexsort((ids, -scores))[:11] if i != own][:10]
            want += [(own, int(i), int(scores[i])) for i in order]
        sorts.append(time.thread_time() - began)
        assert found == want
    assert min(walks) < 5 * min(sorts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 200), (200, 250)]
    rows = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(rows[i] == 0 for i in range(51)) and all(rows[100 + i] == 100 for i in range(40)) and rows[300] == rows[250] == 200
