"""Periodic runs, the manifest and decontamination against brute force, and the queries that SQL can express."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stopflow.llm import common, merkle, oracle, periodic_runs, queries, suffix_shards
from tests.comparison import differences, duck

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, runs int, total string, mark string, spans string"
RANDOM = random.Random(5)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def digest(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "漢字", "x_y", "1a"]
    prose = lambda n: " ".join(RANDOM.choice(vocabulary) for _ in range(n))
    shared = [prose(30) for _ in range(5)]
    texts = [None, "", " \n\t", "a", "a a a a a a", "ab\n" * 40, " ".join(["x y z"] * 9), prose(6000), "A b\x00c"]
    for i in range(150):
        parts = [prose(RANDOM.randint(0, 40))]
        if i % 3 == 0:
            parts.append(shared[i % 5].replace(" ", ", " if i % 2 else "\n").upper() if i % 4 else shared[i % 5])
        if i % 4 == 0:
            parts.append(" ".join([prose(RANDOM.randint(1, 12))] * RANDOM.randint(3, 7)))
        texts.append("\n".join([*parts, prose(RANDOM.randint(0, 9))]))
    sources = [None, "", "a", "é", "hot"]
    out = [(i, sources[min(i % 11, 4)], "en" if i % 7 else None, i if i % 5 else None, t) for i, t in enumerate(texts)]
    return [*out, out[20], out[20], (None, "a", "en", 1, "no id here"), (None, "a", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", "m", "s") for r in rows], SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def benchmark_rows(rows):
    words = rows[7][4].split()
    whole = [(i, " ".join(rows[9 + 3 * i][4].split()[-30:])) for i in range(8)]
    return whole + [(100, "w1 w2"), (101, "W1"), (102, "漢字 x"), (103, None), (104, "  "), (None, "w3 w4"), (105, " ".join(words[50:400])), (105, "w5 w6"), (7, "zz never here")]


@pytest.fixture(scope="module")
def folder_of_rows(spark, docs, benchmark_rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark_rows, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(all(w[start + k] == w[start + k - d] for k in range(d, length)) for d in range(1, q)):
                out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 6)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_of_any_words(blocks):
    words = [b"%d" % x for block, times in blocks for x in block * times]
    want = brute_runs(words)
    assert periodic_runs.squares(words) == want
    (parts,) = periodic_runs.stretches([words])
    assert [(a + s, n, q) for a, b in parts for s, n, q in periodic_runs.squares(words[a:b])] == want


def test_runs_never_cross_texts():
    lists = [[b"a"] * 3, [b"a"] * 5, [], [b"a"] * 6, [b"b", b"a"] * 40]
    assert [len(parts) for parts in periodic_runs.stretches(lists)] == [0, 0, 0, 1, 1]
    assert periodic_runs.stretches([]) == []


def test_periodic_runs_query(spark, rows, folder_of_rows):
    want = []
    for doc_id, _, _, _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and w:
            a, g = h // 10 % len(w), h // 10
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((doc_id, len(runs), *first, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(kept)))
    got = queries.op11_periodic_runs(spark, folder_of_rows)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(r[1] > 0 for r in want) > 30


def test_runs_keep_the_text(docs, spark):
    out = {r["doc_id"]: r for r in periodic_runs.find_runs(docs).collect()}
    assert out[4]["collapsed"] == "a" and out[6]["collapsed"] == "x y z" and [tuple(r) for r in out[6]["runs"]] == [(0, 27, 3)]
    assert out[0]["collapsed"] == out[2]["collapsed"] == "" and out[0]["runs"] == []
    assert periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_proof(levels, i):
    for level in levels[:-1]:
        first = i // 3 * 3
        yield "".join(level[first:i]), "".join(level[i + 1 : first + 3])
        i //= 3


def plain_leaf(row, text):
    values = (row[0], row[1], row[2], row[3], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[4])))
    trees = [plain_tree([plain_leaf(r, r[4]) for r in by_source[s]]) for s in order]
    top = plain_tree([tree[-1][0] for tree in trees])
    for k, s in enumerate(order):
        for i, row in enumerate(by_source[s]):
            proof = [*plain_proof(trees[k], i), *plain_proof(top, k)]
            leaf = now = trees[k][0][i]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = plain_leaf(row, row[4].replace("\n", ""))
            for left, right in proof:
                now = digest(left + now + right)
            spelled = digest("".join(a + b for a, b in proof))
            yield row[0], leaf, trees[k][-1][0], top[-1][0], spelled, now, now == top[-1][0]


@pytest.mark.parametrize("climb", [1, 2, 6])
def test_manifest_query(spark, rows, folder_of_rows, monkeypatch, climb):
    monkeypatch.setattr(merkle, "CLIMB", climb)
    got = sorted(map(repr, map(tuple, queries.op12_merkle_manifest(spark, folder_of_rows).collect())))
    want = list(plain_manifest(rows))
    assert got == sorted(map(repr, want))
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_little(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    (one,) = merkle.manifest(spark.createDataFrame([(1, None, None, None, None, 1, "", "", "")], SCHEMA)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["before"] == one["after"] == []


@given(st.lists(st.integers(0, 3), min_size=1, max_size=90))
@settings(max_examples=200, deadline=None)
def test_suffix_array(words):
    assert suffix_shards.suffix_array(np.array(words)).tolist() == sorted(range(len(words)), key=lambda i: words[i:])


def plain_benchmark(rows, items):
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    windows = defaultdict(set)
    for name, text in items:
        w = cut(text)
        for i in range(max(len(w) - 9, min(len(w), 1))):
            windows[tuple(w[i : i + 10])].add(name)
    for row in rows:
        w = cut(row[4])
        hit, names = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    names |= windows[k]
        listed = sorted(str(n) for n in names if n is not None)
        yield row[0], len(w), len(hit), len(listed), digest(",".join(listed)), bool(hit)


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20, 1 << 12), (700, 40, 15)])
def test_decontamination_query(spark, rows, benchmark_rows, folder_of_rows, monkeypatch, sizes):
    for name, value in zip(("SHARD", "BLOCK", "PIECE"), sizes, strict=True):
        monkeypatch.setattr(suffix_shards, name, value)
    got = queries.op13_decontamination(spark, folder_of_rows)
    want = list(plain_benchmark(rows, benchmark_rows))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert 40 < sum(r[-1] for r in want) < len(want)


def test_shards_are_met_few_at_a_time(spark, monkeypatch):
    """However many shards a task makes, its row groups and the batches of Python workers hold few."""
    bounds, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: bounds.append(spark.conf.get(common.BATCH_BYTES)) or write(self, path))
    monkeypatch.setattr(suffix_shards, "SHARD", 2000)
    monkeypatch.setattr(common, "WIDE_ROWS", {**getattr(common, "WIDE_ROWS", {}), "parquet.block.size": str(1 << 14)})
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.hash("id", i).cast("string")))
    docs = spark.range(300).coalesce(1).select(F.col("id").alias("doc_id"), text.alias("text"))
    shards = suffix_shards.build_shards(docs, "doc_id")
    (file,) = Path(shards.path.removeprefix("file:")).glob("*.parquet")
    kept = pq.ParquetFile(file).metadata
    groups = [kept.row_group(i).num_rows for i in range(kept.num_row_groups)]
    assert sum(groups) > 30 and max(groups) <= 2
    shards.remove()
    items = docs.where("doc_id % 100 = 7").withColumnRenamed("doc_id", "item_id")
    hit = suffix_shards.find_benchmark(docs, items).where(F.size("items") > 0)
    assert sorted(r["doc_id"] for r in hit.collect()) == [7, 107, 207]
    suffix_shards.longest_matches(docs.limit(20), items)
    assert bounds and set(bounds) == {str(common.SMALL_BATCH)}


def test_affected_documents_go(spark, docs, rows, benchmark_rows):
    items = spark.createDataFrame([b for b in benchmark_rows if b[1] and len(b[1].split()) > 9], "item_id long, text string")
    left = suffix_shards.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    want = [r[0] for r in plain_benchmark(rows, [b for b in benchmark_rows if b[1] and len(b[1].split()) > 9]) if not r[-1]]
    assert sorted(map(repr, (r["doc_id"] for r in left.collect()))) == sorted(map(repr, want)) and len(want) < len(rows)
    assert suffix_shards.remove_contaminated(docs, items.limit(0)).count() == len(rows)
    assert suffix_shards.find_benchmark(docs.limit(0), items).count() == 0


def test_longest_matches(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_shards, "SHARD", 2000)
    lists = {r[0]: suffix_shards.words_of((r[4] or "").encode()) for r in rows if r[0] is not None and len(r[4] or "") < 3000}
    test = rows[12][4] + " w7 unseenword w1 w2 w3"
    few = docs.where(F.col("doc_id").isNotNull() & (F.coalesce(F.length("text"), F.lit(0)) < 3000))
    got = {r["suffix"]: r for r in suffix_shards.longest_matches(few, spark.createDataFrame([(1, test)], "item_id long, text string")).collect()}
    words = suffix_shards.words_of(test.encode())
    for s in range(len(words)):
        best = 0
        for w in lists.values():
            for i in range(len(w)):
                k = 0
                while s + k < len(words) and i + k < len(w) and w[i + k] == words[s + k]:
                    k += 1
                best = max(best, k)
        assert (got[s]["length"] if s in got else 0) == best
        if best:
            r = got[s]
            assert lists[r["doc_id"]][r["position"] : r["position"] + best] == words[s : s + best]


@pytest.mark.parametrize("name", list(oracle.QUERIES))
def test_same_as_sql(spark, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), duck(folder), oracle.QUERIES[name]) == []


@pytest.mark.parametrize("name", ["op5_line_dedup", "op12_merkle_manifest", "op13_decontamination"])
def test_sql_agrees_on_odd_rows(spark, folder_of_rows, name):
    """Repeated rows, nulls and blanks; the other tables of the folder are not needed."""
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder_of_rows}/{table}.parquet/*.parquet')")
    assert differences(queries.QUERIES[name](spark, folder_of_rows), con, oracle.QUERIES[name]) == []
