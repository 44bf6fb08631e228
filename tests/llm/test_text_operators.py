"""Operators over documents against brute force on small fixtures with every edge case."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopflow.llm import bpe, common, line_dedup, ngram_join, packing, pii, quality, suffix_dedup, token_counts

SCHEMA = "doc_id long, text string, lang string, sequence_id string, n string, key string"
RANDOM = random.Random(11)
WORDS = ["".join(RANDOM.choice("abcdefghi") for _ in range(RANDOM.randint(1, 7))) for _ in range(300)]


def prose(n):
    return " ".join(RANDOM.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared = [prose(120) for _ in range(4)]
    out = [None, "", " ", "\n\n", "a" * 3000, "ab " * 400, "One two", "one TWO", "éß漢字 " * 30, "word " * 6000]
    for i in range(120):
        text = prose(RANDOM.randint(1, 150))
        if i % 3 == 0:
            words = shared[i % 4].split()
            words[RANDOM.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 5 == 0:
            text += "\nLicensed under X.\n" + shared[i % 4][: RANDOM.randint(150, 500)]
        if i % 7 == 0:
            text += f" a{i}@mail.example.com 10.0.0.{i} 4111 1111 1111 1111 +49 30 1234567{i}"
        out.append(text)
    return out + [out[20], out[20]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "lone words here and there", None, None, None, None)], SCHEMA).repartition(5).cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    return {row["doc_id"]: row for row in rows if row["doc_id"] is not None}


def test_bpe_is_the_library(docs, texts, empty):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = by_id(bpe.encode_documents(docs).collect())
    for i, text in enumerate(texts):
        assert np.frombuffer(bytes(rows[i]["ids"]), "<u4").tolist() == own.encode_ordinary(text or "")
    back = by_id(bpe.decode_documents(bpe.encode_documents(docs)).collect())
    assert all(bytes(back[i]["data"]) == (t or "").encode() for i, t in enumerate(texts))
    assert bpe.round_trip(empty).count() == 0 and bpe.round_trip(docs).count() == len(texts) + 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab  \n\tthe1.é'sX", max_size=300))
def test_bpe_reduction(text):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert np.frombuffer(bpe.coder(public_tokenizers.path(bpe.VOCABULARY)).encode_packed(text), "<u4").tolist() == own.encode_ordinary(text)


def test_token_counts_by_plain_dynamic_programming(docs, texts, empty):
    scores = token_counts.load_scores(public_tokenizers.path(bpe.VOCABULARY))

    def best(data):
        value = [(0, 0)]
        for end in range(1, len(data) + 1):
            value.append(max((value[b][0] + scores[data[b:end]], value[b][1] - 1) for b in range(max(0, end - 130), end) if data[b:end] in scores))
        return value[-1]

    rows = by_id(token_counts.count_tokens(docs).collect())
    for i, text in enumerate(texts[:60]):
        words = bpe.pieces(text or "")
        found = [best(w.encode()) for w in words]
        assert tuple(rows[i])[1:] == (len(words), -sum(f[1] for f in found), sum(f[0] for f in found))
    assert token_counts.count_tokens(empty).count() == 0


def test_token_counts_of_a_batch_look_repeated_chunks_up_once():
    trie = token_counts.UnigramTrie(token_counts.load_scores(public_tokenizers.path(bpe.VOCABULARY)))
    white = [chr(c) for c in range(0x3100) if regex.match(r"\s", chr(c))]
    source = random.Random(6)
    odd = ["", " ", "  ", "a ", " a", "'s don't I'LL 12 333 4444", "a\x1c b", "q" * 500 + " z", "é" * 300, *[f"a{w} b" for w in white]]
    odd += ["".join(source.choices("ab é1,.\n\t ’'", k=source.randint(0, 60))) for _ in range(500)]
    batch = pa.array(odd + ["fresh words, " * 400] * 20, pa.large_string())
    looked, places = [], trie._places
    trie._places = lambda parts: looked.extend(parts) or places(parts)
    found = list(zip(*(column.tolist() for column in trie.count_batch(batch))))
    assert looked.count(" words,") < 30
    alone = token_counts.UnigramTrie(token_counts.load_scores(public_tokenizers.path(bpe.VOCABULARY)))
    assert found == [alone.count(text) for text in batch.to_pylist()]
    assert [row[0] for row in found] == [len(bpe.pieces(text)) for text in batch.to_pylist()]


def test_packing_places_every_token_once(docs, texts, empty):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    own.encode_special_tokens = True
    rows = packing.pack_documents(docs).collect()
    pieces = defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
    for i, text in enumerate(texts):
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        cut = [ids[at : at + 2048] for at in range(0, len(ids), 2048)]
        found = sorted(pieces[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in found] == [
            (2048 * k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())) for k, part in enumerate(cut)
        ]
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 2048) + 2
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_packing_plan_is_near_the_bound(seed):
    random_ = np.random.default_rng(seed)
    counts = Counter(np.minimum(2047, random_.lognormal(6, 0.8, 30_000).astype(int) + 1).tolist())
    plan = packing.solve(dict(counts))
    got = Counter()
    for key, many in plan:
        assert sum(key) <= 2048
        for length in key:
            got[length] += many
    assert got == counts
    assert sum(many for _, many in plan) <= 1.002 * sum(k * v for k, v in counts.items()) / 2048 + 1


def lines_by_brute_force(texts, least):
    key = lambda line: line.encode().strip().lower()
    counts = Counter(k for t in texts for k in {key(line) for line in (t or "").split("\n")})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not key(line) or counts[key(line)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(docs, texts, empty, spark):
    all_texts = [*texts, "lone words here and there"]
    rows = by_id(line_dedup.drop_frequent_lines(docs).collect())
    want = lines_by_brute_force(all_texts, 10)
    assert sum(w[1] for w in want) > 0
    assert all((rows[i]["n_lines"], rows[i]["n_dropped"], rows[i]["kept"]) == want[i] for i in range(len(texts)))
    assert line_dedup.drop_frequent_lines(empty).count() == 0


def test_lines_are_reversible(docs, spark):
    base, more = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    index = line_dedup.LineIndex.build(base, 10)
    grown = index.insert(more)
    whole = line_dedup.LineIndex.build(docs.where("doc_id is not null"), 10)
    state = lambda i: sorted((bytes(r["key"]), r["n"]) for r in i.counts.df.collect())
    assert state(grown) == state(whole)
    back = grown.delete(more)
    assert state(back) == state(index)
    dropped = lambda i: sorted((bytes(r["digest"]), sorted(r["lines"])) for r in i.dropped_lines(docs).collect())
    assert dropped(grown) == dropped(whole) and dropped(back) == dropped(index)
    with pytest.raises(ValueError):
        index.delete(docs)


def test_cuckoo_filter_keeps_and_gives_back():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5_000, dtype=np.uint64)
    made = line_dedup.CuckooFilter.of(keys)
    assert made.contains(keys).all()
    made.delete(keys[:2_500])
    assert made.contains(keys[2_500:]).all()
    assert made.contains(keys[:2_500]).mean() < 0.01


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_ngram_join(docs, texts, empty, words, percent):
    sets = []
    for text in texts:
        w = (text or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < words else [tuple(w[k : k + words]) for k in range(len(w) - words + 1)]))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    rows = by_id(ngram_join.similar_documents(docs, words, percent).collect())
    assert all((rows[i]["n_shingles"], rows[i]["component_id"]) == (len(s), root(i)) for i, s in enumerate(sets))
    assert len({root(i) for i in range(len(sets))}) < len(sets) - 2
    assert ngram_join.similar_documents(empty).count() == 0
    assert ngram_join.keep_one(docs, words, percent).count() == len({root(i) for i in range(len(sets))}) + 1


def test_ngram_join_of_frequent_shingles_and_unequal_sizes(spark):
    """Pairs 10% apart in size: most shingles are frequent, and not all rare ones of the larger set lead."""
    source = random.Random(5)
    words = lambda n: [source.choice(WORDS) for _ in range(n)]
    common, filler = words(783), words(500)
    texts = [common + filler + words(1) for _ in range(30)]
    for _ in range(8):
        rare = words(220)
        texts += [common + rare, common + rare[:120]]
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in texts]
    least = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((least[i], least[j]))
                least = [x if c == y else c for c in least]
    assert least[30:] == [i - i % 2 for i in range(30, 46)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    rows = by_id(ngram_join.similar_documents(docs).collect())
    assert [rows[i]["component_id"] for i in range(len(sets))] == least


def test_ngram_token_counts_travel_in_blocks(spark):
    source = random.Random(8)
    texts = [None, "", "one two", *[" ".join(source.choices(WORDS[:40], k=source.randint(1, 400))) for _ in range(400)]]
    texts += ["all of these words are in many texts " + str(i % 3) for i in range(90)]
    expected = Counter(int(token) for text in texts for token in ngram_join.shingles(text, 2).view(np.int64))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = ngram_join._token_counts(docs, 2).collect()
    assert {r["token"]: r["n"] for r in rows} == {t: n for t, n in expected.items() if n >= ngram_join.FREQUENT}
    assert len(rows) == len({r["token"] for r in rows}) > 100
    sent = ngram_join._dealt(docs, 2, 4)
    assert sent.count() <= 3 * 2**4 < len(expected)
    assert ngram_join._token_counts(docs.limit(0), 2).count() == 0


def test_python_workers_are_handed_small_batches(spark, monkeypatch):
    """In the n-gram join and the classifier, however many rows of a partition would go into a batch."""
    before, bound = spark.conf.get(common.BATCH_BYTES), common.SMALL_BATCH + 100_000
    rows = [(i, f"{i} {'x' * 3_000}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def checked(df, schema, start):
        def begin():
            work = start()

            def run(*columns):
                held = sum(len(value) for value in columns[-1])
                if held > bound:
                    raise ValueError(f"a batch of {held} characters")
                return work(*columns)

            return run

        return common.map_batches(df, schema, begin)

    monkeypatch.setattr(ngram_join, "map_batches", checked)
    monkeypatch.setattr(quality, "map_batches", checked)
    try:
        assert ngram_join.similar_documents(docs).count() == len(rows)
        quality.keep_good(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
        assert spark.conf.get(common.BATCH_BYTES) == before
        for given, then in (("1m", "1m"), ("2147483647", str(common.SMALL_BATCH)), ("5mb", str(common.SMALL_BATCH))):
            spark.conf.set(common.BATCH_BYTES, given)
            assert common.small_batches(spark) == given
            assert spark.conf.get(common.BATCH_BYTES) == then
    finally:
        spark.conf.set(common.BATCH_BYTES, before)


def test_python_workers_of_passages_are_handed_small_batches(spark, monkeypatch):
    """In every step of the passage removal, whose session keeps its bound; batches of no rows are no fault."""
    before, bound = spark.conf.get(common.BATCH_BYTES), common.SMALL_BATCH + 100_000
    random = np.random.default_rng(3)
    letters = lambda n: random.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    shared = [letters(250) for _ in range(2_000)]
    rows = [(i, letters(2_750) + shared[i // 2]) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def checked(df, schema, start):
        width = len(df.columns)

        def begin():
            work = start()
            work(*[[]] * width)

            def run(*columns):
                held = sum(len(value) for column in columns for value in column if isinstance(value, str))
                if held > bound:
                    raise ValueError(f"a batch of {held} characters")
                return work(*columns)

            return run

        return common.map_batches(df, schema, begin)

    monkeypatch.setattr(suffix_dedup, "map_batches", checked)
    found = suffix_dedup.remove_repeated(docs, keep_bytes=False)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(r["n_removed"] >= 250 for r in found.collect()) == {True: len(rows)}
    assert spark.conf.get(common.BATCH_BYTES) == before


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_brute_force(text):
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = []
    for at, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            passes = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if passes:
                out.append((m.start(), at, m.end(), kind))
    return sorted(out)


def test_pii(spark, docs, texts, empty):
    pieces = ["1", "22", "4" * 9, ".", "-", " ", "+", "@", "a", "a_b", "mail.com", " (", "é", "\n", "4111 1111 1111 1111", "192.168.1.1", "+49 30 1234567", "\x01"]
    odd = ["".join(RANDOM.choice(pieces) for _ in range(RANDOM.randint(1, 25))) for _ in range(800)]
    odd += ["1 " * 20_000, "a." * 9_000 + "@" + "b." * 9_000, "1" * 30_000, "+1" + "2" * 20_000, None, ""]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    found = by_id(pii.with_candidates(df).collect())
    assert all([tuple(s) for s in found[i]["_base"]] == spans_by_brute_force(t or "") for i, t in enumerate(odd))
    rows = by_id(pii.find(docs).collect())
    for i, text in enumerate(texts):
        assert {tuple(s) for s in rows[i]["_base"]} <= {tuple(s) for s in rows[i]["_spans"]}
    plan = pii.with_candidates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowConverters", "")
    done = by_id(pii.redact(docs).collect())
    assert all("@mail" not in (row["text"] or "") for row in done.values())
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def test_planted_mails_and_phones_without_base_format_are_added(spark):
    texts, planted = [], {}
    for i in range(400):
        texts += [f"please call +49 30 {1234567 + i} today", f"mail bob{i}@host.com please", f"order 4111 2222 3333 {4000 + i} sent", f"sold 20 1{i:03} {100000 + i} pieces", f"about {1000000 + i} rows"]
    for i in range(40):
        for kind, span, text in (("email", f"jane{i} (at) host (dot) com", "contact {} now"), ("email", f"joe{i} at host dot org", "mail {} now"), ("phone", f"030 {1234567 + i}", "call {} now")):
            start = text.index("{")
            planted[len(texts)] = (start, start + len(span), kind)
            texts.append(text.format(span))
    rows = by_id(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    for i in range(len(texts)):
        added = {(s["start"], s["end"], s["kind"]) for s in rows[i]["_spans"]} - {(s["start"], s["end"], s["kind"]) for s in rows[i]["_base"]}
        assert added == ({planted[i]} if i in planted else set()), texts[i]


def test_boosted_candidates_learn_format():
    cells = [
        {**dict.fromkeys(pii.SIZES, 0), "digits": d, "context": c, "aside": a, "n": 50, "covered": 50 * (d == 3 and c == 1)}
        for d in range(8) for c in range(5) for a in (0, 1)
    ]
    model = pii.fit(cells)
    chosen = {(c["digits"], c["context"]) for c in cells if model.margin(c) >= model.threshold}
    assert chosen == {(3, 1)}


def passages_by_brute_force(texts):
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + 200] for t in data for i in range(len(t) - 199))
    out = []
    for t in data:
        marks = bytearray(len(t))
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                marks[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, m in zip(t, marks) if not m)
        runs = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        out.append((len(t), sum(marks), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("largest", [suffix_dedup.GROUP, 3])
def test_passages(docs, texts, empty, largest):
    rows = by_id(suffix_dedup.remove_repeated(docs, False, largest).collect())
    want = passages_by_brute_force([*texts, "lone words here and there"])
    assert sum(w[1] for w in want) > 1000
    assert all(tuple(rows[i])[1:] == want[i] for i in range(len(texts)))
    assert suffix_dedup.remove_repeated(empty).count() == 0


def test_quality(spark, folder):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = by_id(quality.classify(docs, labels).collect())
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert len(right) > 40 and sum(right) / len(right) >= 0.95
    assert all(row["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, row in rows.items())


def test_quality_without_labels(docs, texts, empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(texts) + 1 and {row["score"] for row in rows} == {0.5}
    assert quality.classify(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0
    assert quality.keep_good(docs, labels, threshold=0.4).count() == len(texts) + 1


def test_additive_model_needs_pairs():
    random_ = np.random.default_rng(3)
    x = random_.random((4_000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3_000], y[:3_000])
    again = quality.AdditiveModel.from_json(model.to_json())
    assert ((again.score(x[3_000:]) > 0.5) == (y[3_000:] > 0.5)).mean() > 0.9


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, 1))} if found else set()


def smallest_of_groups(docs):
    """Ids that stay: the smallest of each group linked by five-word shingles at 0.8; an id's rows go together."""
    sets = [(d, shingles(t)) for d, t in docs]
    group = {d: d for d, _ in docs}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {d for d in group if top(d) == d}


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    """Real documents with nulls, blanks, repeated rows, planted lines and data, and columns that operators use themselves."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 160 AND n_chars < 6000")
    planted = F.concat("text", F.lit("\nall rights reserved here\nmail me at some.one@mail.example.com or +49 30 1234567890 "), F.col("doc_id").cast("string"))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, planted).otherwise(F.col("text")))
    extra = spark.createDataFrame([(900, None), (901, ""), (902, " \n \n"), (903, "one lone word +1 (555) 010-9999 x")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True).unionByName(docs.where("doc_id = 18"))
    for name in ("n_lines", "n_dropped", "kept", "_lines", "_base", "_digest", "_spans", "length"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_every_stage_against_plain_python(spark, odd_folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    labels = spark.read.parquet(f"{odd_folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def run(name, docs):
        after = stages[name](spark, docs, odd_folder)
        assert after.columns == columns and after.dtypes == docs.dtypes
        out = after.cache()
        for c in ("n_lines", "n_dropped", "kept", "_lines", "_base", "_digest", "_spans", "length"):
            assert out.where(F.col(c) != f"own {c}").count() == 0
        return out

    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    key = lambda pair: (pair[0], pair[1] or "")
    good = run("quality classifier", docs)
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, labels).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = sorted((p for p in rows if scores[p[0]]), key=key)
    assert sorted(((r["doc_id"], r["text"]) for r in good.collect()), key=key) == kept and 50 < len(kept) <= len(rows)

    # The stages after it are looked at with all rows, so that odd ones reach them.
    lined = run("line dedup", docs)
    want = [(d, w[2]) for (d, _), w in zip(rows, lines_by_brute_force([t for _, t in rows], 10), strict=True)]
    assert pairs(lined) == sorted(want) and want != [(d, t or "") for d, t in rows]
    assert lined.where(F.col("n_chars") != F.length("text")).count() == 0

    single = run("n-gram Jaccard join", lined)
    stay = smallest_of_groups(want)
    assert {r["doc_id"] for r in single.collect()} == stay and len(stay) < len({d for d, _ in want})

    clean = run("PII", single)
    texts_before = {r["doc_id"]: r["text"] for r in single.collect()}
    spans = {r["doc_id"]: r["spans"] for r in pii.find(single).select("doc_id", pii.spelled("_spans").alias("spans")).collect()}
    for d, text in pairs(clean):
        out, at = "", 0
        for span in filter(None, spans[d].split(",")):
            kind, start, end = span.split(":")
            if int(start) >= at:
                out += texts_before[d][at : int(start)] + f"[{kind.upper()}]"
            at = max(at, int(end))
        assert text == out + texts_before[d][at:]
    assert any("[EMAIL]" in t for _, t in pairs(clean)) and not any("some.one@mail" in t for _, t in pairs(clean))

    tokenizer = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    packed = stages["best-fit packing"](spark, clean, odd_folder).collect()
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    tokens = defaultdict(int)
    for d, t in pairs(clean):
        tokens[d] += len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    assert total == tokens
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048


def test_pipeline_of_nothing(spark, odd_folder, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels"):
        spark.read.parquet(f"{odd_folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_training_rows_are_those_of_least_hash(spark, monkeypatch):
    ids = spark.range(3000).select(F.col("id").alias("doc_id"), F.array(F.col("id").cast("double")).alias("x"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    seen = []
    monkeypatch.setattr(quality, "FEATURES", ["one"])
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(x[:, 0].astype(int).tolist()))
    quality.train(ids, labels, rows=50)
    usable = ids.where(~quality.held_out()).orderBy(F.xxhash64("doc_id")).limit(50)
    assert seen[0] == [r["doc_id"] for r in usable.collect()]
