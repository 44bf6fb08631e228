"""Exact n-gram Jaccard join with a token-group matrix.

A document is the set of its distinct word n-grams. Equal sets are one class.
Similar classes are partitioned into groups: classes that share one of a few
minima are verified against the most typical of them, and what links is a group.
Each group stores the union of its members' leading tokens, which makes the
columns of a token-group matrix. A query class's overlap with a group's union
bounds its overlap with every member from above, and only groups that reach
the bound are opened; there members are compared by the same count and the
remaining pairs by their whole sets.

Leading tokens: in an order common to all, with tokens that are frequent in
the corpus last, the first n - ceil(t n) + extra tokens of a set of size n.
Two sets with Jaccard similarity t or more share at least `extra` of them, so
no pair is lost. The order only decides how much work there is.

Pairs inside a group are never listed, as its members are connected already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, connected_components, map_batches

WORDS, PERCENT = 4, 85
#: Leading tokens that linked sets share at least.
EXTRA = 4
#: A token is frequent from so many documents; at most MOST tokens are, as the bound rises with the table.
FREQUENT, MOST = 24, 1_000_000
#: Tokens that a task counts before it sends them on.
COUNTED = 1 << 20
#: Members compared with one leader in one run.
RUN = 256

_K = np.uint64(0x9E3779B97F4A7C15)
_TURNS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5, 0x9FB21C651E98DF25)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of all words as one if there are fewer."""
    found = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space only
    if not found:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(codes.tobytes(), seed=len(found))], dtype=np.uint64)
    size = len(found) - words + 1
    mixed = codes[:size].copy()
    for i in range(1, words):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _K + codes[i : i + size]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _among(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), dtype=bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def leading(tokens: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """The leading tokens of a sorted set; `last` marks the frequent ones."""
    least = needed(len(tokens), percent)
    many = len(tokens) - least + min(EXTRA, least)
    return np.concatenate([tokens[~last], tokens[last]])[:many]


def _signed(tokens: np.ndarray) -> list[int]:
    return tokens.view(np.int64).tolist()


def _summed(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens, ascending, and the sums of their counts."""
    order = np.argsort(tokens)
    tokens, counts = tokens[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)])
    return tokens[first], np.add.reduceat(counts, first) if len(first) else counts


def _dealt(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """(bucket, once, often, counts): tokens by their highest bits, as blocks: those found once in a run of texts, and those found more often."""

    def start():
        bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

        def cut(tokens: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.searchsorted(tokens, bounds), [len(tokens)]])

        def work(texts):
            out = [[] for _ in range(4)]
            held, size = [], 0
            for i, text in enumerate(texts):
                held.append(shingles(text, words))
                size += len(held[-1])
                if size < COUNTED and i + 1 < len(texts):
                    continue
                tokens, counts = np.unique(np.concatenate(held), return_counts=True)
                once, often, counts = tokens[counts == 1], tokens[counts > 1], counts[counts > 1]
                a, b = cut(once), cut(often)
                for bucket in np.flatnonzero((a[1:] > a[:-1]) | (b[1:] > b[:-1])).tolist():
                    mine, more = slice(a[bucket], a[bucket + 1]), slice(b[bucket], b[bucket + 1])
                    row = bucket, once[mine].tobytes(), often[more].tobytes(), counts[more].tobytes()
                    for column, value in zip(out, row):
                        column.append(value)
                held, size = [], 0
            return out

        return work

    return map_batches(docs.select("text"), [("bucket", "int"), ("once", "binary"), ("often", "binary"), ("counts", "binary")], start)


def _token_counts(docs: DataFrame, words: int) -> DataFrame:
    """(token, n) of the tokens of FREQUENT documents or more.

    Hardly any two tokens are equal, so they travel in blocks, a bucket of
    the hash range to a group; buckets grow in number with the table.
    """
    bits = max(10, (16 * docs.rdd.getNumPartitions() - 1).bit_length())

    def total(blocks: pa.Table) -> pa.Table:
        once, often, counts = (np.frombuffer(b"".join(blocks[c].to_pylist()), kind) for c, kind in (("once", np.uint64), ("often", np.uint64), ("counts", np.int64)))
        tokens, n = _summed(np.concatenate([once, often]), np.concatenate([np.ones(len(once), np.int64), counts]))
        many = n >= FREQUENT
        return pa.table({"token": tokens[many].view(np.int64), "n": n[many]})

    return _dealt(docs, words, bits).groupBy("bucket").applyInArrow(total, "token long, n long")


def _frequent_tokens(docs: DataFrame, words: int) -> np.ndarray:
    """Tokens of many documents: at most MOST, since each needs its share of all their occurrences."""
    counts = Stored(_token_counts(docs, words), "token-counts", small=True)
    total = counts.df.agg(F.sum("n")).first()[0] or 0
    rows = counts.df.where(F.col("n") >= max(FREQUENT, total // MOST)).select("token").toLocalIterator()
    out = np.sort(np.fromiter((row["token"] for row in rows), dtype=np.int64).view(np.uint64))
    counts.remove()
    return out


def _index(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, print, typical, rare, minima, tokens) for every row of docs; typical: the thousandths of its tokens that are frequent."""
    sent = docs.sparkSession.sparkContext.broadcast(_frequent_tokens(docs, words))

    def start():
        frequent = sent.value

        def work(ids, texts):
            out = [[] for _ in range(7)]
            for doc, text in zip(ids, texts):
                tokens = shingles(text, words)
                last = _among(tokens, frequent)
                rare = len(tokens) - int(last.sum())
                typical = 1000 - 1000 * rare // max(1, len(tokens))
                minima = [int((tokens * np.uint64(turn)).view(np.int64).min()) for turn in _TURNS] if len(tokens) else []
                row = (doc, len(tokens), hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), typical, rare, minima, _signed(leading(tokens, last, percent)))
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    schema = [("doc_id", "long"), ("n", "long"), ("print", "binary"), ("typical", "int"), ("rare", "int"), ("minima", "array<long>"), ("tokens", "array<long>")]
    return map_batches(docs.select("doc_id", "text"), schema, start)


def _linked(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (leader, member) whose whole sets link.

    A leader's text travels once per run of its members, a member's once per
    pair; hot leaders are cut into runs.
    """
    many = pairs.groupBy("leader").agg(F.ceil(F.count("*") / RUN).cast("int").alias("runs"))
    placed = pairs.join(many, "leader").withColumn("run", F.pmod(F.xxhash64("member"), F.col("runs")).cast("int"))
    roles = placed.select(F.col("member").alias("doc_id"), "leader", "run", F.lit(1).alias("role")).unionByName(
        many.select(F.col("leader").alias("doc_id"), "leader", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("role"))
    )
    rows = docs.select("doc_id", "text").join(roles, "doc_id").select("leader", "run", "role", "doc_id", "text")
    rows = rows.repartition("leader", "run").sortWithinPartitions("leader", "run", "role")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            found = []
            for leader, run, role, doc, text in zip(*[column.to_pylist() for column in batch.columns]):
                tokens = shingles(text, words)
                if role == 0:
                    key, own = (leader, run), tokens
                elif key == (leader, run) and len(own) and len(tokens):
                    at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
                    same = int((own[at] == tokens).sum())
                    if 100 * same >= percent * (len(own) + len(tokens) - same):
                        found.append((leader, doc))
            yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in found], pa.int64()) for i in range(2)], names=["leader", "member"])

    return rows.mapInArrow(verify, "leader long, member long")


def _opened(entries: DataFrame, percent: int, frequent: bool) -> DataFrame:
    """(leader, member): pairs of different groups that reach the bounds, by the groups' token unions, then by member.

    A linking pair shares s (n + k) tokens or more, s being t / (1 + t). Either
    it shares rare leading tokens: then at most the shared ones and what is not
    rare and leading (`room`) on the side whose rare leading list ends earlier
    in the common order. On the other side, leading tokens may be shared that
    do not lead here, so the larger room counts. Or it shares none of these:
    then at most the frequent tokens (`common`) of either side, among them the
    leading ones. Lists of rare tokens are short; the second bound is checked
    inside the joins on frequent ones.
    """
    t = percent / 100
    need = lambda n, k: F.lit(t / (1 + t) - 1e-9) * (F.col(n) + F.col(k))
    matrix = entries.groupBy("token", "g").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("room").alias("wide"), F.max("common").alias("full")
    )
    asked = entries.select("q", "n", "room", "common", F.col("g").alias("own"), "token")
    members = entries.select(F.col("q").alias("m"), F.col("n").alias("k"), F.col("room").alias("m_room"), F.col("common").alias("m_common"), "g", "token")
    fits = lambda n, least, most: (F.col(most) >= F.col(n) * (t - 1e-9)) & (F.col(n) >= F.col(least) * (t - 1e-9))
    # One of a linking pair's two directions suffices: the query is the one in the later group.
    near = (F.col("own") > F.col("g")) & fits("n", "least", "most")
    both = fits("n", "k", "k")
    if frequent:
        near &= (F.col("common") >= need("n", "least")) & (F.col("full") >= need("n", "least"))
        both &= (F.col("common") >= need("n", "k")) & (F.col("m_common") >= need("n", "k"))
        extra = lambda n, k: F.col("c") >= F.least(F.lit(EXTRA), F.ceil(F.col(n) * (t - 1e-9)), F.ceil(F.col(k) * (t - 1e-9)))
        reaches, links = extra("n", "least"), extra("n", "k")
    else:
        reaches = F.col("c") + F.greatest("room", "wide") >= need("n", "least")
        links = F.col("c") + F.greatest("room", "m_room") >= need("n", "k")
    opened = (
        asked.join(matrix, "token").where(near)
        .groupBy("q", "n", "room", "g").agg(F.count("*").alias("c"), F.min("least").alias("least"), F.max("wide").alias("wide"))
        .where(reaches).select("q", "g")
    )
    return (
        asked.join(opened, "q").join(members, ["g", "token"]).where(both)
        .groupBy("q", "m", "n", "k", "room", "m_room").agg(F.count("*").alias("c"))
        .where(links).select(F.col("q").alias("leader"), F.col("m").alias("member"))
    )


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of docs (doc_id, text).

    Null texts and texts without words have empty sets and link with nothing;
    rows with a null id link with nothing and have a null component; rows that
    share an id count as one document. Other columns are not read.
    """
    index = Stored(_index(docs, words, percent), "ngram-index", small=True).df
    classes = Stored(
        index.where("n > 0 and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "ngram-classes"
    ).df
    reps = Stored(index.join(classes.select("print", F.col("rep").alias("doc_id")), ["print", "doc_id"], "left_semi").dropDuplicates(["print"]), "ngram-reps").df
    # A leader has the largest share of tokens that others have too: of the copies of a text, the one nearest to it.
    keys = reps.select("doc_id", "typical", F.posexplode("minima").alias("turn", "key"))
    first_of = F.min(F.struct((-F.col("typical")).alias("t"), "doc_id")).alias("one")
    leaders = keys.groupBy("turn", "key").agg(first_of, F.count("*").alias("c")).where("c > 1").select("turn", "key", F.col("one.doc_id").alias("leader"))
    close = keys.join(leaders, ["turn", "key"]).where("doc_id <> leader").select("leader", F.col("doc_id").alias("member")).distinct()
    first = Stored(_linked(docs, close, words, percent), "ngram-links", small=True).df
    stars = connected_components(first.select(F.col("leader").alias("a"), F.col("member").alias("b")))

    grouped = reps.join(stars.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        F.col("doc_id").alias("q"),
        "n",
        F.coalesce("component", "doc_id").alias("g"),
        (F.col("n") - F.least("rare", F.size("tokens"))).alias("room"),
        (F.col("n") - F.col("rare")).alias("common"),
        F.posexplode("tokens").alias("at", "token"),
        "rare",
    )
    entries = Stored(grouped.withColumn("frequent", F.col("at") >= F.col("rare")).drop("at", "rare"), "ngram-entries").df
    shared = entries.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("token")
    entries = Stored(entries.join(shared, "token", "left_semi"), "ngram-shared").df
    pairs = _opened(entries.where("not frequent"), percent, False).unionByName(_opened(entries.where("frequent"), percent, True)).distinct()
    second = Stored(_linked(docs, Stored(pairs, "ngram-pairs").df, words, percent), "ngram-links", small=True).df
    links = first.unionByName(second).select(F.col("leader").alias("a"), F.col("member").alias("b"))
    components = connected_components(links)
    final = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select("print", F.coalesce("component", "rep").alias("c"))
    has = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return index.select("doc_id", "n", "print").join(final, "print", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(has, F.col("c")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without those that another document of their group stands for; rows with a null id stay."""
    groups = similar_documents(docs, words, percent)
    away = groups.where("doc_id <> component_id").select("doc_id").distinct()
    same = docs.columns
    return docs.join(away, "doc_id", "left_anti").select(*same)
