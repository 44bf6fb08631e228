"""Line deduplication that can be undone: exact reference counts behind sharded cuckoo filters.

The state is a folder of two tables. `counts` holds, for every line key ever
seen, in how many documents it now is: the exact truth. `filters` holds one
cuckoo filter per shard with the keys that are now in at least `least`
documents. Documents are inserted or deleted by adding their keys' counts with
a sign; a key that thereby crosses the threshold enters or leaves its shard's
filter, which other kinds of filter would have to rebuild. A full filter is
built anew from the counts.

A line is first asked of the filters; what they let through is decided by the
exact counts, so that a filter's false positives cost a little work but no line.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, hidden, map_batches

LEAST_DOCUMENTS, LEAST_CHARS = 10, 1
SLOTS = 4
#: Filters of at most this size together are sent to every task; beyond, all lines go to the exact join.
SENT_BYTES = 64 << 20
#: Keys per shard that the number of shards aims at, and the fill above which a filter is built anew.
SHARD_KEYS, FULL = 50_000, 0.85

_MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; the second bucket follows from the first and the fingerprint."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * FULL) * 1.3 + 1))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @property
    def capacity(self) -> int:
        return self.table.size

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        marks = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (keys * _MIX >> np.uint64(20)) & mask
        return marks, first, self._other(first, marks)

    def _other(self, place: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return (place ^ (marks.astype(np.uint64) * _MIX >> np.uint64(24))) & np.uint64(len(self.table) - 1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, first, second = self._places(keys)
        return ((self.table[first] == marks[:, None]) | (self.table[second] == marks[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if a key found no place: the filter must be built anew, larger."""
        table = self.table
        for mark, *places in zip(*self._places(keys)):
            for place in places:
                free = np.flatnonzero(table[place] == 0)
                if len(free):
                    table[place, free[0]] = mark
                    break
            else:
                place = places[1]
                for turn in range(500):
                    slot = turn % SLOTS
                    mark, table[place, slot] = table[place, slot], mark
                    place = self._other(np.array([place]), np.array([mark]))[0]
                    free = np.flatnonzero(table[place] == 0)
                    if len(free):
                        table[place, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Keys must have been inserted."""
        for mark, *places in zip(*self._places(keys)):
            for place in places:
                held = np.flatnonzero(self.table[place] == mark)
                if len(held):
                    self.table[place, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = len(keys)
        while True:
            made = cls.sized(size)
            if made.insert(keys):
                return made
            size *= 2


def line_keys(text: str | None, least_chars: int) -> list[bytes | None]:
    """A 128-bit key for each line, None for those too short to count."""
    out = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip().lower()  # of bytes: the white space and letters of ASCII only
        long_enough = len(key) >= least_chars and (least_chars <= 1 or len(key.decode()) >= least_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long_enough else None)
    return out


def _counted(docs: DataFrame, least_chars: int) -> DataFrame:
    """(key, n): in how many rows of docs each key is."""

    def start():
        def work(texts):
            return ([key for text in texts for key in {*line_keys(text, least_chars)} if key is not None],)

        return work

    return map_batches(docs.select("text"), [("key", "binary")], start).groupBy("key").agg(F.count("*").alias("n"))


def _short(keys) -> np.ndarray:
    """The leading 64 bits of each key."""
    return np.frombuffer(b"".join(key[:8] for key in keys), dtype=">u8").astype(np.uint64)


def _shard_of(keys: list[bytes], shards: int) -> np.ndarray:
    return np.frombuffer(b"".join(key[8:12] for key in keys), dtype=">u4").astype(np.int64) % shards


class LineIndex:
    """Counts and filters at one state; inserting or deleting gives the next one and leaves this one as it is."""

    def __init__(self, counts: Stored, filters: Stored, shards: int, least: int, least_chars: int):
        self.counts, self.filters, self.shards, self.least, self.least_chars = counts, filters, shards, least, least_chars

    @classmethod
    def build(cls, docs: DataFrame, least: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> LineIndex:
        """The state of these documents; null texts count as one empty line, each row as a document."""
        counts = Stored(_counted(docs, least_chars), "line-counts")
        frequent = counts.df.where(F.col("n") >= least)
        shards = max(16, -(-frequent.count() // SHARD_KEYS))
        filters = Stored(cls._built(frequent, shards), "line-filters")
        return cls(counts, filters, shards, least, least_chars)

    @staticmethod
    def _shard(shards: int):
        """From the key's third quarter, as `_shard_of` does."""
        return F.pmod(F.conv(F.hex(F.substring("key", 9, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int").alias("shard")

    @classmethod
    def _built(cls, frequent: DataFrame, shards: int) -> DataFrame:
        def build(rows: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.of(_short(rows["key"]))
            return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "held": [len(rows)], "data": [made.table.tobytes()]})

        return frequent.select("key", cls._shard(shards)).groupBy("shard").applyInPandas(build, "shard int, held long, data binary")

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        least, shards = self.least, self.shards
        delta = _counted(docs, self.least_chars).withColumn("d", F.col("n") * sign).select("key", "d")
        merged = self.counts.df.select("key", "n", F.lit(0).cast("long").alias("d")).unionByName(
            delta.select("key", F.lit(0).cast("long").alias("n"), "d")
        ).groupBy("key").agg(F.sum("n").alias("old"), F.sum(F.col("n") + F.col("d")).alias("n"))
        both = Stored(merged.where("old <> 0 or n <> 0"), "line-changes")
        if both.df.where("n < 0").limit(1).count():
            raise ValueError("documents deleted that were never inserted")
        counts = Stored(both.df.where("n > 0").select("key", "n"), "line-counts")
        moves = both.df.where((F.col("old") >= least) != (F.col("n") >= least)).select(
            "key", self._shard(shards), (F.col("n") >= least).alias("enters")
        )

        def apply(old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            shard = int((change if len(change) else old)["shard"].iloc[0])
            held = int(old["held"].iloc[0]) if len(old) else 0
            enter, leave = change[change["enters"]], change[~change["enters"].astype(bool)]
            if len(old):
                made = CuckooFilter(np.frombuffer(old["data"].iloc[0], dtype=np.uint16).reshape(-1, SLOTS).copy())
            else:
                made = CuckooFilter.sized(len(enter))
            if len(leave):
                made.delete(_short(leave["key"]))
            now = held + len(enter) - len(leave)
            sound = now <= FULL * made.capacity and (not len(enter) or made.insert(_short(enter["key"])))
            return pd.DataFrame({"shard": [shard], "held": [now], "data": [made.table.tobytes() if sound else None]})

        moved = Stored(
            self.filters.df.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(apply, "shard int, held long, data binary"),
            "line-filters",
        )
        full = moved.df.where("data is null").select("shard")
        again = counts.df.where(F.col("n") >= least).select("key", self._shard(shards)).join(full, "shard", "left_semi")
        filters = Stored(moved.df.where("data is not null").unionByName(self._built(again, shards)), "line-filters")
        both.remove()
        moved.remove()
        return LineIndex(counts, filters, shards, least, self.least_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Undoes `insert` of the same documents."""
        return self._changed(docs, -1)

    def _asked(self, docs: DataFrame) -> DataFrame:
        """(digest, line, key): the lines of distinct texts that may be frequent, by the filters if these may be sent."""
        shards, least_chars = self.shards, self.least_chars
        size = self.filters.df.agg(F.sum(F.length("data"))).first()[0] or 0
        sent = None
        if size <= SENT_BYTES:
            sent = docs.sparkSession.sparkContext.broadcast(self.filters.df.select("shard", "data").collect())

        def start():
            filters = None
            if sent is not None:
                filters = {row["shard"]: CuckooFilter(np.frombuffer(row["data"], dtype=np.uint16).reshape(-1, SLOTS)) for row in sent.value}

            def work(texts):
                digests, lines, keys = [], [], []
                for text in texts:
                    digest = text_digest(text)
                    for line, key in enumerate(line_keys(text, least_chars)):
                        if key is not None:
                            digests.append(digest)
                            lines.append(line)
                            keys.append(key)
                if filters is None or not keys:
                    return digests, lines, keys
                asked, of = _short(keys), _shard_of(keys, shards)
                may = np.zeros(len(keys), dtype=bool)
                for shard in np.unique(of):
                    if shard in filters:
                        own = of == shard
                        may[own] = filters[shard].contains(asked[own])
                at = np.flatnonzero(may)
                return [digests[i] for i in at], [lines[i] for i in at], [keys[i] for i in at]

            return work

        return map_batches(docs.select("text"), [("digest", "binary"), ("line", "int"), ("key", "binary")], start)

    def dropped_lines(self, docs: DataFrame) -> DataFrame:
        """(digest, lines array<int>): the frequent lines of each distinct text that has any, exactly."""
        frequent = self.counts.df.where(F.col("n") >= self.least).select("key")
        return self._asked(docs).join(frequent, "key", "left_semi").groupBy("digest").agg(F.collect_set("line").alias("lines"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """Each row of docs with n_lines, n_dropped and `kept`, its text without the frequent lines.

        All columns of docs stay, but those called like one of the three; a null text is one empty line and stays empty.
        """
        worked, own = self._worked(docs)
        outputs = {
            "n_lines": F.size("_all").cast("long"),
            "n_dropped": F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long"),
            "kept": F.col("_kept"),
        }
        return worked.select(*[c for name, c in own.items() if name not in outputs], *[c.alias(name) for name, c in outputs.items()])

    def replaced(self, docs: DataFrame) -> DataFrame:
        """docs, all columns whatever their names, with the frequent lines taken out of `text`."""
        worked, own = self._worked(docs)
        return worked.select(*[F.col("_kept").alias("text") if name == "text" else c for name, c in own.items()])

    def _worked(self, docs: DataFrame) -> tuple[DataFrame, dict]:
        plain, own = hidden(docs, "text")
        keyed = plain.withColumn("_digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
        dropped = self.dropped_lines(docs).select(F.col("digest").alias("_digest"), F.col("lines").alias("_lines"))
        joined = keyed.join(dropped, "_digest", "left").withColumn("_all", F.split(F.coalesce("text", F.lit("")), "\n", -1))
        kept = F.filter("_all", lambda line, i: ~F.array_contains("_lines", i))
        text = F.when(F.col("_lines").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
        return joined.withColumn("_kept", text), own


def text_digest(text: str | None) -> bytes:
    return hashlib.md5((text or "").encode(), usedforsecurity=False).digest()


def drop_frequent_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Index these documents and take out the lines that at least `least` of them have; see LineIndex."""
    return LineIndex.build(docs, least, least_chars).apply(docs)


def without_frequent_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """docs with the lines that at least `least` of them have taken out of their texts; all other columns stay as they are."""
    return LineIndex.build(docs, least, least_chars).replaced(docs)
