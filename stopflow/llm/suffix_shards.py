"""Benchmark decontamination with training suffix arrays.

Documents are cut into words and gathered, as they are read, into shards of about
SHARD words. A shard stores the order of all its suffixes, sorted by ranks of
three words, nine words and so on until no two are alike. Every suffix of every
benchmark text is then looked up by binary search in every shard: where it would
stand gives its longest verbatim match and one location; the range of suffixes
that begin with its first WINDOW words gives all locations of that window.

Benchmark texts meet the shards in blocks of about BLOCK words, one broadcast
each, so what a task holds does not grow with the benchmark; texts are dealt
to blocks in pieces that share WINDOW - 1 words. Likewise a document longer than
a shard is stored in pieces that share WINDOW - 1 words (a longest match is told
within a piece). What is found are stretches of word numbers, united per document.

Shards are read, written and handed on one or two at a time (a row group, an Arrow
batch), so a task's memory does not grow with the rows that its part of the input holds.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z have become a-z. A window is
WINDOW words in a row of one benchmark text, or the whole of a shorter one. Null
or wordless texts have no windows and no words. Documents that are alike in all
columns each get a row; benchmark rows with equal ids count as one item; a null
id is not listed, but its windows count. Other columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, map_batches

WINDOW = 10
#: Words of a shard, at most 2 ** 21 - 2 with the breaks between documents, and of a block of benchmark texts.
SHARD, BLOCK = 1 << 19, 1 << 20
PIECE = 1 << 12

#: Bytes of words stay, with A-Z as a-z; all others are blanks.
LETTERS = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32 for b in range(256))
#: Between two documents in a shard; real words are numbered from 1. A benchmark's break or word unknown to the shard equals nothing.
BREAK, NEVER = 0, -1

LONGS, LONG, BYTES = pa.list_(pa.int64()), pa.int64(), pa.binary()
#: A shard: its pieces of documents (number, key and mark of the document, place in the shard and in the document, words of its own), words and order.
SHARDS = {
    **dict.fromkeys(["docs", "names", "marks", "starts", "offsets", "counts"], ("array<long>", LONGS)),
    **dict.fromkeys(["vocabulary", "words", "suffixes"], ("binary", BYTES)),
}
FOUND = {
    **dict.fromkeys(["doc", "name", "mark", "n_words"], ("long", LONG)),
    "spans": ("array<long>", LONGS),
    "items": ("array<string>", pa.list_(pa.string())),
}


def _ddl(fields: dict) -> str:
    return ", ".join(f"{name} {kind}" for name, (kind, _) in fields.items())


def _batch(fields: dict, columns: Iterable) -> pa.RecordBatch:
    arrays = [pa.array(values, type=kind) for values, (_, kind) in zip(columns, fields.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; words are numbers from 0 to 2 ** 21 - 2, fewer than 2 ** 21 - 1 of them."""
    n = len(words)
    rank = words.astype(np.int64) + 1  # 0 is the end
    slots = np.arange(n)
    order = np.arange(n)
    step = 1
    while len(slots):
        at = order[slots]
        key = rank[at]
        for k in (1, 2):
            later = at + k * step
            key = (key << 21) | np.where(later < n, rank[np.minimum(later, n - 1)], 0)
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[slots] = at
        first = np.concatenate(([True], key[1:] != key[:-1]))
        # A rank is the slot of the first suffix that is still alike, plus 1.
        group = np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
        rank[at] = slots[group] + 1
        alone = first & np.concatenate((first[1:], [True]))
        slots = slots[~alone]
        step *= 3
    return order


def _shared(a: np.ndarray, at: np.ndarray, b: np.ndarray, of: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Numbers of equal words of a from `at` and b from `of`, up to `most` each."""
    length = np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    while len(live):
        x, y = at[live] + length[live], of[live] + length[live]
        inside = (length[live] < most[live]) & (x < len(a)) & (y < len(b))
        live, x, y = live[inside], x[inside], y[inside]
        live = live[a[x] == b[y]]
        length[live] += 1
    return length


def _bound(words: np.ndarray, order: np.ndarray, tests: np.ndarray, of: np.ndarray, most: np.ndarray, after: bool) -> np.ndarray:
    """For each test suffix, cut to `most` words, the number of shard suffixes before it (`after`: or beginning with it)."""
    low, high = np.zeros(len(of), dtype=np.int64), np.full(len(of), len(order), dtype=np.int64)
    live = np.arange(len(of))
    while len(live := live[low[live] < high[live]]):
        middle = (low[live] + high[live]) // 2
        at = order[middle]
        same = _shared(words, at, tests, of[live], most[live])
        x, y = at + same, of[live] + same
        whole = same == most[live]
        ended = x >= len(words)
        less = ended | (words[np.minimum(x, len(words) - 1)] < tests[np.minimum(y, len(tests) - 1)])
        less = np.where(whole, after, less)
        low[live] = np.where(less, middle + 1, low[live])
        high[live] = np.where(less, high[live], middle)
    return low


class Tests:
    """A block of benchmark texts: all its suffixes, the length of its windows, its items."""

    def __init__(self, rows: list[tuple[str | None, bool, bytes]]):
        self.names = [name for name, _, _ in rows]
        lists = [text.split() for _, _, text in rows]
        sizes = np.array([len(words) for words in lists], dtype=np.int64)
        self.words = [word for words in lists for word in (*words, None)]
        starts = np.cumsum(sizes + 1) - sizes - 1
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.at = np.arange(sizes.sum()) + self.row  # one break after each text
        self.left = sizes[self.row] - (self.at - starts[self.row])
        whole = np.array([whole for _, whole, _ in rows], dtype=bool)[self.row] & (self.at == starts[self.row])
        self.window = np.where(self.left >= WINDOW, WINDOW, np.where(whole, self.left, 0))

    def in_numbers(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        return np.array([vocabulary.get(word, NEVER) for word in self.words], dtype=np.int64)

    def longest(self, words: np.ndarray, order: np.ndarray, tests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each suffix the longest match in the shard and where it begins."""
        place = _bound(words, order, tests, self.at, self.left, after=False)
        length, where = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        for neighbour in (place - 1, place):
            there = np.flatnonzero((neighbour >= 0) & (neighbour < len(order)))
            at = order[neighbour[there]]
            shared = _shared(words, at, tests, self.at[there], self.left[there])
            better = shared > length[there]
            length[there[better]], where[there[better]] = shared[better], at[better]
        return length, where

    def windows(self, words: np.ndarray, order: np.ndarray, tests: np.ndarray) -> Iterator[tuple[np.ndarray, int, list[int]]]:
        """(places in the shard, words, rows of texts) of every window that occurs; equal windows come once."""
        length, _ = self.longest(words, order, tests)
        found = np.flatnonzero((self.window > 0) & (length >= self.window))
        of, most = self.at[found], self.window[found]
        low = _bound(words, order, tests, of, most, after=False)
        high = _bound(words, order, tests, of, most, after=True)
        rows = defaultdict(set)
        for key, row in zip(zip(low.tolist(), high.tolist(), most.tolist(), strict=True), self.row[found].tolist(), strict=True):
            rows[key].add(row)
        for (first, end, size), texts in rows.items():
            yield order[first:end], size, sorted(texts)


class _Shard:
    """Documents in the making of a shard."""

    def __init__(self):
        self.vocabulary = defaultdict(count(1).__next__)
        self.pieces, self.parts, self.size = [], [], 0

    def add(self, document: tuple, words: list[bytes], offset: int, owned: int) -> None:
        numbers = np.fromiter(map(self.vocabulary.__getitem__, words), dtype=np.int32, count=len(words))
        self.pieces.append((*document, self.size, offset, owned))
        self.parts += [numbers, np.array([BREAK], dtype=np.int32)]
        self.size += len(words) + 1

    def batch(self) -> pa.RecordBatch:
        words = np.concatenate(self.parts)
        order = suffix_array(words).astype(np.int32)
        values = *map(list, zip(*self.pieces, strict=True)), b" ".join(self.vocabulary), words.tobytes(), order.tobytes()
        return _batch(SHARDS, [[v] for v in values])


def build_shards(docs: DataFrame, key: str) -> Stored:
    """Suffix arrays over the texts of docs; its rows are numbered, and told by the long column `key` and a hash of the text."""
    size = SHARD

    def run(batches):
        shard = _Shard()
        for batch in batches:
            documents = zip(*[column.to_pylist() for column in batch.columns[:3]], strict=True)
            for document, text in zip(documents, batch.column(3), strict=True):
                words = words_of(text.as_py())
                for offset in range(0, max(len(words), 1), size):
                    part = words[offset : offset + size + WINDOW - 1]
                    if shard.size and shard.size + len(part) > size:
                        yield shard.batch()
                        shard = _Shard()
                    shard.add(document, part, offset, min(len(words) - offset, size))
        if shard.size:
            yield shard.batch()

    number = F.monotonically_increasing_id()  # stored with the shards, so it stays
    rows = docs.select(number.alias("doc"), F.col(key).cast("long"), F.xxhash64("text"), F.col("text").cast("binary"))
    return Stored(rows.toDF("doc", "name", "mark", "text").mapInArrow(run, _ddl(SHARDS)), "shards", small=True, wide=True)


def _test_blocks(benchmark: DataFrame, key: str) -> Iterator[Tests]:
    """The benchmark's texts in pieces, a bounded block at a time."""

    size = PIECE

    def start():
        def work(names, texts):
            out = []
            for name, text in zip(names, texts, strict=True):
                words = words_of(text)
                for at in range(0, max(len(words) - WINDOW + 1, min(len(words), 1)), size):
                    part = words[at : at + size + WINDOW - 1]
                    out.append((name, len(words) < WINDOW, len(part), b" ".join(part)))
            return [list(column) for column in zip(*out, strict=True)] or [[], [], [], []]

        return work

    texts = benchmark.select(F.col(key).cast("string"), F.col("text").cast("binary"))
    pieces = Stored(map_batches(texts, [("name", "string"), ("whole", "boolean"), ("size", "long"), ("part", "binary")], start), "tests", small=True)
    words = pieces.df.agg(F.sum("size")).first()[0] or 0
    blocks = -(-words // BLOCK)
    block = F.pmod(F.xxhash64("name", "part"), F.lit(max(blocks, 1)))
    for number in range(blocks):
        yield Tests([(r["name"], r["whole"], bytes(r["part"])) for r in pieces.df.where(block == number).orderBy("name", "part").collect()])
    pieces.remove()


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Shards one by one: pieces (an array of columns), numbers of words, words, order."""
    for batch in batches:
        for i in range(batch.num_rows):
            *pieces, vocabulary, words, order = (column[i].as_py() for column in batch.columns)
            numbers = {word: k for k, word in enumerate(vocabulary.split(), 1)}
            words, order = (np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in (words, order))
            yield pieces, numbers, words, order


def _united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches covered by the given ones."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def _search(shards: DataFrame, tests: Tests, counting: bool) -> DataFrame:
    """Per piece of a document with hits (`counting`: per piece) its spans and items."""
    sent = shards.sparkSession.sparkContext.broadcast(tests)

    def run(batches):
        block = sent.value
        for (docs, names, marks, starts, offsets, counts), numbers, words, order in _opened(batches):
            at, ends, texts = [], [], defaultdict(set)
            for places, size, rows in block.windows(words, order, block.in_numbers(numbers)):
                at.append(places)
                ends.append(places + size)
                items = {block.names[row] for row in rows} - {None}
                for piece in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                    texts[piece] |= items
            spans = defaultdict(list)
            if at:
                first, final = _united(np.concatenate(at), np.concatenate(ends))
                piece = np.searchsorted(starts, first, "right") - 1
                shift = np.array(offsets)[piece] - np.array(starts)[piece]
                for p, a, b in zip(piece.tolist(), (first + shift).tolist(), (final + shift).tolist(), strict=True):
                    spans[p] += [a, b]
            told = range(len(docs)) if counting else sorted(spans)
            rows = [(docs[p], names[p], marks[p], counts[p] if counting else 0, spans.get(p, []), sorted(texts.get(p, ()))) for p in told]
            if rows:
                yield _batch(FOUND, zip(*rows, strict=True))

    return shards.mapInArrow(run, _ddl(FOUND))


def hit_words(spans: Column) -> Column:
    """Words covered by an array of (start, end) in order of start, which may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    added = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(s["end"], acc["end"]).alias("end"),
    )
    return F.aggregate(spans, zero, added, lambda acc: acc["n"])


def find_benchmark(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Per document: its key, n_words, spans (array of start and end, word numbers, end exclusive, in order) and items (sorted ids as text).

    `mark`, a hash of the text, tells documents of one key apart.
    """
    shards = build_shards(docs, key)
    found = None
    for tests in _test_blocks(benchmark, item):
        part = _search(shards.df, tests, counting=found is None)
        found = found.unionByName(part) if found else part
    if found is None:
        found = _search(shards.df, Tests([]), counting=True)
    ends = F.filter("spans", lambda _, i: i % 2 == 1)
    pairs = F.transform(F.filter("spans", lambda _, i: i % 2 == 0), lambda start, i: F.struct(start.alias("start"), F.get(ends, i).alias("end")))
    whole = found.withColumn("spans", pairs).groupBy("doc").agg(
        F.max("name").alias(key),
        F.max("mark").alias("mark"),
        F.sum("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    out = Stored(whole.drop("doc"), "found", small=True)
    shards.remove()
    return out.df


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Per benchmark row's id and suffix (its first word's number in its piece of the text) the longest verbatim match in any document, with one
    document and word number where it is; suffixes whose first word no document has are left out."""
    shards = build_shards(docs, key)
    fields = {"item": ("string", pa.string()), **dict.fromkeys(["suffix", "length", "doc_id", "position"], ("long", LONG))}

    def searching(sent):
        def run(batches):
            block = sent.value
            first = block.at[np.searchsorted(block.row, block.row)]
            for (_, names, _, starts, offsets, _), numbers, words, order in _opened(batches):
                length, where = block.longest(words, order, block.in_numbers(numbers))
                rows = []
                for s in np.flatnonzero(length).tolist():
                    piece = int(np.searchsorted(starts, where[s], "right")) - 1
                    place = int(where[s]) - starts[piece] + offsets[piece]
                    rows.append((block.names[block.row[s]], int(block.at[s] - first[s]), int(length[s]), names[piece], place))
                if rows:
                    yield _batch(fields, zip(*rows, strict=True))

        return run

    parts = [shards.df.mapInArrow(searching(docs.sparkSession.sparkContext.broadcast(tests)), _ddl(fields)) for tests in _test_blocks(benchmark, item)]
    if not parts:
        parts = [docs.sparkSession.createDataFrame([], _ddl(fields))]
    best = F.max_by(F.struct("length", "doc_id", "position"), F.struct("length", -F.col("doc_id"), -F.col("position"))).alias("best")
    out = Stored(reduce(DataFrame.unionByName, parts).groupBy("item", "suffix").agg(best).select("item", "suffix", "best.*"), "longest", small=True)
    shards.remove()
    return out.df


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """docs without those that hold a window of the benchmark."""
    hit = find_benchmark(docs, benchmark, key, item).where(F.size("spans") > 0).select(key, "mark").distinct()
    same = F.col(f"d.{key}").eqNullSafe(F.col(f"h.{key}")) & (F.xxhash64("d.text") == F.col("h.mark"))
    return docs.alias("d").join(hit.alias("h"), same, "left_anti")
