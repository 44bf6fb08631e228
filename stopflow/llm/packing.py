"""Packing documents into fixed-length sequences by a configuration linear program.

A configuration says how many pieces of each length one sequence holds. The
program asks for the least total number of sequences such that every length is
covered as often as the histogram has it. It has one variable for each of the
countless configurations, so it is solved by multiplicative weights: each
length carries a weight that falls as the length gets covered, a knapsack
dynamic program prices the best configuration under these weights, and the
configuration's variable is raised. The variables are then rounded down, and
what is left of the histogram is packed one configuration at a time by the
bounded knapsack under the program's prices.

Only the histogram, at most `capacity` counts, and the configurations, at most
a few thousand, are ever on the driver. Pieces are numbered within their
length by counts per bucket and take their slots by a join.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, map_batches

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END = 2048, 0
REMEMBERED, LONGEST = 1_000_000, 64
#: Texts encoded at once: few enough that their words stay in a core's cache between the steps.
TOGETHER = 32
#: Lower-case words of printable ASCII and western letters, and the tokenizer's pre-tokens within them.
PLAIN = re.compile("[!-@\\[-~\u00df-\u00f6\u00f8-\u00ff]{1,64}")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: The one letter whose lower case depends on its place in Python, unlike in the tokenizer.
SIGMA = "\u03a3"


class WordIds:
    """Ids by white-space separated words, which the tokenizer never joins; words seen before are remembered.

    Words that are new are cut into the tokenizer's own pre-tokens, and these
    are encoded together as one text in which blanks keep them apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}

    def _one(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new pre-tokens."""
        if not words:
            return {}
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids, of = found.ids, found.word_ids
        if not ids or of[-1] != len(words) - 1:
            return {word: self._one(word) for word in words}
        out, begin = {}, 0
        for i, word in enumerate(words):
            end = bisect_right(of, i, begin)
            out[word] = array("I", ids[begin:end]).tobytes()
            begin = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        lines = []
        for text in texts:
            if SIGMA not in text and is_normalized("NFC", text):
                text = text.lower()  # as the tokenizer does, so that fewer words differ
            lines.append(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
        found = [list(map(known.get, line)) for line in lines]
        gaps = [[i for i, ids in enumerate(row) if ids is None] for row in found]
        new = {line[i] for line, holes in zip(lines, gaps) for i in holes}
        plain = {word for word in new if PLAIN.fullmatch(word)}
        cut = {word: [word] if word.isalpha() else PIECES.findall(word) for word in plain}
        pieces = {piece for parts in cut.values() for piece in parts if piece not in known}
        known.update(self._learn(sorted(pieces)))
        for word, parts in cut.items():
            if len(parts) != 1 or parts[0] != word:
                known[word] = b"".join([known[piece] for piece in parts])
        once = {}
        for word in new - plain:
            (known if len(word) <= LONGEST else once)[word] = self._one(word)
        for line, row, holes in zip(lines, found, gaps):
            for i in holes:
                row[i] = known[line[i]] if line[i] in known else once[line[i]]
        return [b"".join(row) for row in found]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents as ids and an end id, cut only where longer than `capacity`.

    Null texts are empty and still have their end id; repeated rows and null
    ids give their own pieces; other columns are not read.
    """
    schema = [("doc_id", "long"), ("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]

    def start():
        coder = word_ids(path or public_tokenizers.path(VOCABULARY))
        end = array("I", [END]).tobytes()

        def work(ids, texts):
            out = [[] for _ in range(6)]
            for begin in range(0, len(ids), TOGETHER):
                for doc, packed in zip(ids[begin : begin + TOGETHER], coder.encode([t or "" for t in texts[begin : begin + TOGETHER]])):
                    packed += end
                    for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                        part = packed[at : at + 4 * capacity]
                        for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                            column.append(value)
            return out if with_ids else out[:5]

        return work

    return map_batches(docs.select("doc_id", "text"), schema + [("ids", "binary")] * with_ids, start)


def price(values: np.ndarray, capacity: int) -> list[int]:
    """The multiset of lengths of the greatest value that fits: an unbounded knapsack. values[l] is that of length l, minus infinity if absent."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    lengths = np.flatnonzero(np.isfinite(values) & (values > 0))
    worth = values[lengths]
    for room in range(1, capacity + 1):
        n = np.searchsorted(lengths, room, side="right")
        if n:
            gains = best[room - lengths[:n]] + worth[:n]
            at = int(gains.argmax())
            if gains[at] > best[room - 1]:
                best[room], choice[room] = gains[at], lengths[at]
                continue
        best[room] = best[room - 1]
    out, room = [], capacity
    while room > 0:
        if choice[room]:
            out.append(int(choice[room]))
            room -= int(choice[room])
        else:
            room -= 1
    return out


def price_bounded(values: np.ndarray, left: np.ndarray, capacity: int, lengths: np.ndarray) -> list[int]:
    """As `price`, each length at most as often as it is left; `lengths` are those to consider, in this order."""
    best = np.zeros(capacity + 1)
    items, taken = [], []
    for length in lengths:
        many, times = min(int(left[length]), capacity // int(length)), 1
        while many > 0:
            times = min(times, many)
            items.append((int(length), times))
            size = int(length) * times
            with_it = best[: capacity + 1 - size] + values[length] * times
            better = with_it > best[size:]
            taken.append(better)
            best[size:] = np.where(better, with_it, best[size:])
            many, times = many - times, times * 2
    out, room = [], capacity
    for (length, times), better in zip(reversed(items), reversed(taken)):
        at = room - length * times
        if at >= 0 and better[at]:
            out += [length] * times
            room = at
    return out


def solve(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = 400, rate: float = 2.0) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (lengths, largest first) with how many sequences use them; every piece has a place.

    `counts` are the pieces of each length below `capacity`. The fractional
    part takes `rounds` prices; each length's weight is exp(-rate * covered
    share), so that lengths that lag behind gain.
    """
    number = np.zeros(capacity + 1)
    for length, count in counts.items():
        number[length] = count
    there = number > 0
    if not there.any():
        return []
    size = np.arange(capacity + 1) / capacity
    covered = np.zeros(capacity + 1)
    share = np.zeros(capacity + 1)
    amounts: dict[tuple[int, ...], float] = {}
    # Prices start from the share of a sequence and are tilted to long pieces, which are the hardest to place.
    base = size * (1 + 0.2 * size)
    for _ in range(rounds if number.sum() > capacity else 0):
        np.divide(covered, number, out=share, where=there)
        weights = np.exp(-rate * np.minimum(share, 1))
        values = np.where(there & (share < 1), base * weights, -np.inf)
        chosen = price(values, capacity)
        if not chosen:
            break
        chosen_lengths, times = np.unique(chosen, return_counts=True)
        step = float(((number - covered)[chosen_lengths] / times).min())
        if step < 1:
            covered[chosen_lengths[np.argmin((number - covered)[chosen_lengths] / times)]] = number[chosen_lengths[np.argmin((number - covered)[chosen_lengths] / times)]]
            continue
        covered[chosen_lengths] += step * times
        key = tuple(sorted(chosen, reverse=True))
        amounts[key] = amounts.get(key, 0) + step
    left = number.astype(np.int64)
    out: dict[tuple[int, ...], int] = {}
    for key, amount in amounts.items():
        whole = int(amount)
        if whole:
            out[key] = whole
            for length in key:
                left[length] -= whole
    # The rest, the longest piece first, filled by the bounded knapsack.
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        room = capacity - longest
        options = np.flatnonzero(left[: room + 1])[::-1]
        key = (longest, *price_bounded(base, left, room, options[:400])) if len(options) else (longest,)
        left[longest] += 1
        lengths, times = np.unique(key, return_counts=True)
        many = int((left[lengths] // times).min())
        left[lengths] -= many * times
        key = tuple(sorted(key, reverse=True))
        out[key] = out.get(key, 0) + many
    return sorted(out.items(), reverse=True)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: the first number of each run of places, its first sequence, its offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for key, many in plan:
        offset = 0
        for length in key:
            first = used.get(length, 0)
            runs.setdefault(length, []).append((first, sequence, offset))
            used[length] = first + many
            offset += length
        sequence += many
    return {length: tuple(np.array(column, dtype=np.int64) for column in zip(*rows)) for length, rows in runs.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = 64, bucket_rows: int = 100_000) -> DataFrame:
    """`pieces` (at least doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    A piece of full length is a sequence of its own, with a negative number.
    The others are numbered within their length: rows of a length are spread
    over at least `buckets` buckets of at most about `bucket_rows`, each bucket
    is numbered by itself, and the buckets' counts add up. `pieces` is read
    three times, so it should be stored. An empty table gives an empty one.
    """
    short = pieces.where(F.col("length") < capacity)
    histogram = {row["length"]: row["count"] for row in short.groupBy("length").count().collect()}
    slots = _slots(solve(histogram, capacity))
    wide = max(buckets, -(-sum(histogram.values()) // bucket_rows))
    keyed = short.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(wide)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = keyed.withColumn("_number", F.row_number().over(within) - 1).join(counts, ["length", "_bucket"])
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = [("doc_id", "long"), ("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
    places = [("sequence_id", "long"), ("offset", "long")]

    def start():
        def work(docs, piece, begin, lengths, crc, numbers):
            sequences, offsets = [], []
            for length, number in zip(lengths, numbers):
                first, sequence, offset = slots[length]
                run = int(np.searchsorted(first, number, side="right")) - 1
                sequences.append(int(sequence[run]) + number - int(first[run]))
                offsets.append(int(offset[run]))
            return docs, piece, begin, lengths, crc, sequences, offsets

        return work

    placed = map_batches(numbered.select(*own, (F.col("_number") + F.col("_before")).alias("_number")), schema + places, start)
    full = pieces.where(F.col("length") == capacity).select(
        *own, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.unionByName(placed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, store the pieces (without ids) in the shared folder, and place them."""
    return pack(Stored(token_pieces(docs, path, capacity), "pieces").df, capacity)
