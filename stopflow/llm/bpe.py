"""Byte-level BPE encoding and decoding by a monoid tree reduction.

A pre-token is halved recursively. Short halves are merged directly; two
neighbours are joined by re-encoding a window around their boundary, doubled
until the tokens outside provably stay: a token sequence is the encoding of its
bytes exactly if each adjacent pair is the encoding of its own bytes, so it is
enough that the pairs at both window edges are. A document's result is the
concatenation of its pre-tokens' results, and decoding concatenates the tokens'
bytes back, both associative.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from stopflow.llm.common import map_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes up to which a half is merged directly.
LEAF = 24
#: Bytes up to which pairs are scanned rather than kept in a heap; a cost above all ranks.
SHORT, NEVER = 64, 1 << 40
#: Distinct chunks a task remembers, and the longest one it remembers.
REMEMBERED, LONGEST = 1_000_000, 64

_DOUBLE = regex.compile(r"\s ")
_PATTERN = regex.compile(public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks file: a base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def chunks(text: str) -> list[str] | None:
    """Text cut before each single space; None where two white characters meet.

    A space that follows a character other than white space always begins a
    match, as no alternative of the pattern has a space behind such a
    character. So pre-tokens never cross these cuts.
    """
    if _DOUBLE.search(text):
        return None
    first, *rest = text.split(" ")
    return [first, *[" " + word for word in rest]]


def pieces(text: str) -> list[str]:
    """The pattern's matches; together they are the whole text."""
    return _PATTERN.findall(text)


class ByteBpe:
    """Encoder and decoder over one ranks table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Direct merging: the pair of lowest rank first, the leftmost of equal ones."""
        return self._merge_short(data) if len(data) <= SHORT else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        """By scanning for the lowest rank each time."""
        get = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [get(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while costs:
            low = min(costs)
            if low == NEVER:
                break
            i = costs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return [self.ranks[part] for part in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """With a heap of pairs."""
        ranks, size = self.ranks, len(data)
        end = list(range(1, size + 1))  # where the part that starts here ends
        before = list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        gone = bytearray(size)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            middle = end[i]
            if gone[i] or middle >= stop or end[middle] != stop:
                continue
            end[i], gone[middle] = stop, 1
            if stop < size:
                before[stop] = i
                found = ranks.get(data[i : end[stop]])
                if found is not None:
                    heapq.heappush(heap, (found, i, end[stop]))
            left = before[i]
            if left >= 0:
                found = ranks.get(data[left:stop])
                if found is not None:
                    heapq.heappush(heap, (found, left, stop))
        out, i = [], 0
        while i < size:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def stays(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their own bytes."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            found = self.pairs[key] = self.merge(self.token[left] + self.token[right]) == [left, right]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The product of two encodings."""
        if not left or not right:
            return left or right
        width = 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            inner = self.merge(b"".join([self.token[t] for t in left[a:] + right[:b]]))
            if (a == 0 or self.stays(left[a - 1], inner[0])) and (b == len(right) or self.stays(inner[-1], right[b])):
                return left[:a] + inner + right[b:]
            width *= 2

    def reduce(self, data: bytes) -> list[int]:
        """One pre-token by recursive halves."""
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def encode_piece(self, data: bytes) -> list[int]:
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.reduce(data)

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after another."""
        parts = chunks(text)
        if parts is None:
            parts = pieces(text)
        known = self.known
        if len(known) >= REMEMBERED:
            known.clear()
        out = []
        for part in parts:
            packed = known.get(part)
            out.append(packed if packed is not None else self._packed(part))
        return b"".join(out)

    def _packed(self, part: str) -> bytes:
        """One chunk by its pre-tokens, which are remembered as the chunk is."""
        known = self.known
        words = [part] if part[1:].isalpha() and part[0] == " " else pieces(part)
        out = []
        for word in words:
            packed = known.get(word)
            if packed is None:
                packed = array("I", self.encode_piece(word.encode())).tobytes()
                if len(word) <= LONGEST:
                    known[word] = packed
            out.append(packed)
        packed = b"".join(out)
        if len(words) != 1 and len(part) <= LONGEST:
            known[part] = packed
        return packed

    def decode_packed(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def coder(path: str) -> ByteBpe:
    """A worker's encoder; what it remembers serves the worker's later tasks."""
    return ByteBpe(load_ranks(path))


def encode_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids binary): ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids; every row gives a row, repeated and null
    ids included; other columns are not read. `path` must be readable by the
    workers; by default it is the installed vocabulary.
    """

    def start():
        own = coder(path or public_tokenizers.path(VOCABULARY))

        def work(ids, texts):
            packed = [own.encode_packed(text or "") for text in texts]
            return ids, [len(p) // 4 for p in packed], packed

        return work

    return map_batches(docs.select(id_column, text_column), [("doc_id", "long"), ("n_tokens", "long"), ("ids", "binary")], start)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, data binary) from (doc_id, ids); null ids give no bytes."""

    def start():
        own = coder(path or public_tokenizers.path(VOCABULARY))
        return lambda ids, packed: (ids, [own.decode_packed(p or b"") for p in packed])

    return map_batches(encoded.select("doc_id", "ids"), [("doc_id", "long"), ("data", "binary")], start)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, digests only."""

    def start():
        own = coder(path or public_tokenizers.path(VOCABULARY))
        sha = lambda data: hashlib.sha256(data).hexdigest()

        def work(ids, texts):
            packed = [own.encode_packed(text or "") for text in texts]
            decoded = [sha(own.decode_packed(p)) for p in packed]
            return ids, [len(p) // 4 for p in packed], [sha(p) for p in packed], decoded

        return work

    schema = [("doc_id", "long"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return map_batches(docs.select("doc_id", "text"), schema, start)
