"""Token counts under a unigram model, from a trie that pre-tokens share.

The vocabulary is a ranks file. A token of rank r scores -ln(r + 2) in whole
millionths (Zipf's law: rank 0 is likeliest), so that sums are exact and ties
well defined. Of all segmentations of a pre-token the one with the highest sum
counts; of equal ones, the one with the fewest tokens.

Distinct pre-tokens are inserted in a trie over bytes. A node holds the forward
score and the token count of the best segmentation of its path, which depend on
the path alone: a prefix that many pre-tokens share is scored once. The node
where a pre-token ends is its terminal and gives its count.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stopflow.llm.bpe import VOCABULARY, chunks, load_ranks, pieces
from stopflow.llm.common import map_batches

#: Trie nodes, and remembered chunks, a task holds before it starts anew; pre-tokens longer than LONGEST stay outside.
NODES, REMEMBERED, LONGEST = 1_500_000, 600_000, 96


#: Bytes of text that are cut and looked up together.
RUN = 1 << 23
#: A white character (Unicode's, as in the pattern) before a space.
DOUBLE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "

#: A value holds a score and a token count as score * ONE - count: values add, and compare as the pair would.
ONE = 1 << 40


@lru_cache(maxsize=2)
def load_scores(path: str) -> dict[bytes, int]:
    return {token: -round(1e6 * math.log(rank + 2)) for token, rank in load_ranks(path).items()}


def unpack(value: int) -> tuple[int, int]:
    """Score and token count."""
    score = -(-value // ONE)
    return score, score * ONE - value


class UnigramTrie:
    def __init__(self, scores: dict[bytes, int]):
        #: Every ending of a token, with the score if it is a token itself.
        self.endings: dict[bytes, int | None] = {token[i:]: None for token in scores for i in range(len(token))}
        self.endings.update({token: score * ONE - 1 for token, score in scores.items()})
        self._clear()
        self._forget()

    def _clear(self) -> None:
        self.best: dict[bytes, int] = {b"": 0}  # a node, by its path, and its value

    def _forget(self) -> None:
        #: Remembered chunks and where their pre-tokens, tokens and scores stand in `rows`.
        self.known: dict[str, int] = {}
        self.rows = [array("q") for _ in range(3)]

    def terminal(self, data: bytes) -> int:
        """The value of a pre-token: the nodes it shares with others are found, the rest of its path is scored."""
        best = self.best
        value = best.get(data)
        if value is not None:
            return value
        if len(data) > LONGEST:
            best = {b"": 0}
        elif len(best) > NODES:
            self._clear()
            best = self.best
        depth = len(data) - 1
        while data[:depth] not in best:
            depth -= 1
        get = self.endings.get
        for end in range(depth + 1, len(data) + 1):
            value = None
            for begin in range(end - 1, -1, -1):
                score = get(data[begin:end], 1)
                if score == 1:  # no token ends with these bytes, nor with more
                    break
                if score is not None:
                    through = best[data[:begin]] + score
                    if value is None or through > value:
                        value = through
            best[data[:end]] = value
        return value

    def count(self, text: str) -> tuple[int, int, int]:
        """Pre-tokens, tokens and score of a text."""
        parts = chunks(text)
        if parts is None:
            parts = pieces(text)
        if len(self.rows[0]) >= REMEMBERED:
            self._forget()
        at = self._places(parts)
        return tuple(sum(map(row.__getitem__, at)) for row in self.rows)

    def count_batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Pre-tokens, tokens and scores of texts: a chunk that occurs often in them is looked up once."""
        plain = pc.invert(pc.match_substring_regex(texts, DOUBLE)).to_numpy(zero_copy_only=False)
        sums = np.zeros((3, len(texts)), dtype=np.int64)
        for i in np.flatnonzero(~plain).tolist():
            sums[:, i] = self.count(texts[i].as_py())
        split = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        if not len(split):
            return list(sums)
        if len(self.rows[0]) >= REMEMBERED:
            self._forget()
        ends = split.offsets.to_numpy()
        words = split.values.dictionary_encode()
        place = words.indices.to_numpy().copy()
        # A text's first chunk has no space before it.
        first = self._places(words.dictionary.take(pa.array(place[ends[:-1]])).to_pylist())
        later = self._places([" " + word for word in words.dictionary.to_pylist()])
        place[ends[:-1]] = np.arange(len(later), len(later) + len(first))
        found = np.array(later + first, dtype=np.int64)[place]
        for i, row in enumerate(self.rows):
            sums[i, plain] = np.add.reduceat(np.frombuffer(row, dtype=np.int64)[found], ends[:-1])
        return list(sums)

    def _places(self, parts: list[str]) -> list[int]:
        """Where the rows of chunks stand."""
        found = list(map(self.known.get, parts))
        for i, at in enumerate(found):
            if at is None:
                found[i] = self._count(parts[i])
        return found

    def _add(self, part: str, *values: int) -> int:
        at = len(self.rows[0])
        for row, value in zip(self.rows, values):
            row.append(value)
        if len(part) <= LONGEST:
            self.known[part] = at
        return at

    def _count(self, part: str) -> int:
        """One chunk by its pre-tokens, which are remembered as the chunk is."""
        known = self.known
        if part in known:
            return known[part]
        if part[1:].isalpha() and part[0] == " ":
            return self._word(part)
        found = []
        for word in pieces(part):
            at = known.get(word)
            found.append(self._word(word) if at is None else at)
        if len(found) == 1:
            return found[0]
        return self._add(part, *[sum(map(row.__getitem__, found)) for row in self.rows])

    def _word(self, word: str) -> int:
        score, tokens = unpack(self.terminal(word.encode()))
        return self._add(word, 1, tokens, score)


@lru_cache(maxsize=2)
def trie_of(path: str) -> UnigramTrie:
    """A worker's trie, which serves its later tasks too."""
    return UnigramTrie(load_scores(path))


def count_tokens(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, score): one row per row of docs, in one pass and without a shuffle.

    Null and empty texts count nothing and score 0; repeated rows and null ids
    give their rows; other columns are not read. A task's trie and memory are
    bounded and start anew when full, which changes no result.
    """

    def start():
        trie = trie_of(path or public_tokenizers.path(VOCABULARY))

        def work(ids, texts):
            texts = pa.array([text or "" for text in texts], pa.large_string())
            # Runs of about RUN bytes, so that memory does not follow the length of texts.
            runs = np.cumsum(pc.binary_length(texts).to_numpy()) // RUN
            cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)]
            found = [trie.count_batch(texts[a:b]) for a, b in zip(cuts, cuts[1:])]
            return ids, *[np.concatenate([part[i] for part in found]) for i in range(3)]

        return work

    schema = [("doc_id", "long"), ("n_pretokens", "long"), ("n_tokens", "long"), ("score", "long")]
    return map_batches(docs.select(id_column, text_column), schema, start)
