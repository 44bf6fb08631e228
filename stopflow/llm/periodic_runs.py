"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q, at least max(SHORTEST,
REPEATS * q) words long, that no neighbouring word extends keeping that period.

The automaton's suffix links form a tree whose path from a prefix's node to the
root holds all suffixes of that prefix. A link-cut forest cuts the tree into path
segments whose strings last ended at the same place. Appending a word accesses
its prefix's path: each segment passed tells the longest suffix (its lowest
node's length) that last ended d words ago, and the whole path is recoloured. A
distance d within that length is a square, indeed a stretch of length + d words
of smallest period d that starts where it is told; the last word at which it is
seen ends the run. Accesses pass O(log n) segments a word on average.

Words far from any run need no automaton: a run of period q shows as at least
REPEATS * q - q words in a row equal to those q before (looked at for each q up
to SMALL), or, for longer periods, as that many places in a row whose next
GRAM words have last begun at most q words before. `stretches` finds all such
places with numpy and adds the period before them, so every run, and what ends
it, is inside one stretch; each stretch gets its automaton. Hashes are used here
only, and equal hashes of different words could only add stretches. Stretches
are whatever the text has: a text that is one long run is one stretch.

A row is one text and memory is bounded by its length. Null and empty texts, and
those of blanks alone, have no words, no runs and an empty collapsed text;
repeated rows are worked on one by one; other columns stay as they are, and a
column called like an output gives way to it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import map_batches

SHORTEST, REPEATS = 6, 4
#: Periods that are looked for one by one, and the words compared for the longer ones.
SMALL, GRAM = 7, 8
#: Words that are looked at together; a longer text is looked at alone.
CHUNK = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)


def squares(words: list) -> list[tuple[int, int, int]]:
    """All runs of a list of words as (start, length, period), by the automaton."""
    # Suffix automaton: node 0 is the empty word and stands for "none" in the forest.
    step, link, size, ends = [{}], [-1], [0], []
    last = 0
    for word in words:
        node = len(size)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        ends.append(node)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = node
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if size[p] + 1 != size[q]:
                clone = len(size)
                step.append(step[q].copy())
                size.append(size[p] + 1)
                link.append(link[q])
                link[q] = clone
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = clone
                    p = link[p]
                q = clone
            link[node] = q
        last = node
    del step

    # Link-cut forest over the links: splay trees of segments, ordered by depth.
    above, up, down = link, [0] * len(size), [0] * len(size)
    colour = [-1] * len(size)
    above[0] = 0
    found: dict[tuple[int, int], int] = {}
    for now, prefix in enumerate(ends):
        lower, node = 0, prefix
        while node:
            # Splay: the node becomes the root of its segment and takes over its colour.
            while True:
                p = above[node]
                if not p or (up[p] != node and down[p] != node):
                    break
                g = above[p]
                rooted = not g or (up[g] != p and down[g] != p)
                turns = (node,) if rooted else (p, node) if (up[p] == node) == (up[g] == p) else (node, node)
                for x in turns:
                    y = above[x]
                    z = above[y]
                    if up[y] == x:
                        c = down[x]
                        up[y], down[x] = c, y
                    else:
                        c = up[x]
                        down[y], up[x] = c, y
                    if c:
                        above[c] = y
                    above[y], above[x] = x, z
                    if z and up[z] == y:
                        up[z] = x
                    elif z and down[z] == y:
                        down[z] = x
                    else:
                        colour[x] = colour[y]
            seen = colour[node]
            if down[node]:
                colour[down[node]] = seen
            if seen >= 0:
                distance = now - seen
                if size[node] >= (REPEATS - 1) * distance:
                    found[now + 1 - size[node] - distance, distance] = now
            down[node] = lower
            lower, node = node, above[node]
        colour[lower] = now
    runs = [(start, end + 1 - start, period) for (start, period), end in found.items()]
    return sorted(run for run in runs if run[1] >= max(SHORTEST, REPEATS * run[2]))


def _in_a_row(places: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, last) of the maximal stretches of consecutive numbers, at least so long."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    first = places[np.concatenate(([0], cut + 1))]
    final = places[np.concatenate((cut, [len(places) - 1]))]
    long = final - first + 1 >= least
    return list(zip(first[long].tolist(), final[long].tolist(), strict=True))


def stretches(lists: list[list]) -> list[list[tuple[int, int]]]:
    """For each list of words the disjoint stretches (start, end) that can hold runs."""
    flat = [x for number, words in enumerate(lists) for x in (*words, number)]
    n = len(flat)
    h = np.fromiter(map(hash, flat), dtype=np.int64, count=n).view(np.uint64)
    stops = np.cumsum([len(words) + 1 for words in lists], dtype=np.int64) - 1
    found = []
    for q in range(1, SMALL + 1):
        same = h[q:] == h[:-q]
        same[stops[stops >= q] - q] = False
        places = np.flatnonzero(same) + q
        found += [(a - q, b + 1) for a, b in _in_a_row(places, max(SHORTEST, REPEATS * q) - q)]
    if n > GRAM:
        gram = np.zeros(n - GRAM + 1, dtype=np.uint64)
        for k in range(GRAM):
            gram = gram * MIX + h[k : n - GRAM + 1 + k]
        document = np.repeat(np.arange(len(lists)), np.diff(stops, prepend=-1))[: len(gram)].astype(np.uint64)
        gram = (gram ^ (document * MIX)) * MIX
        low = np.uint64((1 << n.bit_length()) - 1)
        ordered = np.sort((gram & ~low) | np.arange(len(gram), dtype=np.uint64))
        again = np.flatnonzero((ordered[1:] ^ ordered[:-1]) <= low)
        place = (ordered & low).astype(np.int64)
        distance = np.zeros(len(gram), dtype=np.int64)
        distance[place[again + 1]] = place[again + 1] - place[again]
        places = np.flatnonzero(distance)
        most = 2 * SMALL + 1
        while len(places):
            near = places[distance[places] <= most]
            least = (REPEATS - 1) * ((most + 1) // 2) - GRAM + 1
            found += [(a - most, b + GRAM) for a, b in _in_a_row(near, least)]
            if least > len(places):
                break
            most = 2 * most + 1
    out: list[list[tuple[int, int]]] = [[] for _ in lists]
    for a, b in sorted(found):
        number = int(np.searchsorted(stops, b - 1))
        begin = int(stops[number - 1]) + 1 if number else 0
        a, b = max(a - begin, 0), min(b - begin, len(lists[number]))
        mine = out[number]
        if mine and a <= mine[-1][1]:
            mine[-1] = (mine[-1][0], max(b, mine[-1][1]))
        else:
            mine.append((a, b))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find_runs(docs: DataFrame, key: str = "doc_id", alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """docs' key with runs (array of start, length, period, in this order) and collapsed (text).

    `alter` may change a text's words, given its key, before they are looked at.
    """

    def start():
        def chunks(keys, texts):
            """Words of consecutive texts, so many at a time that a batch's words are never held together."""
            held, size = [], 0
            for k, text in zip(keys, texts, strict=True):
                words = (text or b"").split()  # bytes are split at [\x20\x09-\x0D]
                held.append(alter(k, words) if alter else words)
                size += len(words)
                if size >= CHUNK:
                    yield held
                    held, size = [], 0
            yield held

        def work(keys, texts):
            starts, lengths, periods, collapsed = [], [], [], []
            for lists in chunks(keys, texts):
                for words, parts in zip(lists, stretches(lists), strict=True):
                    runs = [(a + s, n, q) for a, b in parts for s, n, q in squares(words[a:b])]
                    for values, k in ((starts, 0), (lengths, 1), (periods, 2)):
                        values.append([run[k] for run in runs])
                    collapsed.append(collapse(words, runs))
            return keys, starts, lengths, periods, collapsed

        return work

    longs = [(name, "array<long>") for name in ("start", "length", "period")]
    rows = docs.select(F.col(key).cast("long"), F.col("text").cast("binary"))
    out = map_batches(rows, [(key, "long"), *longs, ("collapsed", "binary")], start)
    return out.select(key, F.arrays_zip("start", "length", "period").alias("runs"), F.col("collapsed").cast("string").alias("collapsed"))


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """Words of which one text in ten gets a periodic end, by the checksum of its key."""
    h = zlib.crc32(b"%d" % key) if key is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]
