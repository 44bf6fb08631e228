"""Merkle manifest of a dataset by time-forward processing.

Each row is a leaf; per source, every FANOUT consecutive nodes become one node of
the next level until one, the subroot, is left, and the subroots become the root
in the same way.

Nodes are labelled (level, number), so that children come before parents. A
sweep in the order of labels takes each node from a priority queue that holds
what its children sent, and sends its digest on; the reversed sweep sends each
node's proof, which its parent completes, down to the leaves. Spark's sort is
the external part of the queue: nodes are dealt and ordered by (source, block),
a block being an aligned subtree of FANOUT ** CLIMB nodes, and the message from
above is a row that comes before its block's rows. A task holds one block at a
time. The roots of blocks are the nodes of the next tier, so five rounds do
for 10 ** 14 leaves, and no source is ever in one task.

Rows: null columns are leaves' fields `-`; a null source is a source of its own,
before all others; null ids come first; rows with equal ids are ordered by their
leaf, so repeated rows are neighbours with equal leaves and proofs of their own
places. An empty table gives no row. Columns not in FIELDS do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopflow.llm.common import Stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 3
#: Levels that one round climbs: blocks of 729 nodes.
CLIMB = 6

NODE = "g string, total long, pos long, digest string, doc_id long, changed string"
PROOF = "g string, pos long, digest string, doc_id long, changed string, subroot string, before array<string>, after array<string>"
STRINGS = pa.list_(pa.string())


def leaf_digest(**replaced: Column) -> Column:
    """Digest of a row; `replaced` gives other values for some of the fields."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def climb(digests: list[str], levels: int | None) -> list[list[str]]:
    """All levels above the given nodes: `levels` of them, or as many as lead to one node."""
    tree = [digests]
    queue = [(1, i // FANOUT, i, digest) for i, digest in enumerate(digests)]
    width = len(digests)
    while width > 1 if levels is None else len(tree) <= levels:
        level, width = len(tree), -(-width // FANOUT)
        nodes = []
        for number in range(width):
            inputs = []
            while queue and queue[0][:2] == (level, number):
                inputs.append(heapq.heappop(queue)[3])
            nodes.append(hashlib.sha256("".join(inputs).encode()).hexdigest())
            heapq.heappush(queue, (level + 1, number // FANOUT, number, nodes[-1]))
        tree.append(nodes)
    return tree


def descend(tree: list[list[str]], before: list[str], after: list[str]) -> Iterator[tuple[int, list[str], list[str]]]:
    """(leaf's number, siblings before, siblings after), last leaf first; the lists hold one string a level, from the leaf up."""
    queue = [(-(len(tree) - 1), 0, before, after)]
    while queue:
        level, number, before, after = heapq.heappop(queue)
        level, number = -level, -number
        if level == 0:
            yield number, before, after
            continue
        first = number * FANOUT
        run = tree[level - 1][first : first + FANOUT]
        for k in range(len(run)):
            message = ["".join(run[:k]), *before], ["".join(run[k + 1 :]), *after]
            heapq.heappush(queue, (-(level - 1), -(first + k), *message))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for key, block in groupby(rows, key=lambda row: row[:2]):
        yield key, list(block)


def _in_blocks(nodes: DataFrame, *columns: str) -> DataFrame:
    """Nodes dealt by blocks and ordered within them; a message from above, without a place, comes first."""
    block = F.coalesce("block", F.floor(F.col("pos") / FANOUT**CLIMB)) if "block" in nodes.columns else F.floor(F.col("pos") / FANOUT**CLIMB)
    dealt = nodes.withColumn("block", block).repartition("g", "block").sortWithinPartitions("g", "block", F.asc_nulls_first("pos"))
    return dealt.select("g", "block", *columns)


def _tree(digests: list[str], total: int, levels: int) -> list[list[str]]:
    return climb(digests, levels if total > FANOUT**levels else None)


def _sweep_up(nodes: DataFrame) -> DataFrame:
    """The roots of all blocks, as nodes of the next tier."""
    schema = pa.schema([("g", pa.string()), ("total", pa.int64()), ("pos", pa.int64()), ("digest", pa.string()), ("doc_id", pa.int64()), ("changed", pa.string())])

    levels = CLIMB

    def run(batches):
        for (g, block), rows in _blocks(batches):
            total = rows[0][2]
            root = _tree([row[3] for row in rows], total, levels)[-1][0]
            values = (g, -(-total // FANOUT**levels), block, root, None, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    return _in_blocks(nodes, "total", "digest").mapInArrow(run, NODE)


def _sweep_down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The proofs of a tier's nodes from those of its blocks' roots."""
    fields = [("g", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("doc_id", pa.int64()), ("changed", pa.string()), ("subroot", pa.string())]
    schema = pa.schema([*fields, ("before", STRINGS), ("after", STRINGS)])
    levels = CLIMB

    def run(batches):
        for (g, _), (message, *rows) in _blocks(batches):
            subroot, before, after = message[7:]
            tree = _tree([row[4] for row in rows], rows[0][2], levels)
            out = [(g, *rows[i][3:7], subroot, left, right) for i, left, right in descend(tree, before, after)]
            for at in range(0, len(out), 2048):
                columns = zip(*out[at : at + 2048], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    messages = above.select("g", F.col("pos").alias("block"), "subroot", "before", "after")
    together = nodes.withColumn("block", F.lit(None).cast("long")).unionByName(messages, allowMissingColumns=True)
    return _in_blocks(together, "total", "pos", "digest", "doc_id", "changed", "subroot", "before", "after").mapInArrow(run, PROOF)


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, Stored]:
    """rows with their number `pos` within `g`, by `order`, and the size `total` of `g`.

    Rows are dealt by ranges of (g, order), so a hot group is spread over tasks;
    what is counted afterwards is one row per range and group.
    """
    placed = Stored(
        rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).withColumn("at", F.monotonically_increasing_id()), "numbered"
    )
    piece = F.shiftright("at", 33).alias("piece")
    starts = placed.df.groupBy("g", piece).agg(F.min("at").alias("start"), F.count("*").alias("n"))
    group = Window.partitionBy("g")
    earlier = F.coalesce(F.sum("n").over(group.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("g", "piece", (earlier - F.col("start")).alias("shift"), F.sum("n").over(group).alias("total"))
    numbered = placed.df.withColumn("piece", F.shiftright("at", 33)).join(starts, ["g", "piece"])
    return numbered.withColumn("pos", F.col("at") + F.col("shift")), placed


def _grown(leaves: DataFrame) -> list[Stored]:
    """Tiers of nodes, from the leaves to one node per group."""
    tiers = [Stored(leaves, "nodes")]
    widest = tiers[0].df.agg(F.max("total")).first()[0] or 1
    while True:
        tiers.append(Stored(_sweep_up(tiers[-1].df), "nodes"))
        if widest <= FANOUT**CLIMB:
            return tiers
        widest = -(-widest // FANOUT**CLIMB)


def _proofs(tiers: list[Stored], top: DataFrame) -> DataFrame:
    """Proofs of the lowest tier's nodes; `top` has those of the highest: g, pos, subroot, before, after."""
    steps = []
    for tier in reversed(tiers[1:-1]):
        steps.append(Stored(_sweep_down(tier.df, top), "proofs"))
        top = steps[-1].df
    out = Stored(_sweep_down(tiers[0].df, top), "proofs")
    for step in [*tiers, *steps]:
        step.remove()
    return out.df


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Per row: doc_id, leaf, changed, subroot, root, and its proof: before, after (arrays, one string of digests a level).

    `changed` is a digest (see `leaf_digest`) to be carried along for a later check.
    """
    spark = docs.sparkSession
    group = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))
    changed = F.lit(None).cast("string") if changed is None else changed
    leaves = Stored(docs.select(group.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"), changed.alias("changed")), "leaves")
    numbered, placed = _numbered(leaves.df, ["doc_id", "digest"])
    tiers = _grown(numbered.select("g", "total", "pos", "digest", "doc_id", "changed"))
    leaves.remove()
    placed.remove()

    subroots = Stored(tiers[-1].df.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "subroots")
    ranked, placed = _numbered(subroots.df, ["name"])
    # The name of a source travels in the column that leaves use for their changed digest.
    upper = _grown(ranked.select("g", "total", "pos", "digest", F.lit(None).cast("long").alias("doc_id"), F.col("name").alias("changed")))
    top = upper[-1].df.first()
    root = top["digest"] if top else None
    empty = F.array().cast("array<string>")
    start = upper[-1].df.select("g", "pos", F.lit(None).cast("string").alias("subroot"), empty.alias("before"), empty.alias("after"))
    by_source = _proofs(upper, start)
    placed.remove()
    subroots.remove()
    above = by_source.select(F.col("changed").alias("g"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "before", "after")
    proofs = _proofs(tiers, above)
    return proofs.select("doc_id", F.col("digest").alias("leaf"), "changed", "subroot", F.lit(root).cast("string").alias("root"), "before", "after")


def folded(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(F.arrays_zip(before.alias("before"), after.alias("after")), leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def siblings(before: Column, after: Column) -> Column:
    """All digests of a proof, from the leaf's level up."""
    return F.array_join(F.zip_with(before, after, lambda a, b: F.concat(a, b)), "")
