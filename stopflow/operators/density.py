"""Density clusters (DBSCAN) over cells instead of pairs of points.

Space is cut into cells of side eps / sqrt(d), so small that all points of a
cell lie within eps of each other. A cell of `min_points` or more is core without
a distance taken; only points of thinner cells count their neighbours, and stop
when they have enough. Two core cells are joined by one linking pair, whichever.

Both questions are asked of bounding boxes first: boxes whose farthest corners
are within eps settle a pair, boxes farther apart than eps drop it, and only what
is left is cut into smaller boxes, down to single points where few are left. So
work grows with occupied cells and with what lies right at the distance eps, not
with the points of a crowded place; nothing brings all points of a cell together.
Cells find their neighbours through aligned squares of at least eps by joins on names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS
from stopflow.functions.ranks import ranked
from stopflow.session import join_lookup, materialize

#: Boxes with at most so many points are cut into their points, larger ones into CUT pieces a side.
FEW, CUT = 32, 8


def _numbers(origin: list[float], side: float) -> Column:
    return F.array(*[F.floor((F.get("x", i) - F.lit(o)) / F.lit(side)) for i, o in enumerate(origin)])


def _name(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda v: v.cast("string")), ",")


def _boxes(points: DataFrame, dims: int, *keys: str) -> DataFrame:
    """One row per key: number of points, least and greatest coordinates."""
    sides = [F.array(*[f(F.get("x", i)) for i in range(dims)]).alias(name) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    return points.groupBy(*keys).agg(F.count("*").alias("points"), *sides)


def _apart(dims: int, a: str, b: str) -> tuple[Column, Column]:
    """Squared distance of two boxes' nearest and of their farthest points."""
    near, far = F.lit(0.0), F.lit(0.0)
    for i in range(dims):
        up = F.get(f"{a}.hi", i) - F.get(f"{b}.lo", i)
        down = F.get(f"{b}.hi", i) - F.get(f"{a}.lo", i)
        gap, reach = F.greatest(-up, -down, F.lit(0.0)), F.greatest(up, down)
        near, far = near + gap * gap, far + reach * reach
    return near, far


def _met(pairs: DataFrame, left: DataFrame, right: DataFrame, dims: int, eps: float) -> DataFrame:
    """Pairs (tag, need, l, r) with their boxes, those farther apart than eps left out; `within` where all points are within eps."""
    near, far = _apart(dims, "a", "b")
    joined = pairs.alias("p").join(left.alias("a"), F.col("p.l") == F.col("a.key")).join(right.alias("b"), F.col("p.r") == F.col("b.key"))
    kept = joined.where(near <= eps * eps)
    return kept.select(
        "p.tag", "p.need", "p.l", "p.r", F.col("a.points").alias("l_points"), F.col("b.points").alias("r_points"), (far <= eps * eps).alias("within")
    )


def within_reach(pairs: DataFrame, left: DataFrame, right: DataFrame, dims: int, eps: float, origin: list[float], side: float) -> DataFrame:
    """(tag, found) for pairs (tag, need, l, r) of boxes, named by the `key` of points (key, id, x) on either side.

    `found` is the number of points on the right within eps of the left point, or, where the left is a box,
    anything above 0 if some pair is within eps. Tags stop once they have what they need.
    """
    found = None
    level = 0
    opened = pairs
    while True:
        met = materialize(_met(opened, _boxes(left, dims, "key"), _boxes(right, dims, "key"), dims, eps), "pairs")
        new = met.where("within").groupBy("tag").agg(F.sum("r_points").alias("found"))
        found = new if found is None else found.unionByName(new).groupBy("tag").agg(F.sum("found").alias("found"))
        left_open = met.where(~F.col("within")).join(found, "tag", "left").where(F.coalesce("found", F.lit(0)) < F.col("need"))
        left_open = materialize(left_open.drop("found", "within"), "open")
        if left_open.isEmpty():
            return found
        level += 1

        def cut(points: DataFrame, name: str, level: int = level, open_pairs: DataFrame = left_open) -> DataFrame:
            kept = open_pairs.select(F.col(name).alias("key"), F.col(f"{name}_points").alias("points")).distinct()
            piece = F.when(F.col("points") <= FEW, F.col("id")).otherwise(_name(_numbers(origin, side / CUT**level)))
            inside = points.join(kept, "key").withColumn("parent", F.col("key"))
            return materialize(inside.withColumn("key", F.concat_ws("/", "parent", piece)).drop("points"), "pieces")

        left, right = cut(left, "l"), cut(right, "r")
        of_left = left.select(F.col("parent").alias("l"), F.col("key").alias("l_new")).distinct()
        of_right = right.select(F.col("parent").alias("r"), F.col("key").alias("r_new")).distinct()
        opened = left_open.select("tag", "need", "l", "r").join(of_left, "l").join(of_right, "r")
        opened = opened.select("tag", "need", F.col("l_new").alias("l"), F.col("r_new").alias("r"))


def _neighbours(cells: DataFrame, dims: int, eps: float) -> DataFrame:
    """(a, b): different occupied cells whose boxes are within eps, in both orders."""
    squares = cells.select("square", "numbers").distinct()
    around = squares.withColumn("at", F.col("numbers"))
    for i in range(dims):
        around = around.withColumn(f"d{i}", F.explode(F.sequence(F.get("at", i) - 1, F.get("at", i) + 1)))
    near = around.select("square", _name(F.array(*[f"d{i}" for i in range(dims)])).alias("other"))
    near = near.join(squares.select(F.col("square").alias("other")), "other")
    here, there = cells.alias("a"), cells.alias("b")
    both = near.join(here, F.col("a.square") == near["square"]).join(there, F.col("b.square") == near["other"])
    distance, _ = _apart(dims, "a", "b")
    return both.where((F.col("a.key") != F.col("b.key")) & (distance <= eps * eps)).select(F.col("a.key").alias("a"), F.col("b.key").alias("b"))


def connect(edges: DataFrame, nodes: DataFrame, name: str = "labels") -> DataFrame:
    """(node, label): label is the same for all nodes joined by edges.

    Every round takes the smallest label among the neighbours, then the label of
    the label, which halves the remaining distance. Each round is written to the
    shared folder, so the plan stays short and a lost executor costs one round.
    """
    labels = materialize(nodes.select("node", F.col("node").alias("label")), name)
    edges = materialize(edges.select("a", "b"), f"{name}-edges")
    while True:
        offered = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("offer"))
        lowered = labels.join(offered, labels["node"] == offered["a"], "left").select(
            "node", F.col("label").alias("before"), F.least("label", F.coalesce("offer", "label")).alias("label")
        )
        lowered = materialize(lowered, name)
        jump = lowered.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        jumped = join_lookup(lowered, jump, "label").select("node", "before", F.least("label", "jump").alias("label"))
        labels = materialize(jumped, name)
        if labels.where(F.col("label") != F.col("before")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def density_clusters(
    scaled: DataFrame,
    columns: list[str],
    eps: float = DEFAULTS.density_eps,
    min_points: int = DEFAULTS.density_min_points,
) -> DataFrame:
    """Add `cluster` to rows keyed by `stop`: 0, 1, ... or -1 for noise.

    A point with at least `min_points` points within eps (itself included) is a
    core point. Clusters are numbered by their first core point; a border point
    reachable from several clusters takes the first.
    """
    dims = len(columns)
    least = scaled.agg(*[F.min(c).alias(c) for c in columns]).first()
    origin = [float(least[c] or 0.0) for c in columns]
    side = eps / math.sqrt(dims) * (1 - 1e-12)
    # Squares are aligned with cells and at least eps wide, so all that is near is next door.
    across = math.ceil(math.sqrt(dims)) + 1
    points = scaled.select(F.col("stop").alias("id"), F.array(*columns).alias("x")).withColumn("numbers", _numbers(origin, side))
    points = materialize(points.select("id", "x", _name(F.col("numbers")).alias("cell"), F.transform("numbers", lambda v: F.floor(v / across)).alias("numbers")), "points")
    cells = points.withColumn("key", F.col("cell"))
    cells = materialize(_boxes(cells, dims, "key", "numbers").withColumn("square", _name(F.col("numbers"))), "cells")
    pairs = materialize(_neighbours(cells, dims, eps), "neighbours")

    by_cell = points.select(F.col("cell").alias("key"), "id", "x")
    thin = materialize(points.join(cells.where(F.col("points") < min_points).select(F.col("key").alias("cell"), "points"), "cell"), "thin")
    asked = thin.join(pairs, thin["cell"] == pairs["a"]).select(
        F.col("id").alias("tag"), (F.lit(min_points) - F.col("points")).alias("need"), F.col("id").alias("l"), F.col("b").alias("r")
    )
    alone = thin.select(F.col("id").alias("key"), "id", "x")
    counted = within_reach(asked, alone, by_cell, dims, eps, origin, side)
    thin = thin.join(counted.withColumnRenamed("tag", "id"), "id", "left")
    thin = materialize(thin.withColumn("core", F.col("points") + F.coalesce("found", F.lit(0)) >= min_points), "counted")

    thick = points.join(cells.where(F.col("points") >= min_points).select(F.col("key").alias("cell")), "cell", "left_semi")
    cores = materialize(thick.select("id", "x", "cell").unionByName(thin.where("core").select("id", "x", "cell")), "cores")
    core_points = cores.select(F.col("cell").alias("key"), "id", "x")
    nodes = cores.select(F.col("cell").alias("node")).distinct()

    # Cells settled by their boxes are joined first; pairs already in one group need no look at their points.
    candidates = pairs.where("a < b").select(F.concat_ws("|", "a", "b").alias("tag"), F.lit(1).alias("need"), F.col("a").alias("l"), F.col("b").alias("r"))
    boxes = _boxes(core_points, dims, "key")
    met = materialize(_met(candidates, boxes, boxes, dims, eps), "core-pairs")
    sure = met.where("within").select(F.col("l").alias("a"), F.col("r").alias("b"))
    labels = connect(_both_ways(sure), nodes)
    here, there = (labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in "lr")
    unsettled = met.where(~F.col("within")).join(here, "l").join(there, "r").where("l_label <> r_label").select("tag", "need", "l", "r")
    unsettled = materialize(unsettled, "unsettled")
    if not unsettled.isEmpty():
        more = within_reach(unsettled, core_points, core_points, dims, eps, origin, side)
        more = more.where("found > 0").select(F.split("tag", r"\|")[0].alias("a"), F.split("tag", r"\|")[1].alias("b"))
        labels = connect(_both_ways(sure.unionByName(more)), nodes)
    labels = labels.withColumnRenamed("node", "cell")

    first = join_lookup(cores.select("id", "cell"), labels, "cell").groupBy("label").agg(F.min("id").alias("first"))
    numbers = ranked(first, ["first"], "cluster").select("label", "cluster")
    clusters = materialize(join_lookup(labels, numbers, "label").select("cell", "cluster"), "clusters")

    rest = thin.where(~F.col("core"))
    reach = rest.join(pairs, rest["cell"] == pairs["a"]).select("id", F.col("b").alias("cell")).unionByName(rest.select("id", "cell"))
    reach = reach.join(nodes, F.col("cell") == F.col("node"), "left_semi")
    asked = reach.select(F.concat_ws("|", "cell", "id").alias("tag"), F.lit(1).alias("need"), F.col("id").alias("l"), F.col("cell").alias("r"))
    alone = rest.select(F.col("id").alias("key"), "id", "x")
    touched = within_reach(materialize(asked, "borders"), alone, core_points, dims, eps, origin, side).where("found > 0")
    touched = touched.select(F.substring_index("tag", "|", 1).alias("cell"), F.expr("substring(tag, instr(tag, '|') + 1)").alias("id"))
    border = touched.join(clusters, "cell").groupBy("id").agg(F.min("cluster").alias("cluster"))
    core_cluster = join_lookup(cores.select("id", "cell"), clusters, "cell").select("id", "cluster")
    found = core_cluster.unionByName(border).withColumnRenamed("id", "stop")
    return scaled.join(found, "stop", "left").withColumn("cluster", F.coalesce(F.col("cluster").cast("int"), F.lit(-1)))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
