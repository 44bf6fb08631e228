import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.config import PROFILE_MEASURES, PROFILE_NAMES_K5
from stopflow.operators import centres as centres_module
from stopflow.operators import density, profiles
from stopflow.operators.centres import best_centres
from stopflow.plans import catalog
from tests.test_features import days, validations

from stopflow.operators.features import daily_counts


def random_profiles(spark, count=60, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"S{i:03d}", i % 3, *map(float, rng.normal(i % 3, 0.6, 5))) for i in range(count)]
    return spark.createDataFrame(rows, "stop string, cluster int, " + ", ".join(f"{c} double" for c in profiles.SCALED))


def brute_silhouette(points, labels):
    widths = []
    for i, p in enumerate(points):
        mean = {}
        for c in set(labels):
            others = [math.dist(p, q) ** 2 for j, q in enumerate(points) if labels[j] == c and j != i]
            if others:
                mean[c] = sum(others) / len(others)
        if labels[i] not in mean:
            widths.append(0.0)
            continue
        a, b = mean.pop(labels[i]), min(v for c, v in mean.items())
        widths.append((b - a) / max(a, b))
    return sum(widths) / len(widths)


def test_silhouette_equals_all_distances(spark):
    df = random_profiles(spark)
    alone = df.limit(1).withColumns({"stop": F.lit("ALONE"), "cluster": F.lit(7)})
    df = df.unionByName(alone).persist()
    rows = df.collect()
    want = brute_silhouette([[r[c] for c in profiles.SCALED] for r in rows], [r["cluster"] for r in rows])
    assert profiles.silhouette(df).first()["silhouette"] == pytest.approx(want)


def test_one_cluster_has_no_silhouette(spark):
    df = random_profiles(spark).withColumn("cluster", F.lit(0))
    assert profiles.silhouette(df).first()["silhouette"] is None


def test_five_names_follow_the_rules(spark):
    # cluster: volume, ratio, variation
    known = {0: (10, 0.9, 0.1), 1: (1000, 0.1, 9.0), 2: (50, 0.2, 0.2), 3: (20, 0.8, 5.0), 4: (40, 0.7, 0.3)}
    rows = [(f"S{c}{i}", c, 1.0, 1.0, r, float(v + i), x) for c, (v, r, x) in known.items() for i in range(3)]
    df = spark.createDataFrame(rows, "stop string, cluster int, weekday_mean double, weekend_mean double, weekend_ratio double, volume double, variation double")
    names = {r["cluster"]: r["profile"] for r in profiles.name_five(df).collect()}
    roles = {1: "hub", 2: "residential", 3: "irregular", 4: "large", 0: "standard"}
    assert names == {c: PROFILE_NAMES_K5[role] for c, role in roles.items()}


def test_profile_of_weekend_only_and_single_day_stops(spark):
    rows = validations(spark, {"WEEKEND": {"2025-01-04": 8, "2025-01-05": 6}, "ONE": {"2025-01-06": 5}, "ZERO": days("2025-01-06", [0, 0])})
    got = {r["stop"]: r for r in profiles.stop_profile(daily_counts(rows)).collect()}
    assert (got["WEEKEND"]["weekday_mean"], got["WEEKEND"]["weekend_mean"], got["WEEKEND"]["weekend_ratio"]) == (0.0, 7.0, 0.0)
    assert got["ONE"]["variation"] == 0.0 and got["ZERO"]["variation"] == 0.0


def test_similar_stops_never_include_the_stop_itself(spark):
    rows = [(f"S{i}", 0 if i < 9 else 1, 100 if i < 3 else i) for i in range(11)]
    df = spark.createDataFrame(rows, "stop string, cluster int, volume int")
    got = {}
    for r in profiles.similar_stops(df).collect():
        got.setdefault(r["stop"], {})[r["rank"]] = r["similar_stop"]
    for stop, cluster, _ in rows:
        others = sorted((-v, s) for s, c, v in rows if c == cluster and s != stop)[:5]
        assert [got[stop][k] for k in sorted(got[stop])] == [s for _, s in others]


@pytest.mark.parametrize("tile", [3, 512])
def test_davies_bouldin_in_tiles(spark, monkeypatch, tile):
    """Forty clusters, some far from all others; no tile holds them all."""
    monkeypatch.setattr(profiles, "TILE", tile)
    rng = np.random.default_rng(4)
    centres = rng.uniform(-4, 4, (40, 5)) * np.where(np.arange(40) % 7 == 0, 10, 1)[:, None]
    rows = [(f"S{i}", i % 40, *map(float, centres[i % 40] + rng.normal(0, 0.3 + i % 3, 5))) for i in range(400)]
    df = spark.createDataFrame(rows, "stop string, cluster int, " + ", ".join(f"{c} double" for c in profiles.SCALED))
    x, label = np.array([r[2:] for r in rows]), np.array([r[1] for r in rows])
    means = np.array([x[label == k].mean(axis=0) for k in range(40)])
    spread = np.array([np.linalg.norm(x[label == k] - means[k], axis=1).mean() for k in range(40)])
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(means[i] - means[j]) for j in range(40) if j != i) for i in range(40)]
    assert profiles.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))
    assert profiles.davies_bouldin(df.where("cluster = 1")).first()[0] is None


def brute_density(points, eps, min_points):
    near = {a: {b for b in points if math.dist(points[a], points[b]) <= eps} for a in points}
    core = {a for a in points if len(near[a]) >= min_points}
    label, groups = {}, []
    for start in sorted(core):
        if start in label:
            continue
        group, queue = len(groups), [start]
        groups.append(group)
        while queue:
            a = queue.pop()
            if label.setdefault(a, group) == group and a in core:
                queue += [b for b in near[a] & core if b not in label]
    border = {a: {label[b] for b in near[a] & core} for a in points if a not in core}
    return core, label, border


@pytest.mark.parametrize("few, cut, dims", [(32, 8, 5), (1, 2, 2)])
def test_density_equals_brute_force(spark, monkeypatch, few, cut, dims):
    """The same partition of core points, borders and noise; boxes of one point at a time are cut many times."""
    monkeypatch.setattr(density, "FEW", few)
    monkeypatch.setattr(density, "CUT", cut)
    rng = np.random.default_rng(3)
    # A third of all points in one tight spot, a long chain, a loose cloud.
    spot, chain = rng.normal(0, 0.05, (40, dims)), np.zeros((40, dims))
    chain[:, 0] = np.linspace(4, 16, 40)
    cloud = rng.uniform(-6, 6, (40, dims))
    cloud[:, 1] -= 12
    points = {f"P{i:03d}": tuple(map(float, x)) for i, x in enumerate(np.vstack([spot, chain, cloud]))}
    columns = [f"x{i}" for i in range(dims)]
    df = spark.createDataFrame([(k, *v) for k, v in points.items()], "stop string, " + ", ".join(f"{c} double" for c in columns))
    eps = 0.8
    got = {r["stop"]: r["cluster"] for r in density.density_clusters(df, columns, eps, 4).collect()}
    core, label, border = brute_density(points, eps, 4)
    for a, b in itertools.combinations(sorted(core), 2):
        assert (got[a] == got[b]) == (label[a] == label[b])
    to_ours = {label[a]: got[a] for a in core}
    for a, choices in border.items():
        assert got[a] in ({to_ours[c] for c in choices} if choices else {-1})


def test_hierarchy_reaches_k(spark):
    df = profiles.with_vector(random_profiles(spark).drop("cluster"))
    assert profiles.hierarchical(df, 3).select("cluster").distinct().count() == 3


def test_more_clusters_never_cost_more(spark):
    df = profiles.with_vector(random_profiles(spark).drop("cluster")).persist()
    best = best_centres(df, profiles.SCALED, [2, 3, 4], 4, 1)
    assert best[2].cost >= best[3].cost >= best[4].cost
    for k, centres in best.items():
        rows = centres.transform(df).collect()
        x, label = np.array([[r[c] for c in profiles.SCALED] for r in rows]), np.array([r["cluster"] for r in rows])
        distances = ((x[:, None] - centres.points[None]) ** 2).sum(axis=2)
        assert (label == distances.argmin(axis=1)).all() and set(label) == set(range(k))
        assert centres.cost == pytest.approx(distances.min(axis=1).sum())
        # Every centre is the mean of its rows: no set stopped before it came to rest.
        assert np.allclose(centres.points, [x[label == i].mean(axis=0) for i in range(k)], atol=1e-3)


def test_starts_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(centres_module, "SAMPLE", 20)
    df = random_profiles(spark, 200).drop("cluster")
    a, b = (best_centres(df.repartition(n), profiles.SCALED, [3], 2, 7)[3] for n in (1, 5))
    assert np.allclose(a.points, b.points)
    same = best_centres(df.limit(1).unionByName(df.limit(1)), profiles.SCALED, [2], 1, 0)[2]
    assert same.cost == 0


def test_standardized_columns_have_unit_population_variance(spark):
    rng = np.random.default_rng(0)
    rows = [(f"S{i}", *map(float, rng.normal(5, 3, 4)), 2.0) for i in range(50)]
    df = spark.createDataFrame(rows, "stop string, " + ", ".join(f"{c} double" for c in PROFILE_MEASURES))
    out = profiles.standardize(df).agg(*[F.stddev_pop(c).alias(c) for c in profiles.SCALED]).first()
    assert [out[c] for c in profiles.SCALED[:4]] == pytest.approx([1.0] * 4)
    assert out[profiles.SCALED[4]] == 0.0


def test_profiles_are_built_from_counts_alone(spark, folder):
    counts, daily = catalog._supplier_counts(spark, folder), catalog._supplier_daily(spark, folder)
    assert sorted(counts.collect()) == sorted(daily.select("stop", "day", "n").collect())
    seen = []
    profiles_of = profiles.stop_profile
    try:
        profiles.stop_profile = lambda df: seen.append(df.columns) or profiles_of(df)
        catalog._vectors(spark, folder)
    finally:
        profiles.stop_profile = profiles_of
    assert seen == [["stop", "day", "n"]]
