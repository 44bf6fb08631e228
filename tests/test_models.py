import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.config import FEATURES
from stopflow.operators import histogram_trees, regression, trees
from stopflow.plans import catalog, pipelines


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        x = rng.uniform(0, 10, len(FEATURES))
        rows.append((f"S{i % 6}", i // 6, float(round(3 * x[6] + x[7] ** 2 + rng.normal(0, 1))), *map(float, x)))
    df = spark.createDataFrame(rows, "stop string, offset int, n double, " + ", ".join(f"{c} double" for c in FEATURES))
    return df.withColumn("day", F.date_add(F.lit("2025-01-01").cast("date"), F.col("offset"))).persist()


@pytest.fixture(scope="module")
def forest(table):
    model = regression.fit_model(table, regression.estimators(forest_trees=5, forest_depth=4)["forest"])
    return model, model.ensemble


def test_split_is_by_distinct_days(table):
    train, test, cut = regression.temporal_split(table)
    assert str(cut) == "2025-03-22"
    assert train.count() == 480 and test.count() == 120
    assert train.agg(F.max("day")).first()[0] < cut == test.agg(F.min("day")).first()[0]


def test_gaps_take_the_training_median(spark, table):
    holed = table.withColumn("lag7", F.when(F.col("lag7") > 3, F.col("lag7")))
    train, test, _ = regression.temporal_split(holed)
    median = np.nanmedian(train.select("lag7").toPandas()["lag7"].to_numpy(float))
    filled_train, filled_test = regression.impute(train, test)
    assert filled_train.where("lag7 IS NULL").count() == 0
    joined = filled_test.select("stop", "day", "lag7").join(test.where("lag7 IS NULL").select("stop", "day"), ["stop", "day"])
    assert [r["lag7"] for r in joined.distinct().select("lag7").distinct().collect()] == [pytest.approx(median)]


def test_metrics_equal_the_evaluator(table, forest):
    predicted = forest[0].transform(table).persist()
    got = regression.regression_metrics(predicted).first()
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(regression.evaluator(name).evaluate(predicted))


def test_tree_outputs_average_to_the_prediction(table, forest):
    model, nodes = forest
    spread = trees.tree_spread(model.transform(table), nodes, FEATURES)
    worst = spread.agg(F.max(F.abs(F.col("trees_mean") - F.col("prediction")))).first()[0]
    assert worst < 1e-9
    confidence = regression.predict(model, table).agg(F.min("confidence"), F.max("confidence")).first()
    assert 0 < confidence[0] <= confidence[1] <= 1


def test_contributions_add_up(table, forest):
    """They sum to the prediction minus one constant, the mean over the training data."""
    model, nodes = forest
    out = trees.shapley_values(model.transform(table), nodes, FEATURES)
    total = F.aggregate("shapley", F.lit(0.0), lambda s, v: s + v)
    rest = out.select((F.col("prediction") - total).alias("base")).agg(F.min("base"), F.max("base")).first()
    assert rest[1] - rest[0] < 1e-8


def test_contributions_equal_the_definition(table, forest):
    """Shapley values of the tree's conditional expectation, by all subsets."""
    _, nodes = forest
    one = trees.Ensemble(nodes.frame().query("tree == 0"))
    x = np.array([[r[c] for c in FEATURES] for r in table.select(*FEATURES).limit(3).collect()])

    def value(node, row, known):
        f = one.feature[node]
        if f < 0:
            return one.value[node]
        left, right = one.left[node], one.right[node]
        if f in known:
            return value(left if row[f] <= one.threshold[node] else right, row, known)
        weight = one.rows[[left, right]] / one.rows[node]
        return weight[0] * value(left, row, known) + weight[1] * value(right, row, known)

    used = sorted(set(one.feature[one.feature >= 0]))
    for row, got in zip(x, one.shapley(x)):
        for f in used:
            others = [u for u in used if u != f]
            want = 0.0
            for size in range(len(others) + 1):
                share = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
                for subset in itertools.combinations(others, size):
                    want += share * (value(0, row, {*subset, f}) - value(0, row, set(subset)))
            assert got[f] == pytest.approx(want, abs=1e-9)


def test_selection_follows_status_then_score(spark, table):
    train, test, _ = regression.temporal_split(table)
    train, test = regression.impute(train, test)
    models = regression.estimators(forest_trees=5, forest_depth=4, rounds=5)
    result, fitted = regression.compare_models(train, test, models)
    rows = {r["model"]: r for r in result.collect()}
    assert set(fitted) == set(rows) == {"linear", "tree", "forest", "boosted"}
    sound = [r for r in rows.values() if r["status"] == "OK"]
    chosen = [r["model"] for r in rows.values() if r["selected"]]
    assert chosen == ([max(sound, key=lambda r: r["r2_test"])["model"]] if sound else [])
    status = spark.createDataFrame([(0.99, 0.9), (0.4, 0.4), (0.9, 0.88)], "a double, b double")
    got = [r[0] for r in status.select(regression.fit_status(F.col("a"), F.col("b"))).collect()]
    assert got == ["OVERFITTING", "UNDERFITTING", "OK"]


def test_linear_model_recovers_coefficients(spark):
    rng = np.random.default_rng(0)
    rows = [(*map(float, x), float(2 + 3 * x[0] - x[5])) for x in rng.normal(size=(200, len(FEATURES)))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES) + ", n double")
    model = regression.fit_model(df, regression.estimators()["linear"])
    got = {r["feature"]: r["coefficient"] for r in regression.linear_coefficients(model).collect()}
    assert got[FEATURES[0]] == pytest.approx(3) and got[FEATURES[5]] == pytest.approx(-1) and got["intercept"] == pytest.approx(2)


def test_model_store_round_trip(spark, table, forest, tmp_path):
    model = regression.fit_model(table, regression.estimators()["tree"])
    codes = spark.createDataFrame([("100", 0)], "carrier string, carrier_index int")
    pipelines.save_model(model, codes, str(tmp_path))
    stored, stored_codes = pipelines.load_model(spark, str(tmp_path))
    assert stored.stages[0].getInputCols() == FEATURES
    assert stored_codes.collect() == codes.collect()
    a, b = (m.transform(table).agg(F.sum("prediction")).first()[0] for m in (model, stored))
    assert a == pytest.approx(b)


def test_donors_are_other_rows_and_each_gives_once(table):
    paired = regression.paired_with_donors(table.withColumn("own", F.concat_ws("|", "stop", "day")), ["own"], bucket_rows=100).collect()
    assert len(paired) == table.count() == len({r["own_other"] for r in paired})
    assert sum(r["own"] == r["own_other"] for r in paired) < 0.1 * len(paired)


def test_a_feature_constant_within_a_day_has_importance(table):
    """The weekday decides the count: all rows of a day share it, yet losing it must cost."""
    by_day = table.withColumn("weekday", F.dayofweek("day").cast("double")).withColumn("n", 100 * F.col("weekday") + F.col("lag7"))
    model = regression.fit_model(by_day, regression.estimators(forest_trees=5, forest_depth=5)["forest"])
    rise = {r["feature"]: r["rmse_rise"] for r in regression.permutation_importance(model, by_day).collect()}
    assert rise["weekday"] > 50 and rise["weekday"] == max(rise.values())


def test_saved_ensembles_predict_alike(spark, table, forest, tmp_path):
    boosted = regression.fit_model(table, regression.estimators(rounds=12)["boosted"])
    for name, model in (("forest", forest[0]), ("boosted", boosted)):
        model.save(spark, f"{tmp_path}/{name}")
        again = histogram_trees.TreeModel.load(spark, f"{tmp_path}/{name}")
        worst = model.transform(table).join(again.transform(table).select("stop", "day", F.col("prediction").alias("p")), ["stop", "day"])
        assert worst.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9
        assert sum(model.importances().values()) == pytest.approx(1) and max(model.importances(), key=model.importances().get) == FEATURES[7]


def plain_tree(bins, y, depth, least):
    """(mean of the leaf) of each row of a tree grown by trying every split of every node."""
    best = None
    if depth and len(y) >= 2 * least:
        for f in range(bins.shape[1]):
            for cut in np.unique(bins[:, f])[:-1]:
                left = bins[:, f] <= cut
                if least <= left.sum() <= len(y) - least:
                    gain = sum(part.sum() ** 2 / len(part) for part in (y[left], y[~left])) - y.sum() ** 2 / len(y)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left
    if best is None:
        return np.full(len(y), y.mean())
    out = np.empty(len(y))
    for side in (best[1], ~best[1]):
        out[side] = plain_tree(bins[side], y[side], depth - 1, least)
    return out


@pytest.mark.parametrize("local", [1 << 16, 150, 1])
def test_trees_equal_plain_ones_however_dealt(table, local):
    """One tree of all rows: rows of a node in one task, some levels by histograms, all levels by histograms."""
    binned = histogram_trees.BinnedTable(table, FEATURES, "n")
    model = histogram_trees.Boosting(rounds=1, depth=4, rate=1.0, row_share=1.1, column_share=1.0, least=5, l2=0.0, local=local).fit(binned)
    binned.release()
    rows = table.select("n", *FEATURES).toPandas()
    codes = np.column_stack([np.searchsorted(e, rows[c], "left") for c, e in zip(FEATURES, binned.edges, strict=True)])
    y = rows["n"].to_numpy()
    want = y.mean() + plain_tree(codes, y - y.mean(), 4, 5)
    got = model.ensemble.outputs(rows[FEATURES].to_numpy())[:, 0] + model.base
    assert np.allclose(got, want)


def test_dealing_does_not_change_models(table, monkeypatch):
    monkeypatch.setattr(histogram_trees, "STEP", 4)
    monkeypatch.setattr(histogram_trees, "KEEP", 8)
    x = table.select(*FEATURES).toPandas().to_numpy()
    for make in (lambda local: histogram_trees.Forest(4, 6, 3, local=local), lambda local: histogram_trees.Boosting(rounds=10, depth=3, local=local)):
        binned = histogram_trees.BinnedTable(table, FEATURES, "n")
        whole, dealt = (make(local).fit(binned).ensemble.outputs(x) for local in (1 << 16, 100))
        assert np.allclose(whole, dealt)
        binned.release()


def test_nothing_to_learn_from(table):
    binned = histogram_trees.BinnedTable(table.limit(0), FEATURES, "n")
    for estimator in (histogram_trees.Forest(2, 3), histogram_trees.Boosting(2)):
        assert {r["prediction"] for r in estimator.fit(binned).transform(table).select("prediction").distinct().collect()} == {0.0}
    binned.release()


def test_learning_curve_is_the_error_after_each_round(table):
    train, test, _ = regression.temporal_split(table)
    model = regression.fit_model(train, regression.estimators(rounds=7)["boosted"])
    curve = regression.learning_curve(model, train, test).orderBy("round").collect()
    rows = test.select("n", *FEATURES).toPandas()
    so_far = model.base + model.ensemble.outputs(rows[FEATURES].to_numpy()).cumsum(axis=1)
    want = np.sqrt(((so_far - rows[["n"]].to_numpy()) ** 2).mean(axis=0))
    assert [r["round"] for r in curve] == list(range(1, 8))
    assert np.allclose([r["rmse_test"] for r in curve], want)
    assert [r["rmse_train"] for r in curve] == sorted((r["rmse_train"] for r in curve), reverse=True)


def test_mean_contributions_count_repeated_rows(spark, table, forest):
    twice = table.unionByName(table.where("stop = 'S1'"))
    got = {r["feature"]: r["importance"] for r in regression.shapley_importance(twice, forest[1]).collect()}
    x = twice.select(*FEATURES).toPandas().to_numpy()
    assert np.allclose([got[c] for c in FEATURES], np.abs(forest[1].shapley(x)).mean(axis=0))


def test_model_queries_run_at_published_sizes(spark, folder):
    """All seven, without stand-ins; models are fitted once for all of them."""
    rows = {name: catalog.QUERIES[name](spark, folder).collect() for name in ("model_comparison", "feature_attribution", "top_factors", "learning_curve")}
    assert {r["model"] for r in rows["model_comparison"]} == {"linear", "tree", "forest", "boosted"}
    assert all(r["r2_test"] > 0.5 for r in rows["model_comparison"] if r["model"] in ("forest", "boosted"))
    shares = [r for r in rows["feature_attribution"] if r["method"].startswith("impurity")]
    for method in {r["method"] for r in shares}:
        assert sum(r["importance"] for r in shares if r["method"] == method) == pytest.approx(1, abs=1e-4)
    assert len(rows["feature_attribution"]) == 4 * len(FEATURES)
    assert len(rows["learning_curve"]) == 300
    sizes = {}
    for r in rows["top_factors"]:
        sizes.setdefault((r["stop"], r["day"]), {})[r["rank"]] = abs(r["contribution"])
    assert all(list(found) and found[1] >= found[2] >= found[3] for found in sizes.values())
    kept = {key[2]: value for key, value in catalog._KEPT.items() if key[1] == folder}
    assert len(kept["forest"].ensemble.roots) == 100 and len(kept["boosted"].ensemble.roots) == 300
    published = regression.estimators()
    assert (published["forest"].depth, published["forest"].least) == (15, 3)
    assert (published["boosted"].depth, published["boosted"].rate, published["boosted"].row_share, published["boosted"].column_share) == (6, 0.05, 0.8, 0.8)
