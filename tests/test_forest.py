import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor

from valuetide.operators import forest


@pytest.fixture(scope="module")
def data(spark):
    rows = spark.range(3000).selectExpr(
        "id % 997 AS x", "id % 89 AS z", "id % 7 AS u",
        "CAST(hash(id % 997) % 100 AS DOUBLE) AS y", "CAST(pmod(hash(id % 61), 2) AS DOUBLE) AS k", "1.5 AS w",
    )
    kept = VectorAssembler(inputCols=["x", "z", "u"], outputCol="features").transform(rows).persist()
    yield kept
    kept.unpersist()


def regressor(**more):
    settings = {"labelCol": "y", "numTrees": 3, "maxDepth": 30, "minInstancesPerNode": 4, "seed": 5, **more}
    return RandomForestRegressor(featureSubsetStrategy="0.67", **settings)


def texts(models):
    return [t.toDebugString.split("\n", 1)[1] for m in models for t in m.trees]


def test_trees_grown_by_levels_and_in_groups_are_those_grown_in_one_piece(data):
    whole = forest.grow_forest([regressor()], data, node_rows=10**9)
    pieces = forest.grow_forest([regressor()], data, node_rows=100)
    assert texts(pieces) == texts(whole)
    assert max(t.depth for t in whole[0].trees) > 7
    levels = forest.grow_forest([regressor(maxDepth=3)], data, node_rows=0)
    assert texts(levels) == texts(forest.grow_forest([regressor(maxDepth=3)], data))
    assert max(t.depth for t in levels[0].trees) == 3


def test_grown_forests_fit_as_well_as_spark_ml(data):
    def error(model):
        rows = model.transform(data).select("y", "prediction").toPandas()
        return float(np.mean((rows.y - rows.prediction) ** 2))

    own, other = forest.grow_forest([regressor(numTrees=20)], data)[0], regressor(numTrees=20).fit(data)
    assert error(own) < 1.1 * error(other)
    assert own.featureImportances.toArray().argmax() == other.featureImportances.toArray().argmax()


def test_classes_are_weighed_and_parts_share_a_forest(data):
    parts = [
        RandomForestClassifier(labelCol="k", weightCol="w", numTrees=n, maxDepth=6, minInstancesPerNode=9, seed=n)
        for n in (2, 3)
    ]
    models = forest.grow_forest(parts, data, node_rows=500)
    assert [m.getNumTrees for m in models] == [2, 3] and models[0].numClasses == 2
    rows = models[1].transform(data).select("k", "probability").collect()
    assert all(r["probability"].toArray().sum() == pytest.approx(1) for r in rows)
    assert np.mean([(r["probability"][1] > 0.5) == r["k"] for r in rows]) > 0.5


def test_leaves_side_by_side_with_one_prediction_become_one():
    node, inner = np.array([1, 2, 3, 4, 5, 6, 7]), np.array([True, True, True] + 4 * [False])
    stays, left = forest.pruned(node, inner, np.array([0, 0, 0, 1.0, 1.0, 0, 1.0]))
    assert stays.tolist() == [True, True, True, False, False, True, True]
    assert left.tolist() == [True, False, True] + 4 * [False]


def test_a_value_that_fills_many_bins_leaves_the_rest_to_the_others(spark):
    rows = spark.range(2000).selectExpr("IF(id < 1800, 0.0D, CAST(id AS DOUBLE)) AS x", "CAST(id % 4 AS DOUBLE) AS y")
    many, few = forest.split_points(rows, ["x", "y"], 32)
    assert 25 <= len(many) <= 31 and many[0] == 0.0
    assert few.tolist() == [0.5, 1.5, 2.5]


def test_a_forest_is_scored_and_stored_as_a_table_and_no_model_of_it_is_loaded(spark, data, monkeypatch, tmp_path):
    """Models of deep forests took the driver longer to load than the trees to grow."""
    from valuetide.operators import modeling

    def estimator(n, seed, suffix):
        return regressor(numTrees=n, seed=seed, predictionCol="p" + suffix)

    load = RandomForestRegressionModel.load
    monkeypatch.setattr(RandomForestRegressionModel, "load", lambda path: pytest.fail("a model was loaded"))
    found = modeling.fit_forest(estimator, data, 3000, 6, 5, "mean")
    scored = found.transform(data.select("x", "features"))
    modeling.PipelineModel(list(found.stages)).write().save(str(tmp_path / "pipeline"))
    own = {r["features"]: r["mean"] for r in scored.collect()}
    assert len(own) == scored.distinct().count() and sum(found.importances) == pytest.approx(1)
    monkeypatch.setattr(RandomForestRegressionModel, "load", load)
    saved = modeling.Forest(tuple(modeling.PipelineModel.load(str(tmp_path / "pipeline")).stages), "mean")
    assert sum(saved.sizes) == 6 and saved.importances == pytest.approx(found.importances)
    for r in saved.transform(data.select("features")).collect():
        assert own[r["features"]] == pytest.approx(r["mean"])


def plain_tree(growth, root, bins, times, label):
    """{node: (rows, feature, bin)}: every cut of every drawn feature weighed by itself."""
    found, waiting = {}, [(root, np.arange(len(times)))]
    purity = lambda r: forest.purity(growth, times[r].sum(), (times[r] * label[r]).sum())[1]
    while waiting:
        node, own = waiting.pop()
        best = (0.0, -1, -1)
        if times[own].sum() >= 2 * growth.leaf and np.ptp(label[own]) and node.bit_length() <= growth.depth:
            for f in forest.chosen(growth, np.array([0]), np.array([node]))[0].tolist():
                for cut in range(growth.bins - 1):
                    left = bins[own, f] <= cut
                    if min(times[own[left]].sum(), times[own[~left]].sum()) >= growth.leaf:
                        gain = purity(own[left]) + purity(own[~left]) - purity(own)
                        best = max(best, (round(gain, 9), -f, -cut))
        found[node] = (times[own].sum(), -best[1], -best[2]) if best[0] > 1e-9 else (times[own].sum(), -1, -1)
        if best[0] > 1e-9:
            left = bins[own, found[node][1]] <= found[node][2]
            waiting += [(2 * node, own[left]), (2 * node + 1, own[~left])]
    return found


@pytest.mark.parametrize("weights", [None, (0.7, 1.9)])
def test_nodes_are_those_of_a_search_of_every_cut(monkeypatch, weights):
    """Histograms of both sums at once; only cuts behind filled bins with enough rows on both sides are weighed."""
    rng = np.random.default_rng(4)
    growth = forest.Growth(1, 7, 9, 3, 6, 4, 8, 1, weights)
    bins, times = rng.integers(0, 8, (400, 6)).astype(np.uint8), rng.integers(1, 4, 400)
    bins[:, 1] = np.where(bins[:, 1] < 6, 0, 5)
    label = (rng.random(400) < bins[:, 0] / 8).astype(float) if weights else rng.integers(0, 40, 400) / 8
    weighed, whole = [], forest.purity
    monkeypatch.setattr(forest, "purity", lambda g, n, s: weighed.append(np.size(n)) or whole(g, n, s))
    found = forest.subtree(growth, 0, 1, bins, times.astype(np.uint8), label)
    cells = (found["n"] >= 2 * growth.leaf).sum() * growth.subset * growth.bins
    assert sum(weighed) < cells
    monkeypatch.setattr(forest, "purity", whole)
    own = {k: (n, f, b) for k, n, f, b in zip(*(found[c].tolist() for c in ("node", "n", "feature", "bin")))}
    assert own == plain_tree(growth, 1, bins, times, label)


def test_rows_are_led_to_the_nodes_below_the_large_ones():
    """By tables, whatever the depth and the order of nodes; nodes that do not split keep their rows."""
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 256, (500, 5)).astype(np.uint8)
    splits = {n: (int(rng.integers(5)), int(rng.integers(60, 200))) for n in (1, 2, 3, 5, 6, 11, 23)}
    rows = [{"tree": 0, "node": n, "feature": f, "bin": b} for n, (f, b) in splits.items()]
    top = forest.Top([*rows[::-1], {"tree": 0, "node": 4, "feature": -1, "bin": -1}])
    some = np.flatnonzero(rng.random(500) < 0.7)
    for tree in (0, 1):
        own = splits if tree == 0 else {}
        expected = []
        for r in some:
            node = 1
            while node in own:
                node = 2 * node + int(bins[r, own[node][0]] > own[node][1])
            expected.append(node)
        assert top.reached(tree)[top.lead(tree, bins, some)].tolist() == expected


def test_draws_by_their_first_bits_are_those_of_all_bits():
    growth = forest.Growth(3, 11, 5, 1, 2, 2, 8, 1)
    ids = np.arange(200_000)
    uniform = (forest.mixed(growth.seed, 2, ids) >> np.uint64(11)) * 2.0**-53
    assert (forest.drawn(growth, 2, ids) == np.searchsorted(forest.POISSON, uniform, side="right")).all()
    assert (forest.FIRST_BITS == 255).sum() <= len(forest.POISSON)
