import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quayside.ml import boosting
from quayside.ml.boosting import MAX_BINS, SCALE, BoostedTrees, Boosting, binned, column_cuts, fit_boosted, histograms
from quayside.ml.explain import LeafPaths, tree_contributions
from quayside.sources import files


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(7)
    x = np.round(r.normal(size=(1200, 4)), 2)
    x[:, 3] = r.integers(0, 3, 1200)
    late = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * (x[:, 3] == 1) + 0.5 * r.normal(size=1200) > 0).astype(float)
    data = [(i, *map(float, v), y, 1.5 if y else 1.0) for i, (v, y) in enumerate(zip(x.tolist(), late.tolist()))]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, d double, label double, weight double")
    features = array_to_vector(F.array("a", "b", "c", "d"))
    return df.withColumn("features", features).withColumn("mark", F.xxhash64("id")).select("id", "features", "label", "weight", "mark").checkpoint()


@pytest.fixture(scope="module")
def bins(rows):
    cuts = column_cuts(rows, "features", 4)
    return binned(rows, "features", cuts).checkpoint(), cuts


def same(a: BoostedTrees, b: BoostedTrees) -> bool:
    return all(np.array_equal(getattr(a, n), getattr(b, n)) for n in ("start", "feature", "cut", "children", "value", "gain", "cover"))


def plain_tree(x, g, h, depth, settings):
    """A tree by trying every split of every feature: nested (feature, bin, below, above) or the leaf's value."""
    score = lambda s: g[s].sum() ** 2 / (h[s].sum() + settings.l2)
    every = np.arange(len(x))

    def node(own, depth):
        best = (1e-9, None)
        for f, b in itertools.product(range(x.shape[1]), range(int(x.max()) + 1)):
            low, high = own[x[own, f] <= b], own[x[own, f] > b]
            if depth and len(low) and len(high) and min(h[low].sum(), h[high].sum()) >= settings.least_hessian:
                gain = score(low) + score(high) - score(own)
                if gain > best[0] + 1e-12:
                    best = (gain, (f, b, low, high))
        if best[1] is None:
            return round(-settings.learning_rate * g[own].sum() / (h[own].sum() + settings.l2), 9)
        f, b, low, high = best[1]
        return (f, b, node(low, depth - 1), node(high, depth - 1))

    return node(every, depth)


def nested(model, cuts, node=0):
    f = int(model.feature[node])
    if f < 0:
        return round(float(model.value[node]), 9)
    return (f, cuts[f].index(model.cut[node]), *(nested(model, cuts, c) for c in model.children[node].tolist()))


def test_cuts_keep_every_value_apart(rows, bins):
    table, cuts = bins
    assert all(c == sorted(set(c)) and len(c) < MAX_BINS for c in cuts) and cuts[3] == [0.0, 1.0]
    got = {r["mark"]: list(r["bins"]) for r in table.collect()}
    for r in rows.collect():
        assert got[r["mark"]] == [sum(v > c for c in own) for v, own in zip(r["features"], cuts)]


def test_first_tree_equals_trying_all_splits(rows, bins):
    table, cuts = bins
    settings = Boosting(1, 0.3, depth=3)
    held = table.toPandas()
    x = np.array([list(b) for b in held["bins"]])
    w, y = held["weight"].to_numpy(), held["label"].to_numpy()
    g, h = np.rint(w * (0.5 - y) * SCALE) / SCALE, np.rint(w * 0.25 * SCALE) / SCALE
    assert nested(fit_boosted(table, cuts, settings), cuts) == plain_tree(x, g, h, 3, settings)


def test_best_first_takes_the_largest_gains(bins):
    table, cuts = bins
    deep = fit_boosted(table, cuts, Boosting(1, 0.3, depth=12))
    gain, children = deep.gain, deep.children
    leaves, order = [0], []
    while leaves and len(order) < 9:
        best = max((n for n in leaves if deep.feature[n] >= 0), key=lambda n: (gain[n], -n))
        leaves.remove(best)
        leaves += children[best].tolist()
        order.append(round(float(gain[best]), 6))
    first = fit_boosted(table, cuts, Boosting(1, 0.3, leaves=10))
    assert sorted(round(float(g), 6) for g in first.gain[first.feature >= 0]) == sorted(order)
    many = fit_boosted(table, cuts, Boosting(3, 0.3, leaves=40))
    assert all(n <= 79 for n in np.diff(np.r_[many.start, len(many.feature)]))


@pytest.mark.parametrize("settings", [Boosting(5, 0.3, depth=4), Boosting(5, 0.3, leaves=9), Boosting(5, 0.3, depth=3, sampled=0.6)])
def test_same_trees_by_jobs_over_several_tasks(bins, monkeypatch, settings):
    table, cuts = bins
    one = fit_boosted(table, cuts, settings)
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 100)
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 2)
    assert same(one, fit_boosted(table.repartition(5), cuts, settings))


def test_a_stopped_run_goes_on(spark, bins, monkeypatch, tmp_path):
    table, cuts = bins
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 100)
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 2)
    folder, settings = f"{tmp_path}/run", Boosting(5, 0.3, depth=3)
    grown = []
    real = boosting.grow

    def failing(ask, settings):
        if len(grown) == 3:
            grown.append(None)
            raise RuntimeError("lost")
        grown.append(None)
        return real(ask, settings)

    monkeypatch.setattr(boosting, "grow", failing)
    with pytest.raises(RuntimeError, match="lost"):
        fit_boosted(table, cuts, settings, folder)
    assert files.read_text(spark, f"{folder}/rounds") == "2"
    again = fit_boosted(table, cuts, settings, folder)
    assert len(grown) == 4 + 3  # the two written rounds are not grown again
    monkeypatch.undo()
    assert same(again, fit_boosted(table, cuts, settings))


def test_scores_and_storage(spark, rows, bins, tmp_path):
    table, cuts = bins
    model = fit_boosted(table, cuts, Boosting(30, 0.3, depth=4))
    model.save(spark, f"{tmp_path}/trees")
    assert same(model, BoostedTrees.load(spark, f"{tmp_path}/trees"))
    scored = model.transform(rows, "features").select("label", "features", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("m"))
    right = 0
    for r in scored.collect():
        margin = 0.0
        for root in model.start.tolist():
            node = root
            while model.feature[node] >= 0:
                node = int(model.children[node][int(r["features"][int(model.feature[node])] > model.cut[node])])
            margin += model.value[node]
        assert r["m"][1] == pytest.approx(margin, abs=1e-12) and r["p"][1] == pytest.approx(1 / (1 + math.exp(-margin)))
        right += (margin > 0) == (r["label"] == 1)
    assert right > 1000
    assert sum(model.importances()) == pytest.approx(1) and min(model.importances()) >= 0


def test_edges(spark, bins):
    table, cuts = bins
    assert len(fit_boosted(table, cuts, Boosting(0, 0.3, depth=3)).start) == 0
    alone = fit_boosted(table.limit(1), cuts, Boosting(2, 0.3, depth=3))
    assert alone.feature.tolist() == [-1, -1]
    assert len(fit_boosted(table.limit(0), cuts, Boosting(2, 0.3, depth=3)).start) == 0
    counted = histograms(np.array([[1, 0], [1, 1], [0, 0]], dtype=np.uint8), np.array([0, 1, -1]), np.array([[2.0, 1], [3, 1], [9, 9]]), 2, 2)
    assert counted[0].tolist() == [[[0, 0], [2, 1]], [[2, 1], [0, 0]]] and counted[1].tolist() == [[[0, 0], [3, 1]], [[0, 0], [3, 1]]]


def shapley(model, x, features):
    """By all subsets of the features; those left out follow both sides by cover."""

    def expected(node, known):
        f = int(model.feature[node])
        if f < 0:
            return float(model.value[node])
        low, high = model.children[node].tolist()
        if f in known:
            return expected(high if x[f] > model.cut[node] else low, known)
        return sum(expected(c, known) * model.cover[c] for c in (low, high)) / model.cover[node]

    value = lambda s: sum(expected(root, s) for root in model.start.tolist())
    out = np.zeros(features)
    for i in range(features):
        others = [j for j in range(features) if j != i]
        for n in range(features):
            for s in itertools.combinations(others, n):
                share = math.factorial(n) * math.factorial(features - n - 1) / math.factorial(features)
                out[i] += share * (value({*s, i}) - value({*s}))
    return out, value(set())


@pytest.mark.parametrize("settings", [Boosting(6, 0.3, depth=5), Boosting(4, 0.3, leaves=30)])
def test_contributions_equal_all_subsets(rows, bins, settings):
    table, cuts = bins
    model = fit_boosted(table, cuts, settings)
    paths = LeafPaths.of(model)
    x = np.array([list(r["features"]) for r in rows.limit(70).collect()])
    got = paths.contributions(x, 4)
    assert np.abs(got.sum(axis=1) + paths.base - model.margins(x)).max() < 1e-9
    for i in range(0, 70, 10):
        want, base = shapley(model, x[i], 4)
        assert got[i] == pytest.approx(want, abs=1e-9) and paths.base == pytest.approx(base, abs=1e-9)
    parts = tree_contributions(rows.filter("id < 90"), model, ["a", "b", "c", "d"], ["id"], "features", k=2).collect()
    assert len(parts) == 180 and {r["rank"] for r in parts} == {1, 2}
    assert tree_contributions(rows.limit(0), model, ["a", "b", "c", "d"], ["id"], "features").count() == 0
