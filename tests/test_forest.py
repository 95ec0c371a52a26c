import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quayside.ml import boosting, forest
from quayside.ml.boosting import BINNED_SCHEMA
from quayside.ml.forest import UNIT, Forest, ForestTrees, fit_forest, grown, times
from quayside.session import workspace_root
from quayside.sources import files

CUTS = [[float(k) for k in range(15)]] * 5


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(5)
    x = r.integers(0, 16, (2500, 5)).astype(np.uint8)
    late = (x[:, 0] + x[:, 1] * (x[:, 2] > 8) + 3 * r.normal(size=2500) > 12).astype(float)
    return x, late, np.where(late == 1, 1.37, 1.0), np.arange(2500) * 7919


@pytest.fixture(scope="module")
def bins(spark, data):
    rows = [(bytearray(v.tobytes()), float(y), float(w), int(m)) for v, y, w, m in zip(*data)]
    return spark.createDataFrame(rows, BINNED_SCHEMA).repartition(5).checkpoint()


@pytest.fixture(scope="module")
def vectors(spark, data):
    rows = [(i, *map(float, v)) for i, v in enumerate(data[0])]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double").select(
        "id", array_to_vector(F.array("a", "b", "c", "d", "e")).alias("selected")
    ).checkpoint()


def late_shares(model, vectors):
    scored = model.transform(vectors).select("id", vector_to_array("probability")[1].alias("p"), vector_to_array("rawPrediction").alias("raw"))
    rows = sorted(scored.collect())
    assert all(r["raw"][1] == pytest.approx(model.trees * r["p"]) for r in rows)
    return [r["p"] for r in rows]


def plain_shares(x, late, other, key, depth, many, width):
    """Each row's share of late weight in its leaf, by trying every split of every node by itself."""
    out = np.zeros(len(x))

    def gini(s):
        a, b = late[s].sum(), other[s].sum()
        return a * b / (a + b) if a + b else 0.0

    def node(rows, key, depth):
        a, b = late[rows].sum(), other[rows].sum()
        best = (0.0, None)
        if depth and a and b:
            for f in forest._drawn(np.array([key], dtype=np.uint64), x.shape[1], many)[0]:
                for at in range(width - 1):
                    low = x[rows, f] <= at
                    gain = gini(rows) - gini(rows[low]) - gini(rows[~low])
                    if low.any() and not low.all() and (late + other)[rows[low]].sum() and (late + other)[rows[~low]].sum() and gain > max(best[0], 1e-9 * (a + b)) * (1 + 1e-12):
                        best = (gain, (f, at, low))
        if best[1] is None:
            out[rows] = a / (a + b)
            return
        keys = forest._child_keys(np.array([key], dtype=np.uint64))
        node(rows[best[1][2]], keys[0], depth - 1)
        node(rows[~best[1][2]], keys[1], depth - 1)

    node(np.flatnonzero(late + other > 0), key, depth)
    return out


@pytest.mark.parametrize("depth", [3, 30])
def test_a_tree_equals_trying_all_splits(data, depth):
    x, label, weight, mark = (c[:400] for c in data)
    settings = Forest(1, depth)
    late, other = forest._weights(label, weight, times(mark, settings, 0))
    key = forest._root_key(settings, 0)
    part = grown(np.asfortranarray(x), late, other, key, depth, 3, 16)
    cut = part.bin.astype(float)
    leaves = forest.leaves_of(np.ascontiguousarray(x.T).astype(float), part.feature, cut, part.lower)
    used = late + other > 0
    assert part.share[leaves][used] == pytest.approx(plain_shares(x, late, other, key, depth, 3, 16)[used], abs=1e-12)


def test_the_bootstrap_has_a_mean_of_one(data):
    marks = np.arange(200_000) * 104_729
    first, second = (times(marks, Forest(2, 30), t) for t in (0, 1))
    assert abs(first.mean() - 1) < 0.01 and abs((first == 0).mean() - np.exp(-1)) < 0.01 and (first != second).mean() > 0.5


def test_same_forest_by_parts_over_several_tasks(bins, vectors, data, monkeypatch):
    settings = Forest(11, 30)
    one = fit_forest(bins, CUTS, settings)
    shares = late_shares(one, vectors)
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 300)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    many = fit_forest(bins, CUTS, settings)
    assert len(many.paths) == 2 and late_shares(many, vectors) == shares
    nodes = [sorted((r["tree"], r["nodes"]) for r in m.spark.read.parquet(*m.paths).collect()) for m in (one, many)]
    assert nodes[0] == nodes[1] and len(nodes[0]) == 11
    right = np.mean((np.array(shares) > 0.5) == (data[1] == 1))
    assert right > 0.9


def test_a_forest_of_several_broadcasts_and_storage(spark, bins, vectors, tmp_path, monkeypatch):
    model = fit_forest(bins, CUTS, Forest(5, 30))
    shares = late_shares(model, vectors)
    model.save(spark, f"{tmp_path}/trees")
    monkeypatch.setattr(forest, "MODEL_BYTES", 1)
    loaded = ForestTrees.load(spark, f"{tmp_path}/trees")
    assert len(list(loaded._groups())) == 5 and late_shares(loaded, vectors) == shares
    # Of the passes only the last one written is left.
    folder = workspace_root(spark) + f"/quayside/{spark.sparkContext.applicationId}"
    assert sum(n.startswith("votes-") for n in files.names(spark, folder)) == 1


def test_edges(spark, bins, vectors):
    assert set(late_shares(fit_forest(bins.limit(0), CUTS, Forest(2, 30)), vectors)) == {0.0}
    rows = bins.filter("label = 1")
    assert set(late_shares(fit_forest(rows, CUTS, Forest(2, 30)), vectors)) == {1.0}
    flat = late_shares(fit_forest(bins, CUTS, Forest(3, 0)), vectors)
    assert len(set(flat)) == 1 and 0 < flat[0] < 1
    alone = grown(np.zeros((4, 1), dtype=np.uint8, order="F"), np.array([UNIT, 0, 0, UNIT]), np.array([0, UNIT, UNIT, 0.0]), np.uint64(3), 30, 1, 1)
    assert alone.feature.tolist() == [-1] and alone.share.tolist() == [0.5]
