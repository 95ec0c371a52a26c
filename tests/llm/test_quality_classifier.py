import numpy as np
import pyarrow as pa
import pytest

from quayside.llm.quality_classifier import FEATURES, _sample_bags, classify, new_network, passages, train
from quayside.llm.textarrays import slices


@pytest.mark.parametrize("limit", [1, 400, 1 << 20])
def test_passages_do_not_depend_on_slices(edges, prose, limit):
    column = [t for _, t in edges] + [prose(i, 1 + 17 * i) for i in range(20)]
    whole, bounds = passages(next(slices(pa.array(column, pa.string()), 1 << 30)))
    parts = [passages(p) for p in slices(pa.array(column, pa.string()), limit)]
    assert np.allclose(np.concatenate([x for x, _ in parts]), whole)
    assert sum(len(b) - 1 for _, b in parts) == len(column) == len(bounds) - 1
    assert (np.diff(bounds) >= 1).all() and np.isfinite(whole).all()


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    x, bounds, label = r.normal(0, 1, (12, FEATURES)), np.array([0, 1, 5, 12]), np.array([1.0, 0.0, 1.0])
    net = new_network(x, 0.4)
    net.weights["score"] = r.normal(0, 1, len(net.weights["score"]))

    def loss():
        p = net.forward(x, bounds)["score"]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    for name, g in net.gradients(x, bounds, label).items():
        w = net.weights[name].reshape(-1)
        for k in r.choice(len(w), min(5, len(w)), replace=False):
            kept = w[k]
            w[k] = kept + 1e-5
            up = loss()
            w[k] = kept - 1e-5
            down = loss()
            w[k] = kept
            assert g.reshape(-1)[k] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_finds_the_one_odd_passage():
    r = np.random.default_rng(1)
    sizes = r.integers(2, 12, 300)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    x = r.normal(0, 1, (bounds[-1], FEATURES))
    label = r.integers(0, 2, 300).astype(float)
    odd = bounds[:-1][label == 0] + r.integers(0, sizes[label == 0])
    x[odd, 3] += 8
    net = train(x, bounds, label)
    f = net.forward(x, bounds)
    assert ((f["score"] >= 0.5) == (label == 1)).mean() > 0.95
    assert f["share"][odd].mean() > 2 * f["share"].mean()


def test_held_out_accuracy_and_edges(spark, documents, edges, prose):
    rows = [(i, prose(i, 40 + i) if i % 3 else prose(i, 40 + i).replace(" ", "$$$ ")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(None, 1), (2, None), (2, 0)], "doc_id long, quality int")
    got = classify(documents(rows + [(1000 + k, t) for k, (_, t) in enumerate(edges)]), labels).collect()
    assert len(got) == 300 + len(edges)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.doc_id < 300 and r.doc_id % 2]
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.97


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classify(documents([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in classify(documents([(1, "a b"), (2, None)]), one).collect())
    assert classify(documents([]), one).count() == 0


def test_the_sample_takes_one_row_of_an_id_and_stops_by_passages(spark, documents, prose):
    rows = [(7, prose(k, 100)) for k in range(300)] + [(k, prose(k, 640)) for k in range(10, 30)] + [(None, "a b")] * 50
    labels = spark.createDataFrame([(7, 1), (7, 0), (None, 1), (99, 1)] + [(k, k % 2) for k in range(10, 30)], "doc_id long, quality int")
    docs = documents(rows)
    whole = _sample_bags(docs, labels, 100, 1 << 17).collect()
    assert sorted(r.doc_id for r in whole) == [7, *range(10, 30)]
    assert {r.doc_id: len(r.bag) // 8 // FEATURES for r in whole} == {7: 2} | {k: 10 for k in range(10, 30)}
    assert [r.quality for r in whole if r.doc_id == 7] == [1]
    bounded = _sample_bags(docs, labels, 100, 35).collect()
    assert 30 <= sum(len(r.bag) // 8 // FEATURES for r in bounded) <= 35
    assert len(_sample_bags(docs, labels, 4, 1 << 17).collect()) <= 4
    assert _sample_bags(docs, labels, 100, 0).count() == 0


def test_score_equals_a_plain_version():
    r = np.random.default_rng(3)
    x, bounds = r.normal(0, 1, (30, FEATURES)), np.array([0, 1, 7, 8, 30])
    net = new_network(x, 0.3)
    net.weights["score"] = r.normal(0, 1, len(net.weights["score"]))
    w, got = net.weights, net.forward(x, bounds)["score"]
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        codes, raws = [], []
        for row in x[a:b]:
            code = np.tanh((row - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-3) @ w["encode"] + w["encode_b"])
            codes.append(code)
            raws.append(np.exp(sum(w["attend"] * np.tanh(code @ w["value"]) / (1 + np.exp(-(code @ w["gate"]))))))
        pooled = sum(e / sum(raws) * c for e, c in zip(raws, codes))
        assert got[k] == pytest.approx(1 / (1 + np.exp(-(pooled @ w["score"] + w["score_b"][0]))), abs=1e-9)
