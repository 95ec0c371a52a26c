"""Queries fit on all training rows; rows in blocks give the same trees however their sums are added up."""

import numpy as np
import pyarrow as pa
import pytest

from contract import keys_ml
from quayside.ml import boosting
from quayside.ml.boosting import BINNED_SCHEMA, Boosting, fit_boosted, matrix


def test_queries_fit_on_all_training_rows(lake):
    own = keys_ml.ready(lake)
    assert own.sizes["train"] > 2000  # what the queries were bounded to
    assert own.bins.count() == own.fit_on.count() == own.sizes["train"]


@pytest.fixture(scope="module")
def bins(spark):
    r = np.random.default_rng(11)
    x = r.integers(0, 9, (3000, 3)).astype(np.uint8)
    late = (x[:, 0] + x[:, 1] * (x[:, 2] > 4) + r.normal(size=3000) > 8).astype(float)
    data = [(bytearray(v.tobytes()), y, 1.0 + y, i * 7919) for i, (v, y) in enumerate(zip(x, late.tolist()))]
    return spark.createDataFrame(data, BINNED_SCHEMA).repartition(6).checkpoint(), [[float(k) for k in range(8)]] * 3


@pytest.mark.parametrize("driver_parts", [48, 1])
def test_blocks_and_left_margins_change_nothing(bins, monkeypatch, driver_parts):
    table, cuts = bins
    settings = Boosting(7, 0.3, depth=4)
    one = fit_boosted(table, cuts, settings)
    for name, value in (("PARTITION_ROWS", 600), ("BLOCK_ROWS", 200), ("KEEP_ROUNDS", 4), ("DRIVER_PARTS", driver_parts)):
        monkeypatch.setattr(boosting, name, value)
    many = fit_boosted(table, cuts, settings)
    assert all(np.array_equal(getattr(one, n), getattr(many, n)) for n in ("feature", "cut", "children", "value"))


def test_a_round_walks_one_tree_of_those_since(monkeypatch, tmp_path):
    block = boosting.Block("b", np.zeros((4, 1), dtype=np.uint8, order="F"), np.zeros(4), np.ones(4), np.arange(4), np.zeros(4))
    leaf = boosting.Tree(*(np.zeros(1, dtype=np.int32),) * 4, np.array([0.5]), np.zeros(1), np.ones(1))
    walked = []
    monkeypatch.setattr(boosting.Tree, "leaves_of", lambda self, bins: walked.append(1) or np.zeros(len(bins), dtype=np.int32))
    for folder, expected in ((str(tmp_path), [1, 2, 3]), ("", [1, 3, 6])):
        monkeypatch.setenv("SPARK_LOCAL_DIRS", folder)
        walked.clear()
        for n, sofar in enumerate(expected, 1):
            assert boosting._current_margins(block, [leaf] * n, n).tolist() == [0.5 * n] * 4 and len(walked) == sofar
    assert [p.name for p in tmp_path.iterdir()] == ["margin-b-3.npy"]


def test_matrix_of_binaries():
    column = pa.array([b"\x01\x02", b"\x03\x04", b"\x05\x06"], pa.binary())
    assert matrix(column).tolist() == [[1, 2], [3, 4], [5, 6]] and matrix(column.slice(1)).tolist() == [[3, 4], [5, 6]]
