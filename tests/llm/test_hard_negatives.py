import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import hard_negatives as module
from quayside.llm.hard_negatives import LIMIT, Packed, hard_negatives, whole

SCHEMA = "vec_id long, embedding array<double>, label int, id string, row int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(partitions)


def wanted(rows, positives=5, negatives=10):
    clean = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: max(-LIMIT, min(LIMIT, sum(x * y for x, y in zip(a, b))))
    out = []
    for n, (anchor, v, label) in enumerate(clean):
        if anchor % 100:
            continue
        scored = [(-dot(v, w), i, other) for m, (i, w, other) in enumerate(clean) if m != n]
        for score, positive, _ in sorted(x[:3] for x in scored if x[2] == label)[:positives]:
            fit = sorted((s, i) for s, i, other in scored if other != label and 30 * -score <= 100 * -s <= 90 * -score)[:negatives]
            out += [(anchor, positive, r, i, -score, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **arguments):
    got = hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, **arguments).collect()
    return sorted(tuple(r) for r in got)


def vectors(seed, count, dims=6, labels=4):
    r = random.Random(seed)
    return [(i, [r.gauss(0.2, 0.4) for _ in range(dims)], r.randrange(labels)) for i in range(count)]


@pytest.mark.parametrize("scale", [0.5, 90.0, 4e4, 3e7, 1e12])
def test_packed_products_are_exact(scale):
    r = np.random.default_rng(3)
    rows, anchors = (whole(r.normal(0, scale, (n, 7))) for n in (41, 13))
    got = Packed(rows, anchors.min(), anchors.max()).scores(anchors)
    want = [[max(-LIMIT, min(LIMIT, sum(int(a) * int(x) for a, x in zip(p, q)))) for q in rows.tolist()] for p in anchors.tolist()]
    assert got.tolist() == want


def test_several_fields_share_an_integer():
    rows = whole(np.random.default_rng(5).normal(0, 0.3, (100, 64)))
    assert Packed(rows, rows.min(), rows.max()).fields > 1
    wide = Packed(rows * 1e9, rows.min() * 1e9, rows.max() * 1e9)
    assert not wide.exact and wide.fields > 1


def test_equals_brute_force(spark):
    rows = vectors(1, 450)
    assert found(spark, rows) == wanted(rows)
    assert found(spark, rows, positives=2, negatives=3) == wanted(rows, 2, 3)


def test_blocks_and_nested_samples(spark, monkeypatch):
    rows = vectors(2, 500, dims=4)
    for name, value in (("TASK_ROWS", 16), ("MERGED_TASKS", 1), ("SAMPLE_SHARE", 4), ("BLOCK_BYTES", 700), ("MATRIX", 50)):
        monkeypatch.setattr(module, name, value)
    assert found(spark, rows) == wanted(rows)


def test_edges(spark):
    same = [0.5, 0.25, 0.125]
    rows = [(i, same, 1 + i % 2) for i in range(250, 300)]  # copies: ties by id
    rows += [(100, same, 1), (100, same, 1), (200, [0.4], 2), (300, None, 1), (400, same, None), (500, [0.1, None], 1), (None, same, 2)]
    rows += [(600, [float("nan")], 1), (700, [float("inf"), 0.0], 1), (800, [], 2), (900, [1e9, -1e9, 1e9], 3), (901, [1e9, 1e9, 1e9], 3)]
    rows += [(902, [0.7e9, 0.2e9, 1e8], 2), (1000, [-0.5, -0.5, -0.5], 9), (-100, [0.9, 0.1, 0.3], 8), (-5, [0.8, 0.2, 0.3], 8)]
    assert found(spark, rows) == wanted(rows)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert found(spark, [(100, [0.5], 1), (2, [0.5], 2)]) == []
