"""A random forest on binned columns: every tree from a bootstrap of all rows, a new draw of features at each node.

How often a row is in a tree's bootstrap (Poisson with mean one) follows from a hash of its mark, and a node's features from a hash of its
place, so trees do not depend on how rows lie in partitions; class weights are whole numbers of 2**-20, so sums are exact. Up to
PARTITION_ROWS a task has all rows and grows a few trees alone. Beyond, trees are grown a few at a time: jobs sum histograms of the nodes that
hold more rows than a task takes, then the rows of all nodes below are grouped by tree and node and grown out where they are. The trees
stay in files, a row each, and rows are scored by as many trees at once as may be broadcast, however large the forest is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.ml import boosting
from quayside.ml.boosting import MODEL_BYTES, blocked, blocks, matrix, summed
from quayside.session import new_folder
from quayside.sources import files

#: Trees that are grown side by side when rows are in many tasks.
BATCH_TREES = 8
#: Rows a bin from which sums by node and bin cost less than the order of the rows.
DENSE = 1
#: Weights are whole multiples of 1 / UNIT.
UNIT = float(1 << 20)

TREES_SCHEMA = "tree int, nodes int, feature binary, cut binary, lower binary, share binary"
PART_SCHEMA = "tree int, node int, feature binary, bin binary, lower binary, share binary"
ROWS_SCHEMA = "tree int, node int, bins binary, late double, other double"


@dataclass(frozen=True)
class Forest:
    """Sizes of a forest. Nodes are split until they hold one class, no drawn feature parts them, or `depth` is reached."""

    trees: int
    depth: int
    seed: int = 42

    def drawn_features(self, features: int) -> int:
        return max(1, math.ceil(math.sqrt(features)))


# --- hashes and draws


def _mixed(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.uint64)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _root_key(settings: Forest, tree: int) -> np.uint64:
    return _mixed(np.array([(settings.seed * 0x9E3779B97F4A7C15 + 2 * tree + 1) % 2**64], dtype=np.uint64))[0]


def _child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of both children of each node, one after the other."""
    return _mixed(np.stack([keys ^ np.uint64(0x5851F42D4C957F2D), keys ^ np.uint64(0x14057B7EF767814F)], axis=1).ravel())


def _drawn(keys: np.ndarray, features: int, many: int) -> np.ndarray:
    """Nodes x many: the features that each node may be split by, rising."""
    marks = _mixed(keys[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(marks, axis=1, kind="stable")[:, :many], axis=1)


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(15)])


def times(mark: np.ndarray, settings: Forest, tree: int) -> np.ndarray:
    """How often each row is in the bootstrap of a tree."""
    u = (_mixed(mark.astype(np.uint64) ^ _root_key(settings, tree)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.searchsorted(_POISSON, u, side="right")


def _weights(label: np.ndarray, weight: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    whole = np.rint(weight * UNIT) * count
    return np.where(label == 1, whole, 0.0), np.where(label == 1, 0.0, whole)


# --- growing


def _gain(late: np.ndarray, other: np.ndarray, all_late: np.ndarray, all_other: np.ndarray) -> np.ndarray:
    """Fall of the weighted Gini impurity by parting off (late, other); zero where a side is empty."""
    rest_late, rest_other = all_late - late, all_other - other
    here, there, both = late + other, rest_late + rest_other, all_late + all_other
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = all_late * all_other / both - late * other / here - rest_late * rest_other / there
    gain = np.where((here > 0) & (there > 0), gain, 0.0)
    return np.where(gain > 1e-9 * both, gain, 0.0)


def _best_by_bins(late: np.ndarray, other: np.ndarray, all_late: np.ndarray, all_other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best gain and its bin for each node, from sums by node and bin."""
    below = [x.cumsum(axis=1)[:, :-1] for x in (late, other)]
    if not below[0].shape[1]:
        return np.zeros(len(late)), np.zeros(len(late), dtype=np.int64)
    gain = _gain(*below, all_late[:, None], all_other[:, None])
    at = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), at], at


def _best_by_order(
    slot: np.ndarray, late: np.ndarray, other: np.ndarray, all_late: np.ndarray, all_other: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The same for many small nodes: rows in the order of node and bin, so that empty bins cost nothing."""
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    ends = np.flatnonzero(slot[1:] != slot[:-1])
    node = slot[ends] // width
    ends, node = ends[node == slot[ends + 1] // width], node[node == slot[ends + 1] // width]
    gains, at = np.zeros(len(all_late)), np.zeros(len(all_late), dtype=np.int64)
    if not len(ends):
        return gains, at
    below = [np.cumsum(x[order])[ends] - (np.cumsum(t) - t)[node] for x, t in ((late, all_late), (other, all_other))]
    gain = _gain(*below, all_late[node], all_other[node])
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    best = np.maximum.reduceat(gain, starts)
    hits = np.flatnonzero(gain == np.repeat(best, np.diff(np.r_[starts, len(node)])))
    first = hits[np.r_[True, node[hits][1:] != node[hits][:-1]]]
    gains[node[starts]], at[node[starts]] = best, slot[ends[first]] % width
    return gains, at


def _best_splits(flat, rows_all, rows, node, late, other, all_late, all_other, drawn, width):
    """Gain, feature and bin of each node's best split by its drawn features; ties go to the first."""
    nodes = len(all_late)
    best = np.zeros(nodes), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    for j in range(drawn.shape[1]):
        slot = node * width + flat[drawn[node, j] * rows_all + rows]
        if DENSE * nodes * width <= len(rows):
            sums = (np.bincount(slot, x, nodes * width).reshape(nodes, width) for x in (late, other))
            gain, at = _best_by_bins(*sums, all_late, all_other)
        else:
            gain, at = _best_by_order(slot, late, other, all_late, all_other, width)
        better = gain > best[0]
        for old, new in zip(best, (gain, drawn[:, j], at)):
            old[better] = new[better]
    return best


@dataclass
class Part:
    """A grown tree or the part of one below a node; a node's children are `lower` and the one after, a leaf's `feature` is -1."""

    feature: np.ndarray
    bin: np.ndarray
    lower: np.ndarray
    share: np.ndarray


def grown(bins: np.ndarray, late: np.ndarray, other: np.ndarray, key: np.uint64, depth: int, many: int, width: int) -> Part:
    """Grow rows out level by level, all nodes of a level at once."""
    rows_all, features = bins.shape
    flat = bins.ravel(order="F")
    rows = np.flatnonzero(late + other > 0)
    late, other = late[rows], other[rows]
    node = np.zeros(len(rows), dtype=np.int64)
    keys, place = np.array([key], dtype=np.uint64), np.array([0])
    all_late, all_other = np.array([late.sum()]), np.array([other.sum()])
    out = [[np.array([-1])], [np.array([0])], [np.array([-1])], [all_late / max(all_late[0] + all_other[0], 1.0)]]
    size = 1
    live = (all_late > 0) & (all_other > 0)
    if not live.all():
        return Part(*(np.concatenate(x) for x in out))
    for _ in range(depth):
        drawn = _drawn(keys, features, many)
        gain, feature, at = _best_splits(flat, rows_all, rows, node, late, other, all_late, all_other, drawn, width)
        split = gain > 0
        if not split.any():
            break
        number = np.cumsum(split) - 1
        for level, value in zip(out, (np.where(split, feature, -1), at, np.where(split, size + 2 * number, -1))):
            level[-1][place] = value
        stay = split[node]
        rows, late, other, node = rows[stay], late[stay], other[stay], node[stay]
        node = 2 * number[node] + (flat[feature[node] * rows_all + rows] > at[node])
        keys, children = _child_keys(keys[split]), 2 * int(split.sum())
        all_late, all_other = (np.bincount(node, x, children) for x in (late, other))
        for level, fill in zip(out, (np.full(children, -1), np.zeros(children, dtype=np.int64), np.full(children, -1), all_late / (all_late + all_other))):
            level.append(fill)
        size += children
        # What holds one class is done.
        live = (all_late > 0) & (all_other > 0)
        if not live.any():
            break
        number = np.cumsum(live) - 1
        stay = live[node]
        rows, late, other, node = rows[stay], late[stay], other[stay], number[node[stay]]
        keys, place, all_late, all_other = keys[live], np.flatnonzero(live), all_late[live], all_other[live]
    return Part(*(np.concatenate(x) for x in out))


def _tree_row(tree: int, part: Part, cuts: Sequence[np.ndarray]) -> pa.RecordBatch:
    starts, points = np.cumsum([0, *map(len, cuts)]), np.concatenate([*cuts, [0.0]])
    cut = points[np.where(part.feature >= 0, starts[part.feature] + part.bin, len(points) - 1)]
    parts = (part.feature.astype(np.int32), cut, part.lower.astype(np.int32), part.share.astype(np.float64))
    columns = [pa.array([tree], pa.int32()), pa.array([len(cut)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)]
    return pa.RecordBatch.from_arrays(columns, names=["tree", "nodes", "feature", "cut", "lower", "share"])


# --- fitting


def fit_forest(rows: DataFrame, cuts: list[list[float]], settings: Forest) -> ForestTrees:
    """A forest of binned rows."""
    spark = rows.sparkSession
    folder = new_folder(spark, "forest")
    if rows.count() <= boosting.PARTITION_ROWS:
        paths = [f"{folder}/trees"]
        _alone(rows, cuts, settings).write.parquet(paths[0])
    else:
        paths = _by_parts(rows, cuts, settings, folder)
    return ForestTrees(spark, paths, settings.trees, len(cuts))


def _alone(rows: DataFrame, cuts: list[list[float]], settings: Forest) -> DataFrame:
    """Every task has all rows, at most PARTITION_ROWS, and grows some of the trees."""
    spark = rows.sparkSession
    table = rows.select("bins", "label", "weight", "mark").toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast(table)
    width = max(map(len, cuts), default=0) + 1
    many, points = settings.drawn_features(len(cuts)), [np.array(c) for c in cuts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if not held.num_rows:
            return
        bins = np.concatenate([matrix(c) for c in held.column("bins").chunks])
        label, weight, mark = (held.column(c).to_numpy() for c in ("label", "weight", "mark"))
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                own = _weights(label, weight, times(mark, settings, tree))
                yield _tree_row(tree, grown(bins, *own, _root_key(settings, tree), settings.depth, many, width), points)

    tasks = max(1, min(settings.trees, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, settings.trees, 1, tasks).mapInArrow(run, TREES_SCHEMA)


@dataclass
class Top:
    """The upper nodes of a tree, grown by jobs."""

    tree: int
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    lower: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    key: list[np.uint64] = field(default_factory=list)
    sums: list[tuple[int, int]] = field(default_factory=lambda: [(-1, -1)])
    #: Nodes that no drawn feature parts.
    done: set[int] = field(default_factory=set)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Each row's node."""
        feature, at, lower = (np.array(x, dtype=np.int64) for x in (self.feature, self.bin, self.lower))
        node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while (moving := lower[node] >= 0).any():
            node = np.where(moving, lower[node] + (bins[rows, np.maximum(feature[node], 0)] > at[node]), node)
        return node

    def growing(self, depth: int) -> list[int]:
        """Nodes that are to be split further."""
        return [
            n for n, (late, other) in enumerate(self.sums)
            if self.lower[n] < 0 and n not in self.done and late and other and self.depth[n] < depth
        ]


def _by_parts(rows: DataFrame, cuts: list[list[float]], settings: Forest, folder: str) -> list[str]:
    """Trees in files, BATCH_TREES at a time."""
    spark = rows.sparkSession
    blocked(rows).write.option("compression", "zstd").parquet(f"{folder}/rows")
    held = spark.read.parquet(f"{folder}/rows")
    parts = held.rdd.getNumPartitions()
    least = rows.agg(F.min("weight")).first()[0]
    paths = []
    for first in range(0, settings.trees, BATCH_TREES):
        tops = [Top(t, key=[_root_key(settings, t)]) for t in range(first, min(first + BATCH_TREES, settings.trees))]
        _grow_tops(held, parts, tops, cuts, settings, boosting.PARTITION_ROWS * least * UNIT)
        paths.append(f"{folder}/trees-{first}")
        _grow_below(held, tops, cuts, settings).write.parquet(paths[-1])
    files.delete(spark, f"{folder}/rows")
    return paths


def _grow_tops(held: DataFrame, parts: int, tops: list[Top], cuts: list[list[float]], settings: Forest, enough: float) -> None:
    """Split the nodes that weigh more than `enough`, level by level, all trees at once."""
    width, features = max(map(len, cuts), default=0) + 1, len(cuts)
    many = settings.drawn_features(features)
    while True:
        open_ = [(t, [n for n in top.growing(settings.depth) if sum(top.sums[n]) > enough or top.sums[n] == (-1, -1)]) for t, top in enumerate(tops)]
        open_ = [(t, nodes, _drawn(np.array([tops[t].key[n] for n in nodes], dtype=np.uint64), features, many)) for t, nodes in open_ if nodes]
        if not open_:
            return
        found = summed(held.mapInArrow(_top_sums(tops, open_, settings, width), "sums binary"), parts, (sum(len(n) for _, n, _ in open_), many, width, 2))
        at = 0
        for t, nodes, drawn in open_:
            top = tops[t]
            for n, features_, own in zip(nodes, drawn, found[at : at + len(nodes)]):
                top.sums[n] = tuple(int(x) for x in own[0].sum(axis=0))
                if not all(top.sums[n]):
                    continue
                totals = [np.full(many, float(x)) for x in top.sums[n]]
                gain, bins = _best_by_bins(own[..., 0].astype(float), own[..., 1].astype(float), *totals)
                j = int(gain.argmax())
                if gain[j] <= 0:
                    top.done.add(n)
                    continue
                low = tuple(int(x) for x in own[j, : int(bins[j]) + 1].sum(axis=0))
                top.feature[n], top.bin[n], top.lower[n] = int(features_[j]), int(bins[j]), len(top.feature)
                top.key += list(_child_keys(np.array([top.key[n]], dtype=np.uint64)))
                for sums in (low, (top.sums[n][0] - low[0], top.sums[n][1] - low[1])):
                    top.feature.append(-1)
                    top.bin.append(0)
                    top.lower.append(-1)
                    top.depth.append(top.depth[n] + 1)
                    top.sums.append(sums)
            at += len(nodes)


def _top_sums(tops: list[Top], open_: list[tuple[int, list[int], np.ndarray]], settings: Forest, width: int):
    """mapInArrow: each task's weights by open node, drawn feature, bin and class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in blocks(batches):
            found = []
            for t, nodes, drawn in open_:
                number = np.full(len(tops[t].feature), -1, dtype=np.int64)
                number[nodes] = np.arange(len(nodes))
                count = times(block.mark, settings, tops[t].tree)
                place = number[tops[t].places(block.bins)]
                rows = np.flatnonzero((place >= 0) & (count > 0))
                node, own = place[rows], _weights(block.label[rows], block.weight[rows], count[rows])
                sums = np.zeros((len(nodes), drawn.shape[1], width, 2))
                for j in range(drawn.shape[1]):
                    slot = node * width + block.bins[rows, drawn[node, j]]
                    for k in (0, 1):
                        sums[:, j, :, k] = np.bincount(slot, own[k], len(nodes) * width).reshape(-1, width)
                found.append(sums.astype(np.int64))
            own = np.concatenate(found)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _grow_below(held: DataFrame, tops: list[Top], cuts: list[list[float]], settings: Forest) -> DataFrame:
    """The rows of each node that is not done meet in one task and are grown out; a tree's parts are then put together."""
    width, features = max(map(len, cuts), default=0) + 1, len(cuts)
    many, points = settings.drawn_features(features), [np.array(c) for c in cuts]
    wanted = [top.growing(settings.depth) for top in tops]
    number = {top.tree: i for i, top in enumerate(tops)}

    def out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            flat = np.ascontiguousarray(block.bins)
            for top, nodes in zip(tops, wanted):
                open_ = np.zeros(len(top.feature), dtype=bool)
                open_[nodes] = True
                count, place = times(block.mark, settings, top.tree), top.places(block.bins)
                rows = np.flatnonzero(open_[place] & (count > 0))
                late, other = _weights(block.label[rows], block.weight[rows], count[rows])
                offsets = pa.py_buffer((np.arange(len(rows) + 1) * features).astype(np.int32))
                bins = pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(flat[rows].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), top.tree, dtype=np.int32)), pa.array(place[rows].astype(np.int32)), bins, pa.array(late), pa.array(other)],
                    names=["tree", "node", "bins", "late", "other"],
                )

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        top = tops[number[tree]]
        bins = np.concatenate([matrix(c) for c in table.column("bins").chunks])
        own = (table.column(c).to_numpy() for c in ("late", "other"))
        part = grown(bins, *own, top.key[node], settings.depth - top.depth[node], many, width)
        parts = (part.feature.astype(np.int32), part.bin.astype(np.int32), part.lower.astype(np.int32), part.share.astype(np.float64))
        columns = [pa.array([tree], pa.int32()), pa.array([node], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)]
        return pa.table(columns, names=["tree", "node", "feature", "bin", "lower", "share"])

    def together(key: tuple, table: pa.Table) -> pa.Table:
        top = tops[number[key[0].as_py()]]
        return pa.Table.from_batches([_tree_row(top.tree, _joined(top, table), points)])

    # Trees whose upper nodes are all done have no rows below: each tree is sent once without any.
    none = held.sparkSession.createDataFrame([(top.tree, -1, b"", b"", b"", b"") for top in tops], PART_SCHEMA)
    parts = held.mapInArrow(out, ROWS_SCHEMA).groupBy("tree", "node").applyInArrow(grow, PART_SCHEMA)
    return parts.unionByName(none).groupBy("tree").applyInArrow(together, TREES_SCHEMA)


def _joined(top: Top, table: pa.Table) -> Part:
    """The upper nodes with the parts below them: a part's root takes its node's place, its other nodes follow."""
    share = [late / max(late + other, 1) for late, other in top.sums]
    out = [[np.array(top.feature)], [np.array(top.bin)], [np.array(top.lower)], [np.array(share)]]
    size = len(top.feature)
    for row in sorted(table.to_pylist(), key=lambda r: r["node"]):
        if row["node"] < 0:
            continue
        feature, bins, lower = (np.frombuffer(row[c], dtype=np.int32).astype(np.int64) for c in ("feature", "bin", "lower"))
        lower = np.where(lower >= 0, lower + size - 1, -1)
        for held, own in zip(out, (feature, bins, lower, np.frombuffer(row["share"], dtype=np.float64))):
            held[0][row["node"]] = own[0]
            held.append(own[1:])
        size += len(feature) - 1
    return Part(*(np.concatenate(x) for x in out))


# --- the model


@dataclass
class ForestTrees:
    """Trees in files. A row's probability is the mean over the trees of the share of late weight in its leaf."""

    spark: SparkSession
    paths: list[str]
    trees: int
    features: int

    def _groups(self) -> Iterator[list[tuple[np.ndarray, ...]]]:
        """The trees in their order, as many at a time as may be broadcast."""
        stored = self.spark.read.schema(TREES_SCHEMA).parquet(*self.paths)
        sizes = sorted((r["tree"], r["nodes"]) for r in stored.select("tree", "nodes").collect())  # a row per tree
        group: list[int] = []
        for i, (tree, nodes) in enumerate(sizes):
            group.append(tree)
            held = sum(n for t, n in sizes[i + 1 - len(group) : i + 1]) * 24
            if i + 1 == len(sizes) or held + sizes[i + 1][1] * 24 > MODEL_BYTES:
                table = stored.filter(F.col("tree").between(group[0], group[-1])).toArrow().sort_by("tree")
                types = (np.int32, np.float64, np.int32, np.float64)
                yield [
                    tuple(np.frombuffer(table.column(c)[k].as_buffer(), dtype=t).copy() for c, t in zip(("feature", "cut", "lower", "share"), types))
                    for k in range(table.num_rows)
                ]
                group = []

    def transform(self, df: DataFrame, features: str = "selected") -> DataFrame:
        """All columns, with rawPrediction and probability as vectors of both classes. A forest of several broadcasts takes a pass for each."""
        out, held, path = df.withColumn("_late", F.lit(0.0)), None, None
        for group in self._groups():
            if held:
                # The pass before is written with its sums; what it was made of goes.
                last, path = path, new_folder(self.spark, "votes")
                out.write.option("compression", "zstd").parquet(path)
                out = self.spark.read.schema(out.schema).parquet(path)
                held.destroy()
                if last:
                    files.delete(self.spark, last)
            out, held = _with_votes(out, group, features, self.features)
        late = F.col("_late") / F.lit(float(max(self.trees, 1)))
        return out.withColumns({
            "rawPrediction": array_to_vector(F.array(F.lit(float(self.trees)) - F.col("_late"), F.col("_late"))),
            "probability": array_to_vector(F.array(1 - late, late)),
        }).drop("_late")

    def save(self, spark: SparkSession, path: str) -> None:
        stored = spark.read.schema(TREES_SCHEMA).parquet(*self.paths)
        stored.withColumns({"trees": F.lit(self.trees), "features": F.lit(self.features)}).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestTrees:
        sizes = spark.read.parquet(path).select("trees", "features").first()
        return ForestTrees(spark, [path], *(sizes or (0, 0)))


def _with_votes(rows: DataFrame, group: list[tuple[np.ndarray, ...]], column: str, features: int) -> tuple[DataFrame, Broadcast]:
    """The rows with the shares of these trees added to `_late`, and the broadcast that holds the trees."""
    shared = rows.sparkSession.sparkContext.broadcast(group)

    @F.arrow_udf("double")
    def votes(x: pa.Array) -> pa.Array:
        flat = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), features).T)
        out = np.zeros(len(x))
        for feature, cut, lower, share in shared.value:
            out += share[leaves_of(flat, feature, cut, lower)]
        return pa.array(out)

    return rows.withColumn("_late", F.col("_late") + votes(vector_to_array(column))), shared


def leaves_of(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The leaf of each column of features x rows."""
    out, many = np.zeros(x.shape[1], dtype=np.int64), x.shape[1]
    flat, rows, node = x.ravel(), np.arange(many), np.zeros(many, dtype=np.int64)
    while len(rows):
        inner = lower[node] >= 0
        out[rows[~inner]] = node[~inner]
        rows, node = rows[inner], node[inner]
        node = lower[node] + (flat[feature[node].astype(np.int64) * many + rows] > cut[node])
    return out
