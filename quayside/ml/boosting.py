"""Boosted trees on binned columns, grown depth by depth or best leaf first.

Rows are stored once as bins of at most MAX_BINS values a column. A tree asks for histograms of gradients by node, column and bin, and
only for the smaller child of each split: the other is its parent's less that. Gradients are whole numbers of 2**-24, so sums
are exact and the trees do not depend on how rows lie in partitions. Best-first growth asks for all leaves at once that could still be
split within the number of leaves, so a tree takes about as many questions as it is deep.

While rows fit one partition (`PARTITION_ROWS`), a single task runs all rounds over its rows. Beyond that each question is one
Spark job that sums histograms over all partitions, whose rows lie in blocks of BLOCK_ROWS, column after column; margins and trees are written
every `KEEP_ROUNDS` rounds, where a stopped run goes on. Within these rounds a task leaves a block's margins in the executor's own scratch
folder, so that a round walks one tree; margins that are not there (another executor, a lost file) are walked again from the written ones.
(Exchanging histograms inside one barrier stage was measured first: `allGather` takes about a second however small the message.)
A model's size is bounded by rounds and leaves, not by rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import new_folder
from quayside.sources import files

#: Rows of a partition that a boosting round reads (as many as one task takes alone), of a block, and most bins of a column.
PARTITION_ROWS = 1_000_000
BLOCK_ROWS = 100_000
MAX_BINS = 64
#: Partitions whose sums the driver adds up itself; those of more are added up in a shuffle.
DRIVER_PARTS = 48
#: Rounds between two written states of a run over several partitions.
KEEP_ROUNDS = 20
#: Gradients are whole multiples of 1 / SCALE.
SCALE = float(1 << 24)
#: Bytes of a model that may be broadcast.
MODEL_BYTES = 256 << 20

TREE_SCHEMA = "tree int, node int, feature int, cut double, lower int, higher int, value double, gain double, cover double"
BINNED_SCHEMA = "bins binary, label double, weight double, mark long"
BLOCK_SCHEMA = "block string, rows int, bins binary, label binary, weight binary, mark binary, margin binary"


@dataclass(frozen=True)
class Boosting:
    """Sizes of a boosted model. Without `leaves` a tree grows level by level to `depth`."""

    rounds: int
    learning_rate: float
    depth: int | None = None
    leaves: int | None = None
    sampled: float = 1.0
    l2: float = 1.0
    least_hessian: float = 1.0
    seed: int = 42


# --- growing a tree


@dataclass
class Growing:
    """A tree in growth; nodes are numbered as they appear. `split` holds the best known split of a node."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    lower: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    sums: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    gain: list[float] = field(default_factory=lambda: [0.0])
    split: list[tuple[int, int, int, int] | None] = field(default_factory=lambda: [None])

    def open(self, node: int) -> int:
        """Split a node at its best place; its children are `lower` and the node after it."""
        feature, at, g, h = self.split[node]
        first = len(self.feature)
        self.feature[node], self.bin[node], self.lower[node] = feature, at, first
        total = self.sums[node]
        for sums in ((g, h), (total[0] - g, total[1] - h)):
            self.feature.append(-1)
            self.bin.append(0)
            self.lower.append(-1)
            self.depth.append(self.depth[node] + 1)
            self.sums.append(sums)
            self.gain.append(0.0)
            self.split.append(None)
        return first


def best_splits(histograms: np.ndarray, settings: Boosting) -> list[tuple[float, tuple[int, int, int, int] | None]]:
    """Gain and (feature, bin, gradient and hessian below) of the best split of each node; ties go to the first."""
    sums = histograms.cumsum(axis=2)
    total, below = sums[:, 0, -1], sums[:, :, :-1]
    if not below.shape[2]:
        return [(0.0, None)] * len(histograms)
    g, h = below[..., 0] / SCALE, below[..., 1] / SCALE
    all_g, all_h = (total[:, k][:, None, None] / SCALE for k in (0, 1))
    other_g, other_h = all_g - g, all_h - h
    gain = g * g / (h + settings.l2) + other_g * other_g / (other_h + settings.l2) - all_g * all_g / (all_h + settings.l2)
    gain[(h < settings.least_hessian) | (other_h < settings.least_hessian)] = 0.0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    out = []
    for i, place in enumerate(at.tolist()):
        feature, bin_ = divmod(place, below.shape[2])
        own = float(flat[i, place])
        sums = below[i, feature, bin_]
        out.append((own, (feature, bin_, int(sums[0]), int(sums[1]))) if own > 1e-9 else (0.0, None))
    return out


def _next_splits(tree: Growing, settings: Boosting) -> tuple[list[int], list[int]]:
    """Nodes split so far in the order of growth, and those to be opened before that order is known further."""
    able = lambda n: tree.split[n] is not None and (settings.depth is None or tree.depth[n] < settings.depth)
    chosen, unknown, leaves = [], [], [0] if able(0) else []
    budget = (settings.leaves or 1 << 30) - 1
    while leaves and len(chosen) < budget:
        best = max(leaves, key=lambda n: (tree.gain[n], -n)) if settings.leaves else leaves[0]
        leaves.remove(best)
        chosen.append(best)
        if tree.lower[best] < 0:
            unknown.append(best)
        else:
            leaves += [n for n in (tree.lower[best], tree.lower[best] + 1) if able(n)]
    return chosen, unknown


def grow(ask: Callable[[Growing, list[int], list[int]], np.ndarray], settings: Boosting) -> tuple[Growing, list[int]]:
    """A tree and the nodes of it that are split. `ask(tree, opened, nodes)` gives histograms of nodes below those just opened."""
    tree = Growing()
    known = {0: ask(tree, [], [0])[0]}
    tree.sums[0] = tuple(int(x) for x in known[0][0].sum(axis=0))
    tree.gain[0], tree.split[0] = best_splits(known[0][None], settings)[0]
    while True:
        chosen, unknown = _next_splits(tree, settings)
        if not unknown:
            return tree, chosen
        pairs = []
        for node in unknown:
            first = tree.open(node)
            smaller = first if tree.sums[first][1] <= tree.sums[first + 1][1] else first + 1
            pairs.append((node, smaller, 2 * first + 1 - smaller))
        # What cannot be split any more needs no histogram; the larger child can be if the smaller one can.
        splittable = lambda n: tree.sums[n][1] >= 2 * settings.least_hessian * SCALE
        pairs = [p for p in pairs if splittable(p[2]) and (settings.depth is None or tree.depth[p[1]] < settings.depth)]
        found = ask(tree, unknown, [smaller for _, smaller, _ in pairs])
        if not pairs:
            continue
        for (node, smaller, larger), own in zip(pairs, found):
            known[smaller], known[larger] = own, known.pop(node) - own
        fresh = [n for _, smaller, larger in pairs for n in (smaller, larger) if splittable(n)]
        for node, (gain, split) in zip(fresh, best_splits(np.stack([known[n] for n in fresh]), settings)):
            tree.gain[node], tree.split[node] = gain, split


@dataclass
class Tree:
    """A finished tree in arrays; a leaf's children are itself."""

    feature: np.ndarray
    bin: np.ndarray
    lower: np.ndarray
    higher: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @staticmethod
    def of(tree: Growing, chosen: list[int], settings: Boosting) -> tuple[Tree, np.ndarray]:
        """The tree of the chosen splits, and for each grown node the node of the tree that holds its rows."""
        kept, holder = [0], np.zeros(len(tree.feature), dtype=np.int32)
        split = set(chosen)
        number = {0: 0}
        for node in range(len(tree.feature)):  # children come after their parents
            first = tree.lower[node]
            if first < 0:
                continue
            for child in (first, first + 1):
                if node in split:
                    number[child] = len(kept)
                    holder[child] = len(kept)
                    kept.append(child)
                else:
                    holder[child] = holder[node]
        sums = np.array([tree.sums[n] for n in kept], dtype=np.float64) / SCALE
        inner = np.array([n in split for n in kept])
        own = np.arange(len(kept), dtype=np.int32)
        lower = np.array([number[tree.lower[n]] if n in split else i for i, n in enumerate(kept)], dtype=np.int32)
        higher = np.where(inner, lower + 1, own).astype(np.int32)
        feature = np.where(inner, [max(tree.feature[n], 0) for n in kept], 0).astype(np.int32)
        bins = np.where(inner, [tree.bin[n] for n in kept], 255).astype(np.int32)
        value = np.where(inner, 0.0, -settings.learning_rate * sums[:, 0] / (sums[:, 1] + settings.l2))
        gain = np.where(inner, [tree.gain[n] for n in kept], 0.0)
        return Tree(feature, bins, lower, higher, value, gain, sums[:, 1]), holder

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """Each row's leaf."""
        node = np.zeros(len(bins), dtype=np.int32)
        rows = np.arange(len(bins))
        while True:
            after = np.where(bins[rows, self.feature[node]] <= self.bin[node], self.lower[node], self.higher[node])
            if (after == node).all():
                return node
            node = after


# --- rows


def drawn(mark: np.ndarray, round_: int, settings: Boosting) -> np.ndarray:
    """Rows that take part in a round, by a hash of their mark."""
    if settings.sampled >= 1:
        return np.ones(len(mark), dtype=bool)
    x = mark.astype(np.uint64) ^ np.uint64((round_ * 0x9E3779B97F4A7C15 + settings.seed) % 2**64)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53 < settings.sampled


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whole gradient and hessian of the weighted logistic loss; zero for rows that take no part."""
    p = 1.0 / (1.0 + np.exp(-margin))
    both = np.stack([weight * (p - label), weight * p * (1.0 - p)]) * SCALE
    return np.rint(both * part).T


def histograms(bins: np.ndarray, place: np.ndarray, grads: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Sums of gradients by node, feature and bin of the rows whose `place` is a node's number (others: -1)."""
    rows, features, size = np.flatnonzero(place >= 0), bins.shape[1], nodes * width
    first = place[rows].astype(np.int64) * width
    sums = [np.ascontiguousarray(grads[rows, k], dtype=np.float64) for k in (0, 1)]
    out = np.empty((features, 2, size))
    # Feature by feature: columns are read in one run, and the sums of one feature stay in the processor's cache.
    for f in range(features):
        slots = first + bins[:, f][rows]
        for k in (0, 1):
            out[f, k] = np.bincount(slots, sums[k], size)
    return np.ascontiguousarray(np.rint(out).astype(np.int64).reshape(features, 2, nodes, width).transpose(2, 0, 3, 1))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows x features of a column of equally long binaries, column after column in memory."""
    if not len(column):
        return np.zeros((0, 0), dtype=np.uint8)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return np.asfortranarray(flat.reshape(len(column), -1))


class _Rows:
    """Binned rows of one task, and where they are in the tree that grows."""

    def __init__(self, batches: Iterable[pa.RecordBatch], width: int) -> None:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        self.bins = np.asfortranarray(np.concatenate([matrix(c) for c in table.column("bins").chunks]))
        self.label, self.weight, self.mark = (table.column(c).to_numpy() for c in ("label", "weight", "mark"))
        self.margin = np.zeros(table.num_rows)
        self.width = width

    def start(self, round_: int, settings: Boosting) -> None:
        self.node = np.zeros(len(self.bins), dtype=np.int32)
        self.grads = gradients(self.margin, self.label, self.weight, drawn(self.mark, round_, settings))

    def ask(self, tree: Growing, opened: list[int], wanted: list[int]) -> np.ndarray:
        if opened:
            first = np.full(len(tree.feature), -1, dtype=np.int32)
            first[opened] = [tree.lower[n] for n in opened]
            rows = np.flatnonzero(first[self.node] >= 0)
            own = self.node[rows]
            feature, at = np.array(tree.feature)[own], np.array(tree.bin)[own]
            self.node[rows] = first[own] + (self.bins[rows, feature] > at)
        number = np.full(len(tree.feature), -1, dtype=np.int32)
        number[wanted] = np.arange(len(wanted))
        return histograms(self.bins, number[self.node], self.grads, len(wanted), self.width)


def _tree_rows(number: int, tree: Tree, cuts: Sequence[Sequence[float]]) -> pa.RecordBatch:
    n = len(tree.feature)
    inner = tree.lower != np.arange(n)
    cut = [cuts[f][b] if i else 0.0 for f, b, i in zip(tree.feature.tolist(), tree.bin.tolist(), inner.tolist())]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, number, dtype=np.int32)), pa.array(np.arange(n, dtype=np.int32)),
            pa.array(np.where(inner, tree.feature, -1).astype(np.int32)), pa.array(cut, pa.float64()), pa.array(tree.lower), pa.array(tree.higher),
            pa.array(tree.value), pa.array(tree.gain), pa.array(tree.cover),
        ],
        names=["tree", "node", "feature", "cut", "lower", "higher", "value", "gain", "cover"],
    )


# --- fitting


def column_cuts(rows: DataFrame, features: str, count: int) -> list[list[float]]:
    """Rising cut points of each feature: at most MAX_BINS - 1 values, none of them the largest."""
    x = vector_to_array(features)
    shares = [(i + 1) / MAX_BINS for i in range(MAX_BINS)]
    found = rows.agg(*[F.percentile_approx(x[i], shares, 10_000).alias(f"c{i}") for i in range(count)]).first()
    return [sorted(set(found[i] or []))[:-1] for i in range(count)]


def binned(rows: DataFrame, features: str, cuts: list[list[float]]) -> DataFrame:
    """bins (one byte a feature), label, weight and mark of rows with a vector of features."""
    points = [np.array(c) for c in cuts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(points))
            bins = np.stack([np.searchsorted(p, x[:, i], side="left") for i, p in enumerate(points)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in bins], pa.binary()), *(batch.column(c) for c in ("label", "weight", "mark"))],
                names=["bins", "label", "weight", "mark"],
            )

    return rows.select(vector_to_array(features).alias("x"), "label", "weight", "mark").mapInArrow(run, BINNED_SCHEMA)


def fit_boosted(rows: DataFrame, cuts: list[list[float]], settings: Boosting, folder: str | None = None) -> BoostedTrees:
    """A model of binned rows. A `folder` of an earlier, stopped run of the same rows and settings is where this one goes on."""
    spark = rows.sparkSession
    width = max(map(len, cuts), default=0) + 1
    total = rows.count()
    if total <= PARTITION_ROWS:
        table = rows.coalesce(1).mapInArrow(_all_rounds(cuts, width, settings), TREE_SCHEMA).toArrow()
    else:
        cores = spark.sparkContext.defaultParallelism
        parts = min(max(-(-total // PARTITION_ROWS), cores), max(DRIVER_PARTS, 2 * cores))
        table = _by_jobs(rows.coalesce(parts), cuts, width, settings, folder or new_folder(spark, "boosting"))
    return BoostedTrees.of(table, len(cuts))


def _all_rounds(cuts: list[list[float]], width: int, settings: Boosting):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = _Rows(held, width)
        for round_ in range(settings.rounds):
            rows.start(round_, settings)
            tree, holder = Tree.of(*grow(rows.ask, settings), settings)
            rows.margin += tree.value[holder[rows.node]]
            yield _tree_rows(round_, tree, cuts)

    return run


@dataclass
class Block:
    """Binned rows that lie together."""

    name: str
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    mark: np.ndarray
    margin: np.ndarray


def blocked(rows: DataFrame) -> DataFrame:
    """Binned rows as blocks of BLOCK_ROWS, with margins of zero."""
    # Names differ between attempts of a task, so scratch files of a lost attempt are never taken for those of another.
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            bins = np.concatenate([matrix(b.column("bins")) for b in held])
            label, weight, mark = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("label", "weight", "mark"))
            held.clear()
            return _block_row(Block(uuid.uuid4().hex, bins, label, weight, mark, np.zeros(len(label))))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield out()
        if held:
            yield out()

    return rows.select("bins", "label", "weight", "mark").mapInArrow(run, BLOCK_SCHEMA)


def _block_row(block: Block) -> pa.RecordBatch:
    parts = (block.bins.tobytes(order="F"), *(np.ascontiguousarray(getattr(block, c)).tobytes() for c in ("label", "weight", "mark", "margin")))
    columns = [pa.array([block.name]), pa.array([len(block.label)], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)]
    return pa.RecordBatch.from_arrays(columns, names=["block", "rows", "bins", "label", "weight", "mark", "margin"])


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            name, rows, bins, *numbers = (batch.column(c)[i] for c in range(batch.num_columns))
            types = (np.float64, np.float64, np.int64, np.float64)
            yield Block(
                name.as_py(), np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape((rows.as_py(), -1), order="F"),
                *(np.frombuffer(x.as_buffer(), dtype=t) for x, t in zip(numbers, types)),
            )


class _Asked:
    """Histograms by Spark jobs over blocks with a stored margin and the trees since."""

    def __init__(self, spark: SparkSession, folder: str, width: int, features: int, settings: Boosting) -> None:
        self.spark, self.folder, self.width, self.features, self.settings = spark, folder, width, features, settings
        self.since: list[Tree] = []
        self.round = 0
        self._read: tuple[str, DataFrame, int] | None = None

    @property
    def state(self) -> tuple[DataFrame, int]:
        """The written blocks, and in how many partitions they are read."""
        path = f"{self.folder}/rows-{self.round - len(self.since)}"
        if self._read is None or self._read[0] != path:
            rows = self.spark.read.parquet(path)
            self._read = path, rows, rows.rdd.getNumPartitions()
        return self._read[1:]

    def ask(self, tree: Growing, opened: list[int], wanted: list[int]) -> np.ndarray:
        shape = (len(wanted), self.features, self.width, 2)
        if not wanted:
            return np.zeros(shape, dtype=np.int64)
        run = _node_sums(self.since, self.round, tree, wanted, self.width, self.settings)
        rows, parts = self.state
        return summed(rows.mapInArrow(run, "sums binary"), parts, shape)


def summed(sums: DataFrame, parts: int, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the arrays of 64-bit whole numbers that tasks return, one each."""
    if parts > DRIVER_PARTS:
        many = int(np.prod(shape))

        def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in batch.column("sums"):
                    own = np.frombuffer(x.as_buffer(), dtype=np.int64)
                    at = np.flatnonzero(own)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], names=["slot", "sum"])

        found = sums.mapInArrow(slots, "slot long, sum long").groupBy("slot").agg(F.sum("sum").alias("sum")).toArrow()
        out = np.zeros(many, dtype=np.int64)
        out[found.column("slot").to_numpy()] = found.column("sum").to_numpy()
        return out.reshape(shape)
    out = np.zeros(shape, dtype=np.int64)
    for x in sums.toArrow().column("sums"):
        out += np.frombuffer(x.as_buffer(), dtype=np.int64).reshape(shape)
    return out


def _margins(since: list[Tree], bins: np.ndarray, margin: np.ndarray) -> np.ndarray:
    margin = margin.copy()
    for tree in since:
        margin += tree.value[tree.leaves_of(bins)]
    return margin


def _scratch(block: Block, round_: int) -> str | None:
    """A file below the executor's scratch folder, which goes with the executor."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return f"{folder}/margin-{block.name}-{round_}.npy" if folder and os.path.isdir(folder) else None


def _current_margins(block: Block, since: list[Tree], round_: int) -> np.ndarray:
    """A block's margins after the trees before this round: left by an earlier task, or walked from the latest that are there."""
    for back in range(len(since) + 1):
        path = _scratch(block, round_ - back) if back < len(since) else None
        if path:
            try:
                held = np.load(path)
            except (OSError, ValueError, EOFError):
                continue
        elif back < len(since):
            continue
        else:
            held = block.margin
        margin = _margins(since[len(since) - back :], block.bins, held)
        own = _scratch(block, round_)
        if back and own:
            try:
                part = f"{own}.{uuid.uuid4().hex}"
                with open(part, "wb") as file:
                    np.save(file, margin)
                os.replace(part, own)
                if path:
                    os.unlink(path)
            except OSError:  # the next task walks the trees again
                pass
        return margin
    raise AssertionError


def _with_margins(since: list[Tree], round_: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            block.margin = _current_margins(block, since, round_)
            yield _block_row(block)
            if path := _scratch(block, round_):
                try:
                    os.unlink(path)
                except OSError:
                    pass

    return run


def _node_sums(since: list[Tree], round_: int, tree: Growing, wanted: list[int], width: int, settings: Boosting):
    """mapInArrow: each task's sums of the nodes asked for."""
    feature, at, lower = (np.array(x, dtype=np.int32) for x in (tree.feature, tree.bin, tree.lower))
    number = np.full(len(feature), -1, dtype=np.int32)
    number[wanted] = np.arange(len(wanted))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in blocks(batches):
            bins, margin = block.bins, _current_margins(block, since, round_)
            grads = gradients(margin, block.label, block.weight, drawn(block.mark, round_, settings))
            node, rows = np.zeros(len(bins), dtype=np.int32), np.arange(len(bins))
            while (moving := lower[node] >= 0).any():
                node = np.where(moving, lower[node] + (bins[rows, np.maximum(feature[node], 0)] > at[node]), node)
            own = histograms(bins, number[node], grads, len(wanted), width)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _by_jobs(rows: DataFrame, cuts: list[list[float]], width: int, settings: Boosting, folder: str) -> pa.Table:
    """All rounds, one job for each question; rows with margins and trees are written every KEEP_ROUNDS rounds."""
    spark = rows.sparkSession
    asked = _Asked(spark, folder, width, len(cuts), settings)
    done = (files.read_text(spark, f"{folder}/rounds") or "").split()
    if not done:
        blocked(rows).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/rows-0")
    asked.round = int(done[-1]) if done else 0
    fresh: list[pa.RecordBatch] = []
    while asked.round < settings.rounds:
        tree, _ = Tree.of(*grow(asked.ask, settings), settings)
        fresh.append(_tree_rows(asked.round, tree, cuts))
        asked.since.append(tree)
        asked.round += 1
        if len(asked.since) == KEEP_ROUNDS or asked.round == settings.rounds:
            state, _ = asked.state
            state.mapInArrow(_with_margins(asked.since, asked.round), BLOCK_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/rows-{asked.round}")
            spark.createDataFrame(pa.Table.from_batches(fresh)).write.mode("overwrite").parquet(f"{folder}/trees-{asked.round}")
            done.append(str(asked.round))
            files.replace_text(spark, f"{folder}/rounds", " ".join(done))
            # A run goes on from its last state, so the one before goes; the trees stay.
            files.delete(spark, f"{folder}/rows-{asked.round - len(asked.since)}")
            asked.since, fresh = [], []
    files.delete(spark, f"{folder}/rows-{asked.round}")
    return spark.read.schema(TREE_SCHEMA).parquet(*(f"{folder}/trees-{n}" for n in done)).toArrow()


# --- the model


@dataclass
class BoostedTrees:
    """Trees one after the other; children are places in the arrays, a leaf's are itself."""

    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    children: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    features: int

    @staticmethod
    def of(table: pa.Table, features: int) -> BoostedTrees:
        table = table.sort_by([("tree", "ascending"), ("node", "ascending")])
        tree, node, feature, cut, lower, higher, value, gain, cover = (table.column(i).to_numpy() for i in range(9))
        start = np.flatnonzero(node == 0)
        base = np.repeat(start, np.diff(np.r_[start, len(node)])) if len(start) else start
        children = np.stack([lower + base, higher + base], axis=1).astype(np.int64)
        model = BoostedTrees(start, feature.astype(np.int64), cut, children, value, gain, cover, features)
        size = sum(x.nbytes for x in (model.feature, model.cut, model.children, model.value))
        if size > MODEL_BYTES:
            raise ValueError(f"a model of {size} bytes is over the bound of {MODEL_BYTES} for a broadcast")
        return model

    def table(self) -> pa.Table:
        sizes = np.diff(np.r_[self.start, len(self.feature)])
        base = np.repeat(self.start, sizes)
        tree = np.repeat(np.arange(len(self.start)), sizes)
        columns = {
            "tree": tree.astype(np.int32), "node": (np.arange(len(base)) - base).astype(np.int32), "feature": self.feature.astype(np.int32),
            "cut": self.cut, "lower": (self.children[:, 0] - base).astype(np.int32), "higher": (self.children[:, 1] - base).astype(np.int32),
            "value": self.value, "gain": self.gain, "cover": self.cover,
        }
        return pa.table(columns)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves' values, rows x features -> rows."""
        out = np.zeros(len(x))
        feature, children = np.maximum(self.feature, 0), self.children.ravel()
        for first in range(0, len(x), 8192):
            part = np.ascontiguousarray(x[first : first + 8192].T)
            flat, rows = part.ravel(), np.arange(part.shape[1])
            total = np.zeros(part.shape[1])
            for start in self.start.tolist():
                node = np.full(part.shape[1], start)
                while True:
                    right = flat[feature[node] * part.shape[1] + rows] > self.cut[node]
                    after = children[2 * node + right]
                    if (after == node).all():
                        break
                    node = after
                total += self.value[node]
            out[first : first + 8192] = total
        return out

    def transform(self, df: DataFrame, features: str = "selected") -> DataFrame:
        """All columns, with rawPrediction and probability as vectors of both classes."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            model = shared.value
            return pa.array(model.margins(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), model.features)))

        raw = margin(vector_to_array(features))
        scored = df.withColumn("_margin", raw)
        late = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
            "probability": array_to_vector(F.array(1 - late, late)),
        }).drop("_margin")

    def importances(self) -> list[float]:
        """Mean gain of a feature's splits, as a share of the sum over features."""
        inner = self.feature >= 0
        splits = np.bincount(self.feature[inner], minlength=self.features)
        total = np.bincount(self.feature[inner], self.gain[inner], self.features)
        mean = total / np.maximum(splits, 1)
        return (mean / mean.sum() if mean.sum() else mean).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        rows = spark.createDataFrame(self.table())
        rows.withColumn("features", F.lit(self.features)).coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        table = spark.read.parquet(path).toArrow()
        return BoostedTrees.of(table, table.column("features")[0].as_py() if table.num_rows else 0)
