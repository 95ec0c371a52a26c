"""Hard negatives for anchors, with exact scores from Kronecker-packed products.

Components become the integers floor(256 * x). To score a block of rows, the components of several rows at one
dimension are biased to be non-negative and put side by side into fields of one wide integer, so that a single
multiplication by the anchor's component (biased too) serves all of them; fields are as wide as the largest possible sum of
products needs, so no carry leaves its field, and after the last dimension each field minus the biases' share is the exact inner
product. Integers of up to 53 bits are carried in doubles, which hold them exactly, so that a matrix product does the
multiplications; components too large for that are packed into Python's integers of any width.

Anchors are the stated queries: they are taken in blocks of bounded size, and every block meets all rows where those lie. A block
is scored twice: first against rows of the anchor's label for its positives, then against rows of other labels for those
negatives of each positive whose score lies between `low` and `high` percent of the positive's. A task keeps the first
`negatives` rows of each positive only. With many tasks even that would be much to merge, so the same is first done on nested
samples of the rows, each a sixteenth of the next: the last place in a sample's list is a bound below which no row of
the full table can enter, and a task hands on no more than what passes it. The bound only saves shuffling; all
rows are scored.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; a vector
that is shorter than another counts as filled up with zeros; repeated rows, also of one id, are rows of their own, and an
anchor is no positive of itself but a repetition of its row is; ties go by smaller id; an anchor without rows of its label,
and a positive without negatives, have no rows; scores beyond 62 bits count as the largest of 62 bits. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.stored import placed
from quayside.llm.textarrays import released
from quayside.session import apply_settings, new_folder

#: Rows of a task, and tasks whose lists are merged without a sample's bounds before.
TASK_ROWS = 1 << 13
MERGED_TASKS = 16
#: A sample is one row in so many of the next larger one.
SAMPLE_SHARE = 16
#: Bytes of a block of anchors, which is what is broadcast at once.
BLOCK_BYTES = 16 << 20
#: Scores held at once in a task.
MATRIX = 1 << 21

EXACT_BITS = 53
WIDE_FIELDS = 64
LIMIT = 1 << 62

FOUND = "anchor int, positive int, score long, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component, as whole doubles."""
    return np.floor(256.0 * vectors)


class Packed:
    """A block of rows (whole numbers, rows x dimensions) packed for products with anchors of known range."""

    def __init__(self, rows: np.ndarray, least: float, most: float) -> None:
        self.count, dims = rows.shape
        low = int(rows.min(initial=0))
        self.row_bias, self.anchor_bias = -min(low, 0), -min(int(least), 0)
        widest = (int(rows.max(initial=0)) + self.row_bias) * (int(most) + self.anchor_bias) * max(dims, 1)
        self.width = max(widest.bit_length(), 1)
        self.exact = self.width <= EXACT_BITS
        self.fields = EXACT_BITS // self.width if self.exact else WIDE_FIELDS
        groups = -(-self.count // self.fields)
        if self.exact:
            biased = np.zeros((groups * self.fields, dims))
            biased[: self.count] = rows + self.row_bias
            self.sums = biased[: self.count].sum(axis=1).astype(np.int64)
            shifts = 2.0 ** (self.width * np.arange(self.fields))
            self.wide = np.einsum("gfd,f->dg", biased.reshape(groups, self.fields, dims), shifts)
        else:
            biased = [[int(x) + self.row_bias for x in row] for row in rows.tolist()]
            self.sums = [sum(row) for row in biased]
            self.wide = [
                [sum(row[j] << (self.width * k) for k, row in enumerate(biased[g : g + self.fields])) for j in range(dims)]
                for g in range(0, self.count, self.fields)
            ]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products, anchors x rows."""
        mask = (1 << self.width) - 1
        if self.exact:
            sums = ((anchors + self.anchor_bias) @ self.wide).astype(np.int64)
            out = np.empty((len(anchors), sums.shape[1], self.fields), dtype=np.int64)
            for k in range(self.fields):
                np.bitwise_and(sums >> (self.width * k), mask, out=out[:, :, k])
            out = out.reshape(len(anchors), -1)[:, : self.count]
            return out - self.anchor_bias * self.sums[None, :] - self.row_bias * anchors.sum(axis=1).astype(np.int64)[:, None]
        out = np.empty((len(anchors), self.count), dtype=np.int64)
        for i, anchor in enumerate(anchors.tolist()):
            own = [int(x) for x in anchor]
            for g, wide in enumerate(self.wide):
                product = sum((a + self.anchor_bias) * w for a, w in zip(own, wide))
                for k in range(g * self.fields, min((g + 1) * self.fields, self.count)):
                    field = (product >> (self.width * (k - g * self.fields))) & mask
                    score = field - self.anchor_bias * self.sums[k] - self.row_bias * sum(own)
                    out[i, k] = max(-LIMIT, min(LIMIT, score))
        return out


class Firsts:
    """For each of `groups` lists, the first `k` (score, id) by falling score, then rising id."""

    def __init__(self, groups: int, k: int, bound: tuple[np.ndarray, np.ndarray]) -> None:
        self.k = k
        # A row must be at or before this place to enter.
        self.score, self.id = (x.copy() for x in bound)
        self.held = [np.zeros(0, dtype=np.int64)] * 3

    def passing(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (score > self.score[group]) | ((score == self.score[group]) & (ids <= self.id[group]))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = (np.concatenate(x) for x in zip(self.held, (group, score, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        last = np.flatnonzero(place == self.k - 1)
        self.score[group[last]], self.id[group[last]] = score[last], ids[last]
        stay = place < self.k
        self.held = [x[stay] for x in (group, score, ids)]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Whole components of a column of lists, filled up with zeros to `dims` columns."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    lengths = np.diff(offsets)
    values = whole(column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]])
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = values
    return out


def _numbers(batch: pa.RecordBatch | pa.Table, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(n).to_numpy() for n in names]


def _emitted(firsts: Firsts, per: int) -> pa.RecordBatch:
    group, score, ids = firsts.held
    return pa.RecordBatch.from_arrays(
        [pa.array(group // per, pa.int32()), pa.array(group % per, pa.int32()), pa.array(score), pa.array(ids)],
        names=["anchor", "positive", "score", "id"],
    )


def _positives(shared, dims: int, k: int):
    """mapInArrow: the first k rows of each anchor's label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        firsts = Firsts(len(block["id"]), k, block["bound"])
        by_label = {int(x): np.flatnonzero(block["label"] == x) for x in np.unique(block["label"])}
        for batch in released(batches):
            ids, labels, files, rows = _numbers(batch, "id", "label", "file", "row")
            vectors = _matrix(batch.column("vector"), dims)
            for label in np.unique(labels).tolist():
                anchors = by_label.get(int(label))
                if anchors is None:
                    continue
                mine = np.flatnonzero(labels == label)
                packed = Packed(vectors[mine], block["least"], block["most"])
                step = max(1, MATRIX // len(mine))
                for at in range(0, len(anchors), step):
                    own = anchors[at : at + step]
                    scores = packed.scores(block["vector"][own])
                    a, r = np.nonzero(scores >= firsts.score[own][:, None])
                    group, row, score = own[a], mine[r], scores[a, r]
                    good = firsts.passing(group, score, ids[row])
                    good &= (block["file"][group] != files[row]) | (block["row"][group] != rows[row])
                    firsts.add(group[good], score[good], ids[row[good]])
        yield _emitted(firsts, 1)

    return run


def _negatives(shared, dims: int, k: int):
    """mapInArrow: the first k rows of other labels within each positive's window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        per = block["floor"].shape[1]
        count = len(block["id"])
        firsts = Firsts(count * per, k, block["bound"])
        top = block["top"].max(axis=1)
        for batch in released(batches):
            ids, labels = _numbers(batch, "id", "label")
            packed = Packed(_matrix(batch.column("vector"), dims), block["least"], block["most"])
            step = max(1, MATRIX // max(len(ids), 1))
            for at in range(0, count, step):
                stop = min(at + step, count)
                scores = packed.scores(block["vector"][at:stop])
                need = np.maximum(block["floor"][at:stop], firsts.score.reshape(count, per)[at:stop])
                a, r = np.nonzero((scores >= need.min(axis=1)[:, None]) & (scores <= top[at:stop, None]))
                score = scores[a, r]
                other = block["label"][at + a] != labels[r]
                a, r, score = a[other], r[other], score[other]
                for p in range(per):
                    good = (score >= need[a, p]) & (score <= block["top"][at + a, p])
                    group, row, own = (at + a[good]) * per + p, r[good], score[good]
                    good = firsts.passing(group, own, ids[row])
                    firsts.add(group[good], own[good], ids[row[good]])
        yield _emitted(firsts, per)

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first k of all tasks' lists, with their rank."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class _Rows:
    """All rows that take part, stored, with nested samples of them."""

    def __init__(self, vectors: DataFrame, is_anchor: Column) -> None:
        spark = vectors.sparkSession
        folder = new_folder(spark, "vectors")
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        clean = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
        clean.select(
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
            is_anchor.alias("is_anchor"),
        ).write.parquet(f"{folder}/0")
        stored = spark.read.parquet(f"{folder}/0")
        read = lambda frame: placed(frame).select("id", "label", "vector", "is_anchor", "place.file", "place.row")
        self.count, self.dims, self.anchors = stored.agg(
            F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.coalesce(F.sum(F.col("is_anchor").cast("long")), F.lit(0))
        ).first()
        whole_table = read(stored)
        self.levels = [self._in_tasks(whole_table, self.count)]
        rows = self.count
        while math.ceil(rows / TASK_ROWS) > MERGED_TASKS:
            rows //= SAMPLE_SHARE
            step = len(self.levels)
            drawn = F.pmod(F.xxhash64("file", "row"), F.lit(SAMPLE_SHARE**step)) == 0
            self._in_tasks(whole_table.filter(drawn), rows).write.parquet(f"{folder}/{step}")
            self.levels.append(spark.read.parquet(f"{folder}/{step}"))
        self.table = whole_table

    @staticmethod
    def _in_tasks(frame: DataFrame, rows: int) -> DataFrame:
        return frame.coalesce(max(1, math.ceil(rows / TASK_ROWS)))

    def block(self, number: int, blocks: int) -> dict | None:
        """Anchors of a block as arrays; hashes of places deal them out evenly."""
        own = F.pmod(F.xxhash64(F.lit("block"), "file", "row"), F.lit(blocks)) == number
        table = self.table.filter(F.col("is_anchor") & own).drop("is_anchor").toArrow()
        if not table.num_rows:
            return None
        ids, label, files, rows = _numbers(table, "id", "label", "file", "row")
        vectors = _matrix(table.column("vector"), self.dims)
        return {
            "id": ids, "label": label, "file": files, "row": rows, "vector": vectors,
            "least": vectors.min(initial=0), "most": vectors.max(initial=0),
        }

    def firsts(self, block: dict, k: int, per: int, method) -> DataFrame:
        """The first k rows of each of the block's lists, from the smallest sample to the whole table."""
        spark = self.table.sparkSession
        count = len(block["id"]) * per
        bound = (np.full(count, -(LIMIT << 1), dtype=np.int64), np.full(count, np.iinfo(np.int64).max))
        for level in reversed(self.levels):
            shared = spark.sparkContext.broadcast(block | {"bound": bound})
            found = _merged(level.drop("is_anchor").mapInArrow(method(shared, self.dims, k), FOUND), k)
            if level is self.levels[0]:
                return found
            table = found.filter(F.col("rank") == k).toArrow()
            anchor, positive, score, ids = _numbers(table, "anchor", "positive", "score", "id")
            at = anchor.astype(np.int64) * per + positive
            bound[0][at], bound[1][at] = score, ids
        raise AssertionError("there is always the whole table")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for `vectors` (vec_id, embedding, label).

    For every anchor and each of its first `positives` other rows of the same label, the first `negatives` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score. `low` and `high` are whole percents from 0 to
    100. A block's anchors, with the `positives` scores and ids of each, are all that reaches the driver at once.
    """
    spark = vectors.sparkSession
    apply_settings(spark)
    rows = _Rows(vectors, is_anchor)
    per_anchor = 8 * rows.dims + 64 * positives
    blocks = max(1, math.ceil(rows.anchors * per_anchor / BLOCK_BYTES))
    folder = new_folder(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(f"{folder}/empty")
    paths = [f"{folder}/empty"]
    for number in range(blocks if rows.anchors else 0):
        block = rows.block(number, blocks)
        if block is None:
            continue
        table = rows.firsts(block, positives, 1, _positives).toArrow()
        anchor, rank, score, ids = _numbers(table, "anchor", "rank", "score", "id")
        shape = (len(block["id"]), positives)
        scores, chosen, known = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=bool)
        scores[anchor, rank - 1], chosen[anchor, rank - 1], known[anchor, rank - 1] = score, ids, True
        tens, rest = scores // 100, scores % 100
        block["floor"] = np.where(known, low * tens - (-low * rest // 100), LIMIT)
        block["top"] = np.where(known, high * tens + high * rest // 100, -LIMIT)
        found = rows.firsts(block, negatives, positives, _negatives)
        named = pa.table({
            "anchor": np.repeat(np.arange(shape[0], dtype=np.int32), positives),
            "positive": np.tile(np.arange(positives, dtype=np.int32), shape[0]),
            "anchor_id": np.repeat(block["id"], positives),
            "positive_id": chosen.ravel(),
            "positive_score": scores.ravel(),
        })
        found.join(spark.createDataFrame(named), ["anchor", "positive"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(f"{folder}/{number}")
        paths.append(f"{folder}/{number}")
    return spark.read.schema(RESULT).parquet(*paths)
