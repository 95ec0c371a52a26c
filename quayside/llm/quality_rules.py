"""Quality rules: base statistics of each text, two fixed rules, and an isolation forest over ratios of the statistics.

One pass over the texts writes the statistics; all else works on that small table. A ratio counts by how far it lies
beyond what nearly all rows labelled clean have, so ordinary variety isolates nobody. Random splits isolate a document with
such excess after few steps. Trees grow from a bounded hash sample of all documents (that is the method: a tree sees
`TREE_ROWS` rows); the bounds of the ratios and the score below which a document stays are set on all labelled rows,
the latter through a histogram.

Defined results: a null text has no words and all statistics 0, so it fails the base rules; labels of null or repeated
ids count once (the best of them); without labels of both kinds, the forest rejects nothing and only the base rules hold;
an empty table gives an empty result. Other columns are carried by `keep_documents` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.stored import PLACE_TYPE, placed, stored
from quayside.llm.textarrays import IS_SPACE, Slice, mix, released, slices, windows, word_hashes, words
from quayside.session import apply_settings, new_folder

TREES = 200
TREE_ROWS = 256
#: Rows that trees draw from; a bound, not a share of the documents.
SAMPLE_ROWS = 20_000
#: A rejected clean document costs this many times a kept bad one.
CLEAN_COST = 4.0
SCORE_BINS = 2_000
#: Share of the clean rows that a ratio's bound holds.
USUAL = 0.998

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_SHARE = 0.5

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_echoes",
)


def _members(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_KINDS = {
    "n_symbols": _members(SYMBOLS),
    "n_upper": _members(bytes(range(65, 91))),
    "n_digits": _members(b"0123456789"),
    "n_marks": _members(b"!?"),
}


def statistics(part: Slice) -> dict[str, np.ndarray]:
    """Counts per text of a slice, by the names of STATISTICS."""

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return np.diff(total[part.offsets])

    found = words(part)
    hashes = word_hashes(part, found)
    out = {"n_words": np.diff(found.bounds)}
    out["word_chars"] = per_text(~IS_SPACE[part.data] & ((part.data & 0xC0) != 0x80))
    out |= {name: per_text(kind[part.data]) for name, kind in _KINDS.items()}
    runs, at = windows(hashes, found, 3)
    _, which, count = np.unique(runs ^ mix(found.text[at].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    again = np.zeros(len(found), dtype=bool)
    repeated = at[count[which] > 1]
    for k in range(3):
        again[repeated + k] = True
    out["n_repeat_words"] = np.bincount(found.text[again], minlength=part.count)
    echo = np.zeros(len(found), dtype=bool)
    if len(found):
        echo[1:] = (hashes[1:] == hashes[:-1]) & (found.text[1:] == found.text[:-1])
    out["n_echoes"] = np.bincount(found.text[echo], minlength=part.count)
    lines = [[line for line in part.text(i).split(b"\n") if line.strip()] for i in range(part.count)]
    out["n_lines"] = np.array([len(own) for own in lines], dtype=np.int64)
    out["n_dup_lines"] = np.array([len(own) - len(set(own)) for own in lines], dtype=np.int64)
    return out


RATIOS = 8


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics that do not grow with a text's length, one row per text."""
    per_word = np.maximum(counts["n_words"], 1).astype(np.float64)
    per_char = np.maximum(counts["word_chars"], 1).astype(np.float64)
    return np.stack(
        [
            np.log1p(counts["word_chars"] / per_word),
            counts["n_symbols"] / per_word,
            counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1),
            counts["n_repeat_words"] / per_word,
            counts["n_upper"] / per_char,
            counts["n_digits"] / per_char,
            counts["n_marks"] / per_word,
            counts["n_echoes"] / per_word,
        ],
        axis=1,
    )


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > 100 * REPEAT_SHARE * counts["n_words"])


def _path_of(n: np.ndarray | float) -> np.ndarray:
    """Mean depth at which a random tree over n rows isolates one."""
    n = np.maximum(np.asarray(n, dtype=np.float64), 1)
    long = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays (tree, node): feature, cut, left child (right is the next), and the path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    usual: float
    bounds: tuple[np.ndarray, np.ndarray] = (np.zeros(RATIOS), np.full(RATIOS, np.inf))
    threshold: float = 2.0

    def anomaly(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        return self.score(excess(ratios(counts), self.bounds))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; near 1 for rows that few splits isolate."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, path in zip(self.feature, self.cut, self.left, self.path):
            node = np.zeros(len(rows), dtype=np.int64)
            while True:
                inner = left[node] >= 0
                if not inner.any():
                    break
                go = rows[every, feature[node]] >= cut[node]
                node = np.where(inner, left[node] + go, node)
            total += path[node]
        return 2.0 ** (-total / max(len(self.path), 1) / max(self.usual, 1e-9))


def excess(rows: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.maximum(rows - bounds[1], 0) + np.maximum(bounds[0] - rows, 0)


def grow_forest(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 0) -> Forest:
    """Trees of random splits, each over `tree_rows` of the rows."""
    random = np.random.default_rng(seed)
    tree_rows = min(tree_rows, len(rows))
    height = max(1, int(np.ceil(np.log2(max(tree_rows, 2)))))
    size = 2 ** (height + 1)
    shape = (trees, size)
    out = Forest(np.zeros(shape, dtype=np.int64), np.zeros(shape), np.full(shape, -1), np.zeros(shape), float(_path_of(tree_rows)))
    for t in range(trees if tree_rows else 0):
        drawn = rows[random.choice(len(rows), tree_rows, replace=False)]
        todo, used = [(0, drawn, 0)], 1
        while todo:
            node, own, depth = todo.pop()
            spread = np.flatnonzero(own.max(axis=0) > own.min(axis=0)) if len(own) > 1 else []
            if depth == height or not len(spread):
                out.path[t, node] = depth + _path_of(len(own))
                continue
            f = int(random.choice(spread))
            cut = random.uniform(own[:, f].min(), own[:, f].max())
            right = own[:, f] >= cut
            out.feature[t, node], out.cut[t, node], out.left[t, node] = f, cut, used
            todo += [(used, own[~right], depth + 1), (used + 1, own[right], depth + 1)]
            used += 2
    return out


def _counts_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    parts = [statistics(part) for part in slices(batch.column("text"))]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for name in STATISTICS}


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        counts = _counts_of(batch)
        own = [batch.column("doc_id"), batch.column("place"), *[pa.array(counts[n], pa.int64()) for n in STATISTICS]]
        yield pa.record_batch(own, names=["doc_id", "place", *STATISTICS])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, place and the statistics of each document, stored."""
    path = new_folder(docs.sparkSession, "rule-statistics")
    schema = ", ".join(["doc_id bigint", f"place {PLACE_TYPE}", *[f"{n} bigint" for n in STATISTICS]])
    placed(stored(docs), "_place").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_place").alias("place"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_measure, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _scored(stats: DataFrame, forest) -> DataFrame:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            counts = {n: batch.column(n).to_numpy() for n in STATISTICS}
            yield batch.append_column("anomaly", pa.array(forest.value.anomaly(counts))).append_column(
                "base_failed", pa.array(base_failed(counts))
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in stats.dtypes)
    return stats.mapInArrow(score, f"{schema}, anomaly double, base_failed boolean")


def _bounds(clean: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ratios that all but a small share of the clean rows stay within; below, only words can be too short."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            own = ratios({n: batch.column(n).to_numpy() for n in STATISTICS})
            yield pa.record_batch([pa.array(own[:, k]) for k in range(RATIOS)], names=[f"r{k}" for k in range(RATIOS)])

    ratio = clean.select(*STATISTICS).mapInArrow(rows, ", ".join(f"r{k} double" for k in range(RATIOS)))
    shares = [1 - USUAL, USUAL]
    found = ratio.agg(*[F.percentile_approx(f"r{k}", shares, 10_000) for k in range(RATIOS)]).first()
    low, high = np.zeros(RATIOS), np.full(RATIOS, np.inf)
    if found[0] is not None:
        high = np.array([own[1] for own in found])
        low[0] = found[0][0]
    return low, high


def fit(stats: DataFrame, labels: DataFrame, trees: int = TREES, sample_rows: int = SAMPLE_ROWS, clean_cost: float = CLEAN_COST) -> Forest:
    """Forest over a bounded sample of the rows that pass the base rules; bounds and threshold over all labelled rows.

    The threshold minimises the share of bad rows kept plus `clean_cost` times the share of clean rows rejected.
    """
    spark = stats.sparkSession
    passed = stats.filter(f"n_words >= {MIN_WORDS} AND n_repeat_words <= {REPEAT_SHARE} * n_words")
    best = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(labels["doc_id"].cast("long").alias("doc_id"))
    labelled = passed.join(best.agg(F.max("quality").alias("_quality")), "doc_id")
    bounds = _bounds(labelled.filter("_quality = 1"))
    total = passed.count()
    part = passed
    if total > sample_rows:  # hashes are uniform, so this many rows up to chance; the place tells rows without ids apart
        part = passed.filter(F.xxhash64(*STATISTICS, "doc_id", "place") < int(-(2**63) + 2**64 * sample_rows / total))
    rows = part.select(*STATISTICS).toPandas().sort_values(list(STATISTICS))
    forest = grow_forest(excess(ratios({n: rows[n].to_numpy() for n in STATISTICS}), bounds), trees)
    forest.bounds = bounds
    labelled = _scored(labelled, spark.sparkContext.broadcast(forest))
    bins = (
        labelled.groupBy(F.floor(F.col("anomaly") * SCORE_BINS).cast("int").alias("bin"))
        .agg(F.sum(F.when(F.col("_quality") == 1, 1).otherwise(0)).alias("clean"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .toPandas()
    )
    clean, bad = bins["clean"].to_numpy(), (bins["n"] - bins["clean"]).to_numpy()
    if clean.sum() and bad.sum():
        cost = np.concatenate([[0], np.cumsum(bad)]) / bad.sum() + clean_cost * (clean.sum() - np.concatenate([[0], np.cumsum(clean)])) / clean.sum()
        cut = int(np.argmin(cost))
        # Midway between the last bin kept and the first rejected.
        at = bins["bin"].to_numpy()
        if cut < len(at):
            forest.threshold = (at[cut - 1] + 1 + at[cut]) / 2 / SCORE_BINS if cut else float(at[0]) / SCORE_BINS
    return forest


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, place, the statistics, base_failed, anomaly, kept."""
    spark = apply_settings(docs.sparkSession)
    stats = measure(docs)
    forest = fit(stats, labels)
    return _scored(stats, spark.sparkContext.broadcast(forest)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < forest.threshold)
    )


def keep_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that pass: measured again where they lie, so no text moves."""
    spark: SparkSession = apply_settings(docs.sparkSession)
    forest = spark.sparkContext.broadcast(fit(measure(docs), labels))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            counts = _counts_of(batch)
            passed = ~base_failed(counts) & (forest.value.anomaly(counts) < forest.value.threshold)
            yield batch.filter(pa.array(passed))

    return docs.mapInArrow(keep, docs.schema)
