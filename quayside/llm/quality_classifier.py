"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages. Each passage gets statistics of its bytes and words and a small hashed histogram of byte
pairs; an encoder maps them to a code, gated attention weighs the codes, and the weighted code of the bag is scored. Only the
bag has a label; which passages matter is learned. Every passage of every text is encoded and weighed.

The network is fitted on a bounded sample of labelled rows, in one process: at most `TRAIN_ROWS` ids, the first by a hash of the
id, one row of each, the one with the least place, and of these in the same order as many whole bags as fit into
`TRAIN_PASSAGES` passages. Scoring runs where the texts lie.

Defined results: a null or empty text is a bag of one passage without words; without labels of both kinds, the score
is the share of label 1 among the sample, or 0.5 where there is none; labels of null or repeated ids count once (the
best of them). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.stored import placed, stored
from quayside.llm.textarrays import IS_SPACE, Slice, mix, released, slices, word_hashes, words
from quayside.session import apply_settings, new_folder

PASSAGE_WORDS = 64
PAIR_BINS = 32
TRAIN_ROWS = 6_000
TRAIN_PASSAGES = 1 << 17
CODE = 24
EPOCHS = 150
SLICE_BYTES = 1 << 20


def _kinds() -> np.ndarray:
    """A class for each byte: lower case, upper case, digit, space, line break, and marks of several kinds."""
    out = np.full(256, 9)
    for kind, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:'\"()-", b"!?", b"#*$%&|<>")):
        out[list(members)] = kind
    out[128:] = 8
    return out


_KIND = _kinds()
KINDS = 10
FEATURES = KINDS + 5 + PAIR_BINS


def passages(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a slice, and per text its first passage (one more at the end); no text is without."""
    found = words(part)
    hashes = word_hashes(part, found)
    per_text = np.diff(found.bounds)
    count = np.maximum(1, -(-per_text // PASSAGE_WORDS))
    bounds = np.concatenate([[0], np.cumsum(count)])
    total = int(bounds[-1])
    out = np.zeros((total, FEATURES))
    if not len(found):
        return out, bounds
    place = np.arange(len(found)) - np.repeat(found.bounds[:-1], per_text)
    passage = bounds[found.text] + place // PASSAGE_WORDS
    # Bytes belong to the passage of the last word that began before them; those before a text's first word to its first.
    first_word = np.flatnonzero(np.diff(passage, prepend=-1))
    starts = found.starts[first_word]
    fresh = place[first_word] == 0
    starts[fresh] = part.offsets[found.text[first_word[fresh]]]
    ids = passage[first_word]
    ends = np.append(starts[1:], len(part.data))
    ends = np.minimum(ends, part.offsets[found.text[first_word] + 1])
    length = (ends - starts).astype(np.float64)
    kind = _KIND[part.data]
    for k in range(KINDS):
        summed = np.concatenate([[0], np.cumsum(kind == k)])
        out[ids, k] = (summed[ends] - summed[starts]) / length
    n = np.bincount(passage, minlength=total).astype(np.float64)
    per = np.maximum(n, 1)
    width = (found.ends - found.starts).astype(np.float64)
    mean = np.bincount(passage, weights=width, minlength=total) / per
    out[:, KINDS] = np.log1p(mean)
    out[:, KINDS + 1] = np.sqrt(np.maximum(np.bincount(passage, weights=width**2, minlength=total) / per - mean**2, 0)) / 8
    echo = np.zeros(len(found))
    echo[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    out[:, KINDS + 2] = np.bincount(passage, weights=echo, minlength=total) / per
    distinct = np.unique(hashes ^ mix(passage.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    out[:, KINDS + 3] = np.bincount(passage[distinct], minlength=total) / per
    out[:, KINDS + 4] = np.log1p(n) / 4
    lower = np.where((kind == 1), part.data + 32, part.data).astype(np.int64)
    pair = ((lower[:-1] * 31 + lower[1:]) * 2654435761 >> 16) % PAIR_BINS
    inside = ~IS_SPACE[part.data[:-1]] & ~IS_SPACE[part.data[1:]]
    inside[part.offsets[(part.offsets > 0) & (part.offsets < len(part.data))] - 1] = False  # never across texts
    owner = np.searchsorted(starts, np.arange(len(part.data) - 1), side="right") - 1
    inside &= owner >= 0
    bins = np.bincount(ids[owner[inside]] * PAIR_BINS + pair[inside], minlength=total * PAIR_BINS).reshape(total, PAIR_BINS)
    out[:, KINDS + 5 :] = bins / np.maximum(bins.sum(axis=1, keepdims=True), 1)
    return out, bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """Encoder, gated attention and bag score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w, bag = self.weights, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        z = (x - self.centre) / self.scale
        code = np.tanh(z @ w["encode"] + w["encode_b"])
        value, gate = np.tanh(code @ w["value"]), _sigmoid(code @ w["gate"])
        raw = (value * gate) @ w["attend"]
        raw = np.exp(raw - np.maximum.reduceat(raw, bounds[:-1])[bag])
        share = raw / np.add.reduceat(raw, bounds[:-1])[bag]
        pooled = np.add.reduceat(share[:, None] * code, bounds[:-1], axis=0)
        return {"z": z, "bag": bag, "code": code, "value": value, "gate": gate, "share": share, "pooled": pooled, "score": _sigmoid(pooled @ w["score"] + w["score_b"])}

    def gradients(self, x: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, f = self.weights, self.forward(x, bounds)
        bag, share, code = f["bag"], f["share"], f["code"]
        d_score = (f["score"] - label) / len(label)
        d_pooled = np.outer(d_score, w["score"])[bag]
        through = (d_pooled * code).sum(axis=1)
        d_raw = share * (through - np.add.reduceat(share * through, bounds[:-1])[bag])
        d_product = np.outer(d_raw, w["attend"])
        d_value = d_product * f["gate"] * (1 - f["value"] ** 2)
        d_gate = d_product * f["value"] * f["gate"] * (1 - f["gate"])
        d_code = (share[:, None] * d_pooled + d_value @ w["value"].T + d_gate @ w["gate"].T) * (1 - code**2)
        return {
            "encode": f["z"].T @ d_code,
            "encode_b": d_code.sum(axis=0),
            "value": code.T @ d_value,
            "gate": code.T @ d_gate,
            "attend": (f["value"] * f["gate"]).T @ d_raw,
            "score": f["pooled"].T @ d_score,
            "score_b": np.array([d_score.sum()]),
        }


def new_network(x: np.ndarray, share: float, seed: int = 0) -> Network:
    random = np.random.default_rng(seed)
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    weights = {
        "encode": draw(FEATURES, CODE), "encode_b": np.zeros(CODE), "value": draw(CODE, CODE), "gate": draw(CODE, CODE),
        "attend": draw(CODE), "score": np.zeros(CODE), "score_b": np.array([np.log(share / (1 - share))]),
    }
    return Network(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), weights)


def train(x: np.ndarray, bounds: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02, decay: float = 1e-4) -> Network:
    """Full-batch gradient steps with per-weight step sizes (Adam)."""
    share = float(label.mean()) if len(label) else 0.5
    if not len(label) or not 0 < share < 1:
        net = new_network(x if len(x) else np.zeros((1, FEATURES)), 0.5)
        net.weights["score_b"][:] = np.log((share + 1e-6) / (1 - share + 1e-6))
        return net
    net = new_network(x, share)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, epochs + 1):
        for k, g in net.gradients(x, bounds, label).items():
            g = g + decay * net.weights[k] * (not k.endswith("_b"))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.weights[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return net


def _encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        for part in slices(batch.column("text"), SLICE_BYTES):
            x, bounds = passages(part)
            own = batch.slice(part.first, part.count)
            bags = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            columns = [own.column("doc_id"), own.column("quality"), pa.array(np.diff(bounds), pa.int64()), pa.array(bags, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "quality", "n", "bag"])


def _sample_bags(docs: DataFrame, labels: DataFrame, train_rows: int, train_passages: int) -> DataFrame:
    """doc_id, quality and bag of the rows to fit on: at most `train_rows` with at most `train_passages` in all."""
    spark = docs.sparkSession
    best = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(labels["doc_id"].cast("long").alias("doc_id"))
    in_order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = best.agg(F.max("quality").cast("int").alias("quality")).orderBy(*in_order).limit(train_rows)
    rows = placed(stored(docs), "_place").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_place").alias("place"), F.col("text").cast("string").alias("text")
    )
    # At most train_rows small rows are broadcast, twice, so no text moves to be chosen.
    held = rows.select("doc_id", "place").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("place").alias("place"))
    folder = new_folder(spark, "classifier-bags")
    rows.join(F.broadcast(held), ["doc_id", "place"]).select("doc_id", "quality", "text").mapInArrow(
        _encode, "doc_id bigint, quality int, n bigint, bag binary"
    ).write.parquet(folder)
    bags = spark.read.parquet(folder)
    taken, left = [], train_passages
    for doc_id, n in bags.orderBy(*in_order).select("doc_id", "n").collect():
        if n <= left:
            taken.append((doc_id,))
            left -= n
    return bags.join(F.broadcast(spark.createDataFrame(taken, "doc_id bigint")), "doc_id", "left_semi").select("doc_id", "quality", "bag")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_passages: int = TRAIN_PASSAGES) -> Network:
    """Network from a bounded sample of labelled rows; `labels` has doc_id and quality."""
    found = _sample_bags(docs, labels, train_rows, train_passages).toPandas().sort_values("doc_id")
    parts = [np.frombuffer(b).reshape(-1, FEATURES) for b in found["bag"]]
    x = np.concatenate(parts) if parts else np.zeros((0, FEATURES))
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return train(x, bounds, (found["quality"].to_numpy() == 1).astype(np.float64))


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, score and predicted of every row of `docs`."""
    spark = apply_settings(docs.sparkSession)
    net = spark.sparkContext.broadcast(fit(docs, labels, train_rows))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            out = [net.value.forward(*passages(part))["score"] for part in slices(batch.column("text"), SLICE_BYTES)]
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, score double, predicted int")
