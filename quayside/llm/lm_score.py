"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Counts of pairs of tokens are quantised to 1 + floor(log2 count), and a pair is entered once for each level up to its own.
Probing level after level until one is missing gives the level back; a filter errs upwards only. The filter grows with
the training text, 8 to 16 bits a token at any size, and is cut into segments by hash. Each segment is built by the task
that gets all counts of its pairs, and stays a row of a stored table: no process holds more than one of them.

Documents are scored in units of about `UNIT_TOKENS` tokens. A unit asks each segment once for its distinct pairs, and for
the counts of its rarer tokens; the answers, in the order of the hashes, meet the unit again, where its documents are
scored. Counts of single tokens are exact: tokens that make up at least 2^-20 of the corpus, which can be 2^20 at most, are
broadcast, and all others lie beside the segment of their hash.

A token's probability is its pair's count over its predecessor's, smoothed with the token's own share of the corpus
(Dirichlet prior). Only the pair's count is quantised; the others are exact, so the probabilities of all tokens, one unknown token
included, add up to 1 after any predecessor but for the quantisation of its pairs.

Defined results: null text counts as empty, and an empty text is one end token. Without training texts all counts are 0.
Rows are told apart by their place, so repeated ids and texts are scored each. Other columns are not looked at. Tokens
are told apart by a 64-bit hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrowgroups import sorted_groups
from quayside.llm.stored import PLACE_TYPE, placed, stored
from quayside.llm.textarrays import Slice, mix, released, slices, word_hashes, words
from quayside.session import apply_settings, new_folder

#: What places made of 64-bit hashes can address; no memory is bounded by it.
MAX_BITS = 1 << 60
MIN_BITS = 1 << 20
BITS_PER_TOKEN = 8
PROBES = 4
PRIOR = 5.0
HEAD_TOKENS = 1 << 20
#: Training tokens that a segment of the filter is built from, about.
SEGMENT_TOKENS = 1 << 21
#: Tokens of documents that are scored together, up to the last slice of texts.
UNIT_TOKENS = 1 << 20
#: Grams that a task folds before it sends them on.
FOLD = 4_000_000

END = np.uint64(0x0123456789ABCDEF)
_PAIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SINGLE = np.uint64(0xA24BAED4963EE407)
_LEVEL = 0xD1B54A32D192ED03
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts of a slice, an end after each, and the bounds of the texts."""
    low = Slice(part.first, part.count, _LOWER[part.data], part.offsets)
    found = words(low)
    bounds = found.bounds + np.arange(part.count + 1)
    out = np.full(int(bounds[-1]), END, dtype=np.uint64)
    out[np.arange(len(found)) + found.text] = word_hashes(low, found)
    return out, bounds


def single(token: np.ndarray) -> np.ndarray:
    return mix(token * _SINGLE)


def pairs(token: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before; a text's first follows an end."""
    before = np.concatenate([[END], token[:-1]])
    return mix(before * _PAIR[0] + token * _PAIR[1])


def fold(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(which, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def packed_numbers(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of all of them: bytes of one weight are alike, so small numbers take little space."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked_numbers(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)


def packed_grams(gram: np.ndarray) -> bytes:
    """Grams in rising order, by their steps."""
    return packed_numbers(np.diff(gram, prepend=np.uint64(0)))


def unpacked_grams(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(data, np.uint64), dtype=np.uint64)


def all_grams(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *map(unpacked_grams, column.drop_null().to_pylist())])


class Folder:
    """Counts of keys, folded whenever many have come together."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, found: np.ndarray) -> bool:
        """Whether it is full."""
        key, count = np.unique(found, return_counts=True)
        self.keys.append(key)
        self.counts.append(count)
        self.size += len(key)
        return self.size >= FOLD

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = fold(self.keys, self.counts)
        self.__init__()
        return out


@dataclass
class Layout:
    """How grams lie in the filter: `segments` parts of `segment_bits`, both powers of two."""

    segments: int
    segment_bits: int

    def segment(self, gram: np.ndarray) -> np.ndarray:
        return (gram >> np.uint64(65 - self.segments.bit_length())).astype(np.int64) if self.segments > 1 else np.zeros(len(gram), np.int64)

    def places(self, gram: np.ndarray, level: int) -> Iterator[np.ndarray]:
        """Bits, within its segment, of each gram at a level."""
        own = mix(gram + np.uint64(level * _LEVEL % 2**64))
        step = (own >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            yield ((own + np.uint64(k) * step) & np.uint64(self.segment_bits - 1)).astype(np.int64)


def layout(train_tokens: int) -> Layout:
    bits = MIN_BITS
    while bits < min(MAX_BITS, BITS_PER_TOKEN * train_tokens):
        bits *= 2
    segments = 64
    while segments < train_tokens // SEGMENT_TOKENS and segments < bits // 512:
        segments *= 2
    return Layout(segments, bits // segments)


@dataclass
class Filter:
    shape: Layout
    bits: np.ndarray

    def levels(self, gram: np.ndarray) -> np.ndarray:
        """Level of each gram, 0 for grams that were never entered."""
        level = np.zeros(len(gram), dtype=np.int64)
        left, at, base = gram, np.arange(len(gram)), self.shape.segment(gram) * self.shape.segment_bits
        for k in range(1, 64):
            there = np.ones(len(left), dtype=bool)
            for place in self.shape.places(left, k):
                place += base
                there &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            left, at, base = left[there], at[there], base[there]
            level[at] = k
            if not len(at):
                break
        return level

    def counts(self, gram: np.ndarray) -> np.ndarray:
        return mean_count(self.levels(gram))


def levels_of(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def mean_count(level: np.ndarray) -> np.ndarray:
    """Mean of the counts of each level, 0 for level 0."""
    return np.where(level > 0, (3 * np.exp2(level - 1.0) - 1) / 2, 0.0)


def _texts(batch: pa.RecordBatch, train_only: bool) -> pa.Array:
    column = batch.column("text")
    return column.filter(batch.column("train")) if train_only else column


def _count_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Folder()

    def packed() -> pa.RecordBatch:
        key, count = held.take()
        return pa.record_batch([pa.array(key.view(np.int64)), pa.array(count)], names=["h", "n"])

    for batch in released(batches):
        for part in slices(_texts(batch, True)):
            if held.add(tokens(part)[0]):
                yield packed()
    if held.keys:
        yield packed()


_PACKED = "segment bigint, ones binary, grams binary, counts binary"


def _pack(shape: Layout, gram: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """A row for each segment: grams that came once, and the others with their counts."""
    segment = shape.segment(gram)
    cuts = np.flatnonzero(np.diff(segment, prepend=-1))
    rows = []
    for lo, hi in zip(cuts, [*cuts[1:], len(gram)]):
        key, n = gram[lo:hi], count[lo:hi]
        rows.append((int(segment[lo]), packed_grams(key[n == 1]), packed_grams(key[n > 1]), n[n > 1].astype(np.int64).tobytes()))
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["segment", "ones", "grams", "counts"])


def _pair_packer(shape: Layout):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Folder()
        for batch in released(batches):
            for part in slices(_texts(batch, True)):
                if held.add(pairs(tokens(part)[0])):
                    yield _pack(shape, *held.take())
        if held.keys:
            yield _pack(shape, *held.take())

    return pack


def _single_packer(shape: Layout):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            key = single(batch.column("h").to_numpy().view(np.uint64))
            order = np.argsort(key)
            yield _pack(shape, key[order], batch.column("n").to_numpy()[order])

    return pack


def _segment_builder(shape: Layout):
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["segment"]):
            ones, grams = all_grams(group.column("ones")), all_grams(group.column("grams"))
            counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=np.int64)
            gram, count = fold([ones, grams], [np.ones(len(ones), dtype=np.int64), counts])
            level = levels_of(count)
            bits = np.zeros(shape.segment_bits, dtype=bool)
            k = 1
            while len(gram):
                for place in shape.places(gram, k):
                    bits[place] = True
                k += 1
                gram, level = gram[level >= k], level[level >= k]
            segment = group.column("segment")[0].as_py()
            yield pa.record_batch(
                [pa.array([segment], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                names=["segment", "bits"],
            )

    return build


def build_filter(rows: DataFrame, shape: Layout, folder: str) -> DataFrame:
    """Stored segments (segment, bits) of the filter of all pairs in the training rows (text, train)."""
    packed = rows.select("text", "train").mapInArrow(_pair_packer(shape), _PACKED)
    built = packed.repartition("segment").sortWithinPartitions("segment")
    built.mapInArrow(_segment_builder(shape), "segment bigint, bits binary").write.parquet(f"{folder}/filter")
    return rows.sparkSession.read.parquet(f"{folder}/filter")


@dataclass
class Head:
    """Frequent tokens in order, and their counts."""

    token: np.ndarray
    count: np.ndarray

    def find(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each token is among them, and its count or 0."""
        if not len(self.token):
            return np.zeros(len(token), dtype=bool), np.zeros(len(token), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.token, token), len(self.token) - 1)
        there = self.token[at] == token
        return there, np.where(there, self.count[at], 0)


_UNIT = "file bigint, row bigint, doc_id array<bigint>, held_out array<boolean>, n_tokens array<bigint>, tokens binary, index binary"


def _one_list(values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values).cast(pa.list_(values.type))


def _to_units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each unit, named by the place of its first document: its distinct tokens, and which of them come in turn."""
    ids, held_out, sizes, found = [], [], [], []
    place, size = None, 0

    def packed() -> pa.RecordBatch:
        own, index, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        rank = np.empty(len(own), dtype=np.uint32)  # frequent tokens get small numbers
        rank[np.argsort(-times, kind="stable")] = np.arange(len(own), dtype=np.uint32)
        columns = [
            pa.array([place["file"]], pa.int64()), pa.array([place["row"]], pa.int64()),
            _one_list(pa.concat_arrays(ids)), _one_list(pa.concat_arrays(held_out)), _one_list(pa.array(np.concatenate(sizes), pa.int64())),
            pa.array([own[np.argsort(rank)].tobytes()], pa.binary()), pa.array([packed_numbers(rank[index])], pa.binary()),
        ]
        for c in (ids, held_out, sizes, found):
            c.clear()
        return pa.record_batch(columns, names=["file", "row", "doc_id", "held_out", "n_tokens", "tokens", "index"])

    for batch in released(batches):
        for part in slices(batch.column("text")):
            own = batch.slice(part.first, part.count)
            token, bounds = tokens(part)
            if not found:
                place, size = own.column("place")[0].as_py(), 0
            ids.append(own.column("doc_id"))
            held_out.append(own.column("held_out"))
            sizes.append(np.diff(bounds))
            found.append(token)
            size += len(token)
            if size >= UNIT_TOKENS:
                yield packed()
    if found:
        yield packed()


def _asker(shape: Layout, head):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a unit asks each segment: its distinct pairs and rarer tokens that lie there, in order."""
        for batch in released(batches):
            for i in range(batch.num_rows):
                token = np.frombuffer(batch.column("tokens")[i].as_py(), dtype=np.uint64)
                index = unpacked_numbers(batch.column("index")[i].as_py(), np.uint32)
                pair = np.unique(pairs(token[index]))
                rare = np.sort(single(token[~head.value.find(token)[0]]))
                of_pair, of_rare = shape.segment(pair), shape.segment(rare)
                segments = np.union1d(of_pair, of_rare)
                spans = []
                for gram, of in ((pair, of_pair), (rare, of_rare)):
                    lo, hi = np.searchsorted(of, segments), np.searchsorted(of, segments, side="right")
                    spans.append(pa.array([packed_grams(gram[a:b]) for a, b in zip(lo, hi)], pa.binary()))
                place = [pa.array([batch.column(c)[i].as_py()] * len(segments), pa.int64()) for c in ("file", "row")]
                yield pa.record_batch([pa.array(segments), *place, *spans], names=["segment", "file", "row", "pairs", "rare"])

    return ask


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), dtype=kind)


def _answerer(shape: Layout):
    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Levels of the pairs and counts of the rarer tokens that each unit asked a segment for."""
        for group in sorted_groups(batches, ["segment"]):
            bits = _joined(group.column("bits"), np.uint8)
            own = Filter(Layout(1, shape.segment_bits), bits if len(bits) else np.zeros(shape.segment_bits // 8, dtype=np.uint8))
            ones, more = all_grams(group.column("ones")), all_grams(group.column("grams"))
            known, times = fold([ones, more], [np.ones(len(ones), dtype=np.int64), _joined(group.column("counts"), np.int64)])
            asked = group.filter(group.column("pairs").is_valid())
            vocabulary = Head(known, times)
            levels = [own.levels(unpacked_grams(x)).astype(np.uint8).tobytes() for x in asked.column("pairs").to_pylist()]
            counts = [vocabulary.find(unpacked_grams(x))[1].tobytes() for x in asked.column("rare").to_pylist()]
            yield pa.record_batch(
                [*[asked.column(c).combine_chunks() for c in ("file", "row", "segment")], pa.array(levels, pa.binary()), pa.array(counts, pa.binary())],
                names=["file", "row", "segment", "levels", "times"],
            )

    return answer


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _scorer(head, base: float):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores of the documents of each unit, which comes before its answers."""
        for group in sorted_groups(batches, ["file", "row"]):
            unit = group.slice(0, 1)
            token = _joined(unit.column("tokens"), np.uint64)
            index = unpacked_numbers(unit.column("index")[0].as_py(), np.uint32)
            frequent, count = head.value.find(token)
            rare = np.flatnonzero(~frequent)
            count[rare[np.argsort(single(token[rare]))]] = _joined(group.column("times"), np.int64)
            _, of = np.unique(pairs(token[index]), return_inverse=True)
            together = mean_count(_joined(group.column("levels"), np.uint8))[of]
            end = count[np.flatnonzero(token == END)[0]]
            before = np.concatenate([[end], count[index[:-1]]])
            prior = ((count + 1) / base)[index]
            each = np.log10((np.minimum(together, before) + PRIOR * prior) / (before + PRIOR))
            n = unit.column("n_tokens").combine_chunks().flatten()
            starts = np.cumsum(n.to_numpy()) - n.to_numpy()
            yield pa.record_batch(
                [
                    unit.column("doc_id").combine_chunks().flatten(), unit.column("held_out").combine_chunks().flatten(), n,
                    pa.array(np.add.reduceat((count > 0).astype(np.int64)[index], starts)),
                    pa.array(np.add.reduceat(np.log10((count + 1) / base)[index], starts)),
                    pa.array(np.add.reduceat(each, starts)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return score


def score_documents(docs: DataFrame, train: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `train` is true for the rows of `docs` to learn from.
    """
    spark = apply_settings(docs.sparkSession)
    folder = new_folder(spark, "lm-score")
    rows = placed(stored(docs), "_place").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_place").alias("place"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    counted = rows.select("text", "train").mapInArrow(_count_tokens, "h bigint, n bigint")
    counted.groupBy("h").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/vocabulary")
    vocabulary = spark.read.parquet(f"{folder}/vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    shape = layout(total)
    bloom = build_filter(rows, shape, folder)

    # At most HEAD_TOKENS tokens can reach this count each.
    least = max(1.0, total / HEAD_TOKENS)
    frequent = vocabulary.filter(F.col("n") >= least).toPandas()
    key = frequent["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(key)
    head = spark.sparkContext.broadcast(Head(key[order], frequent["n"].to_numpy().astype(np.int64)[order]))

    rows.select("doc_id", "place", "text", (~F.col("train")).alias("held_out")).mapInArrow(_to_units, _UNIT).write.parquet(f"{folder}/units")
    units = spark.read.parquet(f"{folder}/units")
    asked = units.select("file", "row", "tokens", "index").mapInArrow(
        _asker(shape, head), "segment bigint, file bigint, row bigint, pairs binary, rare binary"
    )
    tail = vocabulary.filter(F.col("n") < least).select("h", "n").mapInArrow(_single_packer(shape), _PACKED)
    at_segments = bloom.unionByName(tail, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    answers = at_segments.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        _answerer(shape), "file bigint, row bigint, segment bigint, levels binary, times binary"
    )
    # A unit, without a segment, sorts before its answers, which follow in the order of their hashes.
    at_units = units.unionByName(answers, allowMissingColumns=True)
    scored = at_units.repartition("file", "row").sortWithinPartitions("file", "row", "segment").mapInArrow(
        _scorer(head, float(total + distinct + 1)), _SCORED
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
