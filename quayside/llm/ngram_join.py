"""N-gram Jaccard join by chosen paths: near copies among the word shingles of all texts.

A text's set holds the hashes of its runs of five words (all its words, where it has fewer). Texts with equal sets are one
class member from the start. In each run a set keeps the few of its tokens whose hash falls below 1 / (0.8 * size), so
similar sets share one more often than not; sets that share a token meet in its bucket. A bucket above the limit is split
again by tokens sampled for the next level. Small buckets are compared by brute force. Those that are still large after
the last level are cut into blocks, and every pair of blocks is compared by a task of its own: memory stays that of two
blocks, and no row is left out. Rounds are added until the estimated recall reaches the target in every band: of links near
the threshold and above, that met in buckets of each level. Where only links that met below the first level fall short,
the large buckets of the first level are split again with other tokens, as it is there that their pairs were parted; else
the round makes runs from the start.

A pair that meets in several buckets belongs to the smallest of their keys, which every member can tell from the list of
its own buckets. Keys begin with the round and the level, so a later round decides only what no earlier one has met, and what it
finds is what the earlier ones missed. So pairs are never written out: a comparison returns per set its number of links and one link to
a neighbour that spans the bucket's groups, and links add up exactly over buckets. Sketches (one byte for each of 128
parts of the hash range) decide which sets need their text for the exact comparison.

Defined results: texts without words (null, empty, white space) have no set, no links, and a class of their own. Rows
with equal texts or ids are told apart by their place in the input. The smallest doc_id of a class names it, nulls last.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrowgroups import sorted_groups
from quayside.llm.components import components
from quayside.llm.stored import PLACE_TYPE, placed, stored
from quayside.llm.textarrays import Slice, mix, released, slices, windows, word_hashes, words
from quayside.session import apply_settings, new_folder

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RUNS = 8
LEVELS = 3
#: Sets that are compared by brute force at once.
BUCKET_SETS = 256
TARGET_RECALL = 0.995
#: Parts of the sketch, and the estimate below which a pair at 0.8 is over five standard deviations off.
PARTS = 128
SKETCH_FLOOR = 0.6

#: A bucket's key: round, level (2 bits) and hash (56 bits).
ROUNDS = 32
LEVEL_AT = 56
#: Links below this similarity are a band of their own.
NEAR_THRESHOLD = 0.85
#: Numbers per band and level: links, those that met in one run only, those that met in two.
BAND_COUNTS = 3
BANDS = 2 * 4


def run_seeds(first_run: int, runs: int, levels: int) -> np.ndarray:
    """Odd multipliers by level and run; those of a round depend on its first run only."""
    drawn = np.random.default_rng([7, first_run]).integers(1, 1 << 63, (levels, runs), dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def shingle_sets(part: Slice, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    found = words(part)
    hashes = word_hashes(part, found)
    all_windows, at = windows(hashes, found, width)
    bounds = np.searchsorted(at, found.bounds)
    out = []
    for i in range(part.count):
        lo, hi = found.bounds[i], found.bounds[i + 1]
        if hi - lo >= width:
            out.append(np.unique(all_windows[bounds[i] : bounds[i + 1]]))
        elif hi > lo:
            place = np.arange(1, hi - lo + 1, dtype=np.uint64)
            out.append(mix(np.array([np.sum(hashes[lo:hi] * (place * np.uint64(2) + np.uint64(hi - lo))) + np.uint64(hi - lo)], dtype=np.uint64)))
        else:
            out.append(all_windows[:0])
    return out


def set_id(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def sketch(own: np.ndarray) -> bytes:
    """A byte of the smallest hash in each part of the range; 0 for a part without any."""
    out = np.zeros(PARTS, dtype=np.uint8)
    part = (own >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    out[part[first]] = (own[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def _signer(first_run: int, runs: int, levels: range):
    """Arrow function: doc_id, place, text -> doc_id, place, set_id, size, sketch, chosen tokens by level and run."""
    seeds = run_seeds(first_run, runs, levels.stop)
    lists = pa.list_(pa.list_(pa.int64()))

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            ids, sizes, sketches = [], [], []
            chosen: list[list] = [[] for _ in levels]
            for part in slices(batch.column("text")):
                for own in shingle_sets(part):
                    ids.append(set_id(own))
                    sizes.append(len(own))
                    sketches.append(sketch(own) if len(own) else None)
                    limit = np.uint64(min((1 << 64) - 1, int(2**64 / (SIMILARITY * max(len(own), 1)))))
                    for at_level, level in enumerate(levels):
                        below = np.multiply.outer(seeds[level], own) < limit
                        run, at = np.nonzero(below)
                        picked = np.split(own[at].view(np.int64), np.searchsorted(run, np.arange(1, runs)))
                        chosen[at_level].append(picked if len(own) else None)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("place"),
                    pa.array(ids, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    *[pa.array(c, lists) for c in chosen],
                ],
                names=["doc_id", "place", "set_id", "size", "sketch", *[f"level{k}" for k in levels]],
            )

    return sign


def _placed(docs: DataFrame) -> DataFrame:
    return placed(docs, "_place").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_place").alias("place"), F.col("text").cast("string").alias("text")
    )


def _key(round_: int, level: int, *columns: str):
    """A bucket's key: those of earlier rounds and lower levels are smaller."""
    prefix = (round_ << (LEVEL_AT + 2)) | (level << LEVEL_AT)
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << LEVEL_AT) - 1)) + F.lit(prefix)).alias("key")


def _buckets(
    sets: DataFrame, round_: int, first_run: int, levels: int, bucket_sets: int, folder: str, hot: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """key, run, n, set_id: memberships of a round's buckets that need no more splitting, with two sets at least.

    And key, run, set_id: those of buckets of the first level that were split. Given such (`hot`, by the round's runs), the
    round splits them again and has no first level of its own.

    Memberships and bucket sizes of a level are stored: the next level starts from them, and the join of both
    is of two plain shuffles, in which Spark can split a hot bucket.
    """
    spark = sets.sparkSession

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def split(large: DataFrame, level: int) -> DataFrame:
        return (
            large.join(sets.select("set_id", f"level{level}"), "set_id")
            .select("key", "run", "set_id", F.explode(F.expr(f"level{level}[run - {first_run}]")).alias("token"))
            .select(_key(round_, level, "run", "key", "token"), "run", "set_id")
        )

    first_level = 0 if hot is None else 1
    if hot is None:
        tokens = sets.select("set_id", F.posexplode("level0").alias("at", "tokens"))
        live = tokens.select(F.explode("tokens").alias("token"), (F.col("at") + first_run).alias("run"), "set_id")
        live = live.select(_key(round_, 0, "run", "token"), "run", "set_id")
    else:
        live = split(hot, 1)
    out = None
    for level in range(first_level, levels):
        live = kept(f"live{level}", live)
        counts = kept(f"counts{level}", live.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        counted = kept(f"counted{level}", live.join(counts, "key"))
        last = level == levels - 1
        done = counted if last else counted.filter(F.col("n") <= bucket_sets)
        out = done if out is None else out.unionByName(done)
        large = counted.filter(F.col("n") > bucket_sets).select("key", "run", "set_id")
        hot = large if level == 0 else hot
        if not last:
            live = split(large, level + 1)
    return out, hot


def _shared_earlier(key: int, keys: list[np.ndarray]) -> np.ndarray:
    """Which pairs of members meet in a bucket with a smaller key than this one."""
    earlier = [k[k < key] for k in keys]
    if len(keys) == 2:
        met = not set(earlier[0].tolist()).isdisjoint(earlier[1].tolist())
        return np.array([[False, met], [met, False]])
    flat = np.concatenate(earlier)
    owner = np.repeat(np.arange(len(keys)), [len(e) for e in earlier])
    _, which, count = np.unique(flat, return_inverse=True, return_counts=True)
    useful = count[which] > 1
    if not useful.any():
        return np.zeros((len(keys), len(keys)), dtype=bool)
    columns, which = np.unique(which[useful], return_inverse=True)
    incidence = np.zeros((len(keys), len(columns)), dtype=np.float32)
    incidence[owner[useful], which] = 1
    return incidence @ incidence.T > 0


def _open_pairs(group: pa.Table) -> np.ndarray:
    """Which pairs this task has to decide: upper triangle of its block, or one block against the other."""
    m = group.num_rows
    key, i, j = (group.column(c)[0].as_py() for c in ("key", "i", "j"))
    keys = [np.asarray(k, dtype=np.int64) for k in group.column("keys").to_pylist()]
    block = group.column("block").to_numpy()
    pairs = np.triu(np.ones((m, m), dtype=bool), 1) if i == j else (block[:, None] == i) & (block[None, :] == j)
    size = group.column("size").to_numpy().astype(np.float64)
    pairs &= np.minimum(size[:, None], size[None, :]) >= SIMILARITY * np.maximum(size[:, None], size[None, :])
    if pairs.any():
        pairs &= ~_shared_earlier(key, keys)
    return pairs


def _sketch_alike(group: pa.Table, pairs: np.ndarray) -> np.ndarray:
    rows = np.frombuffer(b"".join(group.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, PARTS)
    a, b = np.nonzero(pairs)
    out = np.zeros_like(pairs)
    for lo in range(0, len(a), 1 << 16):
        x, y = rows[a[lo : lo + (1 << 16)]], rows[b[lo : lo + (1 << 16)]]
        used = np.count_nonzero(x | y, axis=1)
        same = np.count_nonzero((x == y) & (x != 0), axis=1)
        near = same >= SKETCH_FLOOR * used
        out[a[lo : lo + (1 << 16)][near], b[lo : lo + (1 << 16)][near]] = True
    return out


_TASK = ["key", "i", "j"]


def _propose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a task that have a partner by their sketches."""
    ready: list[pa.Table] = []
    rows = 0
    schema = None
    for group in sorted_groups(batches, _TASK):
        schema = group.schema
        if group.num_rows < 2:
            continue
        pairs = _open_pairs(group)
        if not pairs.any():
            continue
        pairs = _sketch_alike(group, pairs)
        chosen = pairs.any(axis=0) | pairs.any(axis=1)
        if chosen.any():
            ready.append(group.filter(pa.array(chosen)).drop_columns(["sketch"]))
            rows += int(chosen.sum())
        if rows >= 20_000:
            yield from pa.concat_tables(ready).combine_chunks().to_batches()
            ready, rows = [], 0
    if ready:
        yield from pa.concat_tables(ready).combine_chunks().to_batches()


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, over one range of tokens after the other."""
    if len(sets) == 2:
        common = float(np.isin(sets[0], sets[1], assume_unique=True).sum())
        return np.array([[0.0, common], [common, 0.0]])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[which] > 1
    which, owner = which[shared], owner[shared]
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    column = np.cumsum(np.diff(which, prepend=-1) != 0) - 1
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = max(256, (1 << 22) // len(sets))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        incidence = np.zeros((len(sets), width), dtype=np.float32)
        incidence[owner[a:b], column[a:b] - lo] = 1
        out += incidence @ incidence.T
    return out


def _runs_shared(links: np.ndarray, keys: list[np.ndarray], runs: list[np.ndarray]) -> np.ndarray:
    """In how many runs each linked pair meets."""
    out = np.zeros(links.shape, dtype=np.int16)
    a, b = np.nonzero(links)
    if len(a) <= 4 * len(links):  # few links: pair by pair
        of = [dict(zip(k.tolist(), r.tolist())) for k, r in zip(keys, runs)]
        for x, y in zip(a.tolist(), b.tolist()):
            out[x, y] = len({of[x][k] for k in of[x].keys() & of[y].keys()})
        return out
    for run in sorted({int(r) for own in runs for r in own}):
        own = [k[r == run] for k, r in zip(keys, runs)]
        out += _shared_earlier(np.iinfo(np.int64).max, own)
    return out


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links of a task: per set with links their number and one link that spans its group; by band, with a task's
    first set, how many there are and how rarely they met."""
    out: list[tuple] = []
    names = ["set_id", "links", "near", "bands"]
    types = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def packed() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for group in sorted_groups(batches, _TASK):
        if group.num_rows < 2:
            continue
        pairs = _open_pairs(group)
        if not pairs.any():
            continue
        ids = group.column("set_id").to_pylist()
        sets = [s for part in slices(group.column("text")) for s in shingle_sets(part)]
        for own, given in zip(sets, ids):
            if set_id(own) != given:
                raise ValueError("the documents changed between two reads")
        size = np.array([len(s) for s in sets], dtype=np.float64)
        common = _overlaps(sets).astype(np.float64)
        union = size[:, None] + size[None, :] - common
        links = pairs & (common >= SIMILARITY * union)
        if not links.any():
            continue
        keys = [np.asarray(k, dtype=np.int64) for k in group.column("keys").to_pylist()]
        runs = [np.asarray(r, dtype=np.int64) for r in group.column("runs").to_pylist()]
        met = _runs_shared(links, keys, runs)
        both = links | links.T
        met = np.maximum(met, met.T)
        parent = _forest(both)
        count = both.sum(axis=1)
        level = (group.column("key")[0].as_py() >> LEVEL_AT) & 3
        bands = _band_counts(common[links] < NEAR_THRESHOLD * union[links], met[links], level)
        for x in np.flatnonzero(count):
            out.append((ids[x], int(count[x]), ids[parent[x]] if parent[x] >= 0 else None, bands))
            bands = None
        if len(out) >= 20_000:
            yield packed()
            out = []
    if out:
        yield packed()


def _band_counts(low: np.ndarray, met: np.ndarray, level: int) -> list[int]:
    """Numbers of a task's links by band, all in buckets of one level."""
    out = np.zeros((BANDS, BAND_COUNTS), dtype=np.int64)
    for half, own in enumerate((met[low], met[~low])):
        out[2 * level + half] = len(own), (own == 1).sum(), (own == 2).sum()
    return out.reshape(-1).tolist()


def recall_of_bands(found: np.ndarray, newest: np.ndarray) -> np.ndarray:
    """Estimated recall of each band (1 where it has no links) from all its links and from those of the newest round.

    Both have a row (links, met in one run, met in two) per band. Links the newest round has not found either are estimated from
    those it met once and twice (Chao's estimator). Less than one missed link is none.
    """
    once, twice = newest[:, 1].astype(float), newest[:, 2].astype(float)
    missed = np.where(twice > 0, once**2 / np.maximum(2 * twice, 1), once * (once - 1) / 2)
    missed = np.where(missed < 1, 0, missed)
    return np.where(found[:, 0] > 0, found[:, 0] / np.maximum(found[:, 0] + missed, 1), 1.0)


def _forest(links: np.ndarray) -> np.ndarray:
    """A neighbour nearer the root for each member, -1 for roots and members without links."""
    parent = np.full(len(links), -1)
    seen = np.zeros(len(links), dtype=bool)
    for root in range(len(links)):
        if seen[root]:
            continue
        seen[root] = True
        edge = [root]
        while edge:
            new = links[edge] & ~seen
            reached = np.flatnonzero(new.any(axis=0))
            parent[reached] = np.asarray(edge)[new[:, reached].argmax(axis=0)]
            seen[reached] = True
            edge = reached.tolist()
    return parent


def _sign(docs: DataFrame, folder: str, first_run: int, runs: int, levels: range) -> DataFrame:
    """Signed rows with a set, stored in `folder`; those of later rounds hold the chosen tokens only."""
    arrays = ", ".join(f"level{k} array<array<bigint>>" for k in levels)
    signed = _placed(docs).mapInArrow(
        _signer(first_run, runs, levels), f"doc_id bigint, place {PLACE_TYPE}, set_id binary, size int, sketch binary, {arrays}"
    )
    if first_run:
        signed = signed.select("set_id", "place", *[f"level{k}" for k in levels])
    signed.write.parquet(f"{folder}/signed")
    return docs.sparkSession.read.parquet(f"{folder}/signed")


def _links(
    docs: DataFrame, sets: DataFrame, own: DataFrame, earlier: DataFrame | None, round_: int, bucket_sets: int, folder: str
) -> DataFrame:
    """Links between sets that meet in a round's `own` buckets and met in no `earlier` one."""
    spark = docs.sparkSession
    placed = _placed(docs)
    # Bounded lists: a set is in about 1.25 buckets per run and level.
    lists = (
        (own if earlier is None else own.unionByName(earlier))
        .groupBy("set_id")
        .agg(F.sort_array(F.collect_list(F.struct("key", "run", "n"))).alias("own"))
        .join(sets.select("set_id", "place", "size", "sketch"), "set_id")
        .select("set_id", "place", "size", "sketch", "own.key", "own.run", F.explode("own").alias("b"))
        .select("set_id", "place", "size", "sketch", F.col("key").alias("keys"), F.col("run").alias("runs"), "b.key", "b.n")
    )
    if round_:
        lists = lists.filter(F.col("key") >= round_ << (LEVEL_AT + 2))
    blocks = F.ceil(F.col("n") / F.lit(bucket_sets)).cast("long")
    tasks = (
        lists.withColumn("block", F.pmod(F.xxhash64("set_id"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other", "n")
    )
    columns = f"key bigint, i bigint, j bigint, block bigint, set_id binary, place {PLACE_TYPE}, size int, keys array<bigint>, runs array<int>"
    proposed = (
        tasks.select("key", "i", "j", "block", "set_id", "place", "size", "keys", "runs", "sketch")
        .repartition(*_TASK)
        .sortWithinPartitions(*_TASK)
        .mapInArrow(_propose, columns)
    )
    proposed.write.parquet(f"{folder}/proposed")
    (
        spark.read.parquet(f"{folder}/proposed")
        .join(placed.select("place", "text"), "place")
        .repartition(*_TASK)
        .sortWithinPartitions(*_TASK)
        .mapInArrow(_verify, "set_id binary, links bigint, near binary, bands array<bigint>")
        .write.parquet(f"{folder}/links")
    )
    return spark.read.parquet(f"{folder}/links")


def _counts_by_band(links: DataFrame) -> np.ndarray:
    """Sums over a round's tasks: a row for each band."""
    out = np.zeros(BANDS * BAND_COUNTS, dtype=np.int64)
    for at, n in links.select(F.posexplode("bands").alias("at", "n")).groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out.reshape(BANDS, BAND_COUNTS)


def near_duplicates(
    docs: DataFrame,
    runs: int = RUNS,
    levels: int = LEVELS,
    bucket_sets: int = BUCKET_SETS,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per document: doc_id, place, class_id (its class's smallest doc_id), n_links, kept (the row class_id names).

    n_links counts other shingle sets at a similarity of 0.8 or more. While a band is below the target recall, a
    round is added with as many runs as there were; it signs only those, and keeps all buckets and links so far. While no band of
    the first level is, these runs begin in the buckets that earlier ones split.
    """
    spark = apply_settings(docs.sparkSession)
    docs = stored(docs)
    members = sets = memberships = links = hot = None
    found = np.zeros((BANDS, BAND_COUNTS), dtype=np.int64)
    first_run = first_level = 0
    for round_ in range(ROUNDS):
        folder = new_folder(spark, "ngram-join")
        signed = _sign(docs, folder, first_run, runs, range(first_level, levels))
        if sets is None:
            members = signed.select("doc_id", "place", "set_id")
            with_words = signed.filter("set_id IS NOT NULL")
            holders = with_words.groupBy("set_id").agg(F.min("place").alias("place"))
            sets = chosen = with_words.join(holders, ["set_id", "place"], "left_semi")
        else:
            chosen = signed.join(sets.select("set_id", "place"), ["set_id", "place"], "left_semi")
        again = hot.withColumn("run", F.col("run") + first_run) if first_level else None
        own, split = _buckets(chosen, round_, first_run, levels, bucket_sets, folder, again)
        hot = split if hot is None else hot.unionByName(split)
        new = _links(docs, sets, own, memberships, round_, bucket_sets, folder)
        memberships = own if memberships is None else memberships.unionByName(own)
        links = new if links is None else links.unionByName(new)
        newest = _counts_by_band(new)
        found += newest
        recall = recall_of_bands(found, newest)
        if recall.min() >= target_recall:
            break
        first_level = 0 if recall[:2].min() < target_recall else 1  # two bands a level
        first_run += runs
        runs = first_run
    else:
        raise RuntimeError(f"the recall is below {target_recall} after {first_run} runs")
    roots = components(links.filter("near IS NOT NULL").select(F.col("set_id").alias("a"), F.col("near").alias("b")))
    counts = links.groupBy("set_id").agg(F.sum("links").alias("n_links"))
    linked = roots.join(counts, roots["node"] == counts["set_id"]).select("set_id", "root", "n_links")
    classed = members.join(linked, "set_id", "left").select(
        "doc_id",
        "place",
        # Texts without words stand alone.
        F.coalesce("root", "set_id", F.concat_ws(":", F.col("place.file").cast("string"), F.col("place.row").cast("string")).cast("binary")).alias("root"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    classed.write.parquet(f"{folder}/classed")
    classed = spark.read.parquet(f"{folder}/classed")
    first = classed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("first")
    )
    first.write.parquet(f"{folder}/first")  # so that the join can split a large class
    first = spark.read.parquet(f"{folder}/first")
    return classed.join(first, "root").select(
        "doc_id",
        "place",
        F.col("first.doc_id").alias("class_id"),
        F.col("n_links").cast("long").alias("n_links"),
        (F.col("place") == F.col("first.place")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay: one of each class."""
    apply_settings(docs.sparkSession)
    docs, place = stored(docs), "_place_of_row"
    stay = near_duplicates(docs).filter("kept").select(F.col("place").alias(place))
    return placed(docs, place).join(stay, place, "left_semi").drop(place)
