"""Prefix tries of conversations, as double arrays per shard.

A conversation is a sequence of turns (role and text, known by a digest of both). Sequences are cut into bands of `BAND`
turns, equal ones are folded, and the rest is ordered by range, so that neighbours share prefixes. Every range is packed into
shards of at most `SHARD_TURNS` turns, one row each, whatever the size of a prefix: a prefix that a third of all
conversations share is spread over many shards.

A shard gives its turns dense ids, numbered along the levels of its trie, and packs the trie into two arrays: the child of node p
by turn t lies at BASE[p] + t, and CHECK there names p. All its sequences then walk the arrays together, a turn at a time,
and leave their counts at the nodes; sums over subtrees follow CHECK upwards. As sequences are in order, only nodes on the
paths of a shard's first and last sequence can be in other shards too. Each such node is owned by the first shard that has it, which the
common prefix with the shard before tells, so what has to be counted once per node is added by its owner, and all
aggregates of upper nodes, subtree sums included, simply add up over shards in one grouping.

Sequences longer than a band go on in the next band below a node that is known by the digest of all turns before. Their subtree
sums are passed up by doubling: the totals of the bands below each such node, then of twice as many bands. Conversations
that end in one node have all turns in common; their ids are put in order by range, joined in blocks, and hashed block by
block, so that no task holds more than a block.

Defined results: rows with a null conv_id take no part; a null role or text counts as empty; turns of equal number are
ordered by the digest of role and text, so only equal turns are interchangeable; repeated turns stay; conversations
without turns belong to the root only; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.textarrays import released
from quayside.session import apply_settings, new_folder

#: Turns of a band, of a shard, and rows of a range.
BAND = 512
SHARD_TURNS = 1 << 17
RANGE_ROWS = 100_000
#: Ids joined into one block.
BLOCK_IDS = 1 << 14

DIGEST = 16


def write_read(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, where lineage ends."""
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


# --- turns and sequences


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1), turn_key and chars; a conversation's turns are ordered over as many tasks as they need."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.substring(digest, 1, 2 * DIGEST)).alias("turn_key"),
        F.length(text).cast("long").alias("chars"),
    )
    turns = write_read(turns, "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("turn_key"), F.col("chars")]
    ranged = turns.repartitionByRange(_ranges(turns.count(), RANGE_ROWS), "conv_id", *order)
    ranged = write_read(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Few conversations lie in two ranges: at most one for each cut between ranges.
    later = parts.withColumn("before", F.sum("n").over(before)).filter(F.col("before").isNotNull())
    own = Window.partitionBy("part", "conv_id").orderBy(*order)
    return (
        ranged.withColumn("own", F.row_number().over(own))
        .join(later.select("conv_id", "part", "before"), ["conv_id", "part"], "left")
        .select("conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).alias("at"), "turn_key", "chars")
    )


def _ranges(rows: int, per: int) -> int:
    return max(2, math.ceil(rows / per))


def rebuilt(turns: DataFrame, base: Column, kept: Column, most: int) -> tuple[DataFrame, int]:
    """Numbered turns of conversations whose first `kept` turns (at most `most`) are replaced by those of conversation `base`,
    and the number of turns of the longest.

    Each has one row more, at 0 and without a turn. `length` is the number of its turns.
    """
    turns = write_read(turns, "numbered")
    heads = (
        turns.filter(F.col("at") <= most)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "turn_key", "chars"))).alias("head"))
        .select(F.col("conv_id").alias("base"), "head")
    )
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("base", base).withColumn("kept", kept.cast("long"))
    convs = convs.join(heads, "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("kept").cast("int")))
    convs = convs.withColumn("headed", F.size("head").cast("long"))
    convs = convs.withColumn("length", F.col("headed") + F.greatest(F.col("n") - F.col("kept"), F.lit(0)))
    convs = write_read(convs.select("conv_id", "kept", "headed", "length", "head"), "rebuilt")
    longest = convs.agg(F.max("length")).first()[0] or 0
    opened = convs.select("conv_id", "length", F.explode("head").alias("t")).select("conv_id", "length", "t.at", "t.turn_key", "t.chars")
    none = F.lit(None).cast("binary").alias("turn_key")
    starts = convs.select("conv_id", "length", F.lit(0).cast("long").alias("at"), none, F.lit(0).cast("long").alias("chars"))
    own = turns.join(convs.select("conv_id", "kept", "headed", "length"), "conv_id").filter(F.col("at") > F.col("kept"))
    own = own.select("conv_id", "length", (F.col("at") - F.col("kept") + F.col("headed")).alias("at"), "turn_key", "chars")
    return starts.unionByName(opened).unionByName(own), longest


def banded(rows: DataFrame, band_turns: int, several: bool) -> DataFrame:
    """conv_id, band, turn_keys, chars, is_last, and digests of all turns before the band (before_a, _b) and up to its end.

    A prefix is known by the exclusive or of the digests of its bands with their numbers, twice 64 bits.
    """
    band = F.floor(F.greatest(F.col("at") - 1, F.lit(0)) / band_turns).cast("int")
    turn = F.when(F.col("at") > 0, F.struct("at", "turn_key", "chars"))
    bands = rows.groupBy("conv_id", "length", band.alias("band")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    bands = bands.select(
        "conv_id", "band", F.col("turns.turn_key").alias("turn_keys"), F.col("turns.chars").alias("chars"),
        (F.col("length") <= (F.col("band") + 1) * band_turns).alias("is_last"),
    )
    bands = write_read(bands.withColumns({f"own_{s}": F.xxhash64(F.lit(s), "band", "turn_keys") for s in "ab"}), "bands")
    upto = Window.partitionBy("conv_id").orderBy("band")
    if several:
        slim = bands.select("conv_id", "band", *(F.bit_xor(f"own_{s}").over(upto).alias(f"after_{s}") for s in "ab"))
        bands = bands.join(slim, ["conv_id", "band"])
    else:
        bands = bands.withColumns({f"after_{s}": F.col(f"own_{s}") for s in "ab"})
    return bands.withColumns({f"before_{s}": F.col(f"after_{s}").bitwiseXOR(F.col(f"own_{s}")) for s in "ab"}).drop("own_a", "own_b")


def folded(bands: DataFrame) -> DataFrame:
    """Each different band of turns once, with how many conversations have it, end in it, and the smallest of them."""
    same = ["band", "before_a", "before_b", "after_a", "after_b"]
    return bands.groupBy(*same).agg(
        F.first("turn_keys").alias("turn_keys"),
        F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_last").cast("long")).alias("ends"),
        F.min("conv_id").alias("least"),
    )


# --- shards

#: Of each sequence of a shard, in order.
EACH = {c: pa.int64() for c in ("band", "before_a", "before_b", "after_a", "after_b", "n", "ends", "least", "below_leaves", "below_saved")}
SHARD_TYPE = pa.schema([
    ("part", pa.int32()), ("number", pa.int32()), *((c, pa.list_(t)) for c, t in EACH.items()), ("sizes", pa.list_(pa.int64())),
    ("turn_keys", pa.list_(pa.binary())), ("chars", pa.list_(pa.int64())), ("shared_before", pa.int32()), ("shared_after", pa.int32()),
    ("first_key", pa.list_(pa.binary())), ("last_key", pa.list_(pa.binary())),
])
SHARD = (
    "part int, number int, " + ", ".join(f"{c} array<long>" for c in EACH) + ", sizes array<long>, turn_keys array<binary>, "
    "chars array<long>, shared_before int, shared_after int, first_key array<binary>, last_key array<binary>"
)


def prefix_key(band: int, a: int, b: int) -> bytes:
    """Identity of the node below which sequences of a band start."""
    return b"".join(int(x).to_bytes(8, "big", signed=True) for x in (band, a, b))


def _key(table: pa.Table, row: int) -> list[bytes]:
    """A sequence as symbols: the node it hangs below, then its turns."""
    return [prefix_key(*(table.column(c)[row].as_py() for c in ("band", "before_a", "before_b"))), *table.column("turn_keys")[row].as_py()]


def common(a: list[bytes], b: list[bytes]) -> int:
    """Symbols that two keys share from the start."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packer(shard_turns: int):
    """mapInArrow: a range's sequences, in order, as shards, one row each.

    shared_before: symbols that the first sequence shares with the one before it; shared_after: those that the last shares with
    the one after it. At the ends of the range they are -1, with the sequences beside, for the join with the neighbour.
    """

    def row(shard: pa.Table, number: int, before: int, after: int) -> pa.RecordBatch:
        shard = shard.combine_chunks()
        column = {c: shard.column(c).chunk(0) for c in shard.column_names}
        keys = [pa.array([_key(shard, i) if at_end else None], pa.list_(pa.binary())) for i, at_end in ((0, before < 0), (shard.num_rows - 1, after < 0))]
        whole = [
            pa.array([column["part"][0].as_py()], pa.int32()), pa.array([number], pa.int32()),
            *(_one_list(column[c].cast(t)) for c, t in EACH.items()), _one_list(pc.list_value_length(column["turn_keys"]).cast(pa.int64())),
            _one_list(column["turn_keys"].flatten()), _one_list(column["chars"].flatten()),
            pa.array([before], pa.int32()), pa.array([after], pa.int32()), *keys,
        ]
        return pa.RecordBatch.from_arrays(whole, schema=SHARD_TYPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held, weight = 0, -1, None, 0
        for batch in released(batches):
            table = pa.Table.from_batches([batch])
            turns = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("turn_keys")).to_numpy(zero_copy_only=False) + 1)])
            at = 0
            while at < table.num_rows:
                # As many rows as the open shard has room for, one at least if it is empty.
                stop = int(np.searchsorted(turns, turns[at] + shard_turns - weight, side="right")) - 1
                stop = max(stop, at + (held is None))
                if stop > at:
                    piece = table.slice(at, stop - at)
                    held = piece if held is None else pa.concat_tables([held, piece])
                    weight += int(turns[stop] - turns[at])
                    at = stop
                if at < table.num_rows:
                    after = common(_key(held, held.num_rows - 1), _key(table, at))
                    yield row(held, number, before, after)
                    number, before, held, weight = number + 1, after, None, 0
        if held is not None:
            yield row(held, number, before, -1)

    return run


def shards(sequences: DataFrame, shard_turns: int) -> DataFrame:
    """The sequences as stored shards that know what they share with their neighbours."""
    order = ["band", "before_a", "before_b", "turn_keys"]
    turns = sequences.agg(F.sum(F.size("turn_keys") + 1)).first()[0] or 0
    ranged = sequences.repartitionByRange(_ranges(turns, shard_turns), *order).withColumn("part", F.spark_partition_id())
    packed = write_read(ranged.sortWithinPartitions(*order).mapInArrow(_packer(shard_turns), SHARD), "shards")
    # A row for each range that has sequences.
    ends = packed.groupBy("part").agg(
        F.max_by("first_key", F.when(F.col("shared_before") < 0, 1)).alias("first_key"),
        F.max_by("last_key", F.when(F.col("shared_after") < 0, 1)).alias("last_key"),
    )
    ends = write_read(ends, "ends")
    ranks = ends.select("part", F.row_number().over(Window.orderBy("part")).alias("rank"))
    ends = ends.join(ranks, "part")
    former = ends.select((F.col("rank") + 1).alias("rank"), F.col("last_key").alias("other"))
    equal = F.zip_with("first_key", "other", lambda x, y: F.coalesce(x == y, F.lit(False)))
    cuts = ends.join(former, "rank", "left").select("part", "rank", F.coalesce(F.array_position(equal, False) - 1, F.lit(0)).cast("int").alias("cut"))
    cuts = write_read(cuts, "cuts")
    following = cuts.select((F.col("rank") - 1).alias("rank"), F.col("cut").alias("next_cut"))
    cuts = cuts.join(following, "rank", "left").select("part", "cut", F.coalesce("next_cut", F.lit(0)).alias("next_cut"))
    return packed.drop("first_key", "last_key").join(cuts, "part").withColumns({
        "shared_before": F.when(F.col("shared_before") < 0, F.col("cut")).otherwise(F.col("shared_before")),
        "shared_after": F.when(F.col("shared_after") < 0, F.col("next_cut")).otherwise(F.col("shared_after")),
    }).drop("cut", "next_cut")


# --- the double array of a shard


@dataclass
class DoubleArray:
    """Node 0 is the root. The child of node p by symbol s is at base[p] + s if check there is p."""

    base: np.ndarray
    check: np.ndarray

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        at = self.base[nodes] + symbols
        able = (at > 0) & (at < len(self.check))
        at = np.where(able, at, 0)
        return np.where(able & (self.check[at] == nodes), at, -1)


class _Slots:
    """CHECK while it is filled: -1 is free; below `low` nothing is."""

    def __init__(self, size: int) -> None:
        self.check = np.full(size, -1, dtype=np.int64)
        self.check[0] = 0
        self.low = 1

    def free(self) -> np.ndarray:
        found = np.flatnonzero(self.check[self.low :] < 0) + self.low
        self.low = int(found[0]) if len(found) else len(self.check)
        return found

    def grow(self, by: int) -> None:
        self.check = np.concatenate([self.check, np.full(max(by, len(self.check) // 2), -1, dtype=np.int64)])

    def singles(self, count: int) -> np.ndarray:
        found = self.free()
        if len(found) < count:
            self.grow(count)
            found = self.free()
        return found[:count]

    def base(self, symbols: np.ndarray) -> int:
        """The first base that puts all of a node's symbols, in order, on free places."""
        steps = symbols - symbols[0]
        while True:
            found = self.free()
            found = found[found + steps[-1] < len(self.check)]
            for at in range(0, len(found), 256):
                own = found[at : at + 256]
                good = np.ones(len(own), dtype=bool)
                for k in range(1, len(steps), 64):
                    good &= (self.check[own[:, None] + steps[None, k : k + 64]] < 0).all(axis=1)
                if good.any():
                    return int(own[np.argmax(good)] - symbols[0])
            self.grow(int(steps[-1]) + 1)


def pack_trie(parents: list[np.ndarray], symbols: list[np.ndarray]) -> DoubleArray:
    """The double array of a trie given by levels: each node's parent, a place in the level before, rising; and its symbol."""
    nodes = sum(map(len, parents))
    slots = _Slots(nodes + nodes // 4 + 64)
    bases: list[tuple[np.ndarray, np.ndarray]] = []
    above = np.zeros(1, dtype=np.int64)
    for parent, symbol in zip(parents, symbols):
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        sizes = np.diff(np.r_[first, len(parent)])
        places, base = np.zeros(len(parent), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        # Large families while there are long free runs; only children then fill gaps, all at once.
        for family in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
            own = slice(first[family], first[family] + sizes[family])
            base[family] = slots.base(np.sort(symbol[own]))
            places[own] = base[family] + symbol[own]
            slots.check[places[own]] = above[parent[first[family]]]
        single = np.flatnonzero(sizes == 1)
        found = slots.singles(len(single))
        places[first[single]], base[single] = found, found - symbol[first[single]]
        slots.check[found] = above[parent[first[single]]]
        bases.append((above[parent[first]], base))
        above = places
    out = np.zeros(len(slots.check), dtype=np.int64)
    for node, base in bases:
        out[node] = base
    return DoubleArray(out, slots.check)


# --- nodes

NODE = (
    "shared boolean, top boolean, key binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, end_a long, end_b long"
)
NODE_TYPE = pa.schema([
    ("shared", pa.bool_()), ("top", pa.bool_()), ("key", pa.binary()), ("above", pa.binary()),
    *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_a", "end_b")),
])


class _Shard:
    """A shard's sequences as dense symbols, and the levels of its trie."""

    def __init__(self, row: dict) -> None:
        self.each = {c: row[c].to_numpy(zero_copy_only=False) for c in EACH}
        self.sizes = row["sizes"].to_numpy(zero_copy_only=False)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.turn_keys, self.chars = row["turn_keys"], row["chars"].to_numpy(zero_copy_only=False)
        self.shared_before, self.shared_after = row["shared_before"], row["shared_after"]
        starts = np.stack([self.each[c] for c in ("band", "before_a", "before_b")])
        new = np.r_[True, (starts[:, 1:] != starts[:, :-1]).any(axis=0)]
        self.top = np.cumsum(new) - 1
        codes = np.asarray(self.turn_keys.dictionary_encode().indices, dtype=np.int64)
        self.shared = self._shared(codes)
        self._levels(new, codes)

    def _shared(self, codes: np.ndarray) -> np.ndarray:
        """Turns that each sequence shares with the one before it; -1 if they hang below different nodes."""
        out = np.full(len(self.sizes), -1, dtype=np.int64)
        at, level = np.flatnonzero(self.top[1:] == self.top[:-1]) + 1, 0
        while len(at):
            out[at] = level
            at = at[(self.sizes[at] > level) & (self.sizes[at - 1] > level)]
            at, level = at[codes[self.begins[at] + level] == codes[self.begins[at - 1] + level]], level + 1
        return out

    def _levels(self, new: np.ndarray, codes: np.ndarray) -> None:
        """Per level the sequences that reach it, and of its nodes the parents and symbols."""
        node = self.top.copy()
        tops = int(new.sum())
        self.alive, self.parents, found = [np.arange(len(self.sizes))], [np.zeros(tops, dtype=np.int64)], []
        for depth in range(1, int(self.sizes.max(initial=0)) + 1):
            alive = np.flatnonzero(self.sizes >= depth)
            first = self.shared[alive] < depth
            self.alive.append(alive)
            self.parents.append(node[alive[first]])
            found.append(codes[self.begins[alive[first]] + depth - 1])
            node[alive] = np.cumsum(first) - 1
        # Dense ids in the order of the levels: what is new below one node has ids in a row.
        dense = np.zeros(len(codes) + 1, dtype=np.int64)
        if found:
            seen, at = np.unique(np.concatenate(found), return_index=True)
            dense[seen[np.argsort(at)]] = tops + np.arange(len(seen))
        self.symbols = [np.arange(tops), *(dense[c] for c in found)]
        self.codes = dense[codes]


def shard_nodes(row: dict) -> pa.RecordBatch:
    """The nodes of a shard: all its sequences walk the double array together."""
    own = _Shard(row)
    trie = pack_trie(own.parents, own.symbols)
    size = len(trie.check)
    zeros = lambda: np.zeros(size, dtype=np.int64)
    n_convs, depth, children, leaves, saved, chars = (zeros() for _ in range(6))
    least = np.full(size, np.iinfo(np.int64).max)
    end = np.full((2, size), 0, dtype=np.int64)
    ended, owned, top, known = (np.zeros(size, dtype=bool) for _ in range(4))
    keys: dict[int, bytes] = {}
    rows = len(own.sizes)
    goes_on = own.each["n"] > own.each["ends"]
    shared_next = np.r_[own.shared[1:], own.shared_after - 1]
    node = np.zeros(rows, dtype=np.int64)
    levels: list[np.ndarray] = []
    hashers = [hashlib.blake2b(digest_size=DIGEST) for _ in range(2)]
    for level, alive in enumerate(own.alive):
        symbols = own.codes[own.begins[alive] + level - 1] if level else own.top
        at = trie.step(node[alive], symbols)
        assert (at > 0).all(), "a sequence left its trie"
        node[alive] = at
        np.add.at(n_convs, at, own.each["n"][alive])
        np.minimum.at(least, at, own.each["least"][alive])
        depth[at] = own.each["band"][alive] * row["band_turns"] + level
        known[at], owned[at] = True, True
        if level:
            chars[at] = own.chars[own.begins[alive] + level - 1]
        else:
            top[at] = True
        # Nodes that the neighbours have too lie on the first and the last sequence.
        for hasher, i, far in ((hashers[0], 0, own.shared_before), (hashers[1], rows - 1, own.shared_after)):
            if far <= level or own.sizes[i] < level:
                continue
            if level:
                hasher.update(own.turn_keys[int(own.begins[i] + level - 1)].as_py())
                keys[int(node[i])] = hasher.digest()
            else:
                hasher.update(prefix_key(*(own.each[c][i] for c in ("band", "before_a", "before_b"))))
        if own.shared_before > level:
            owned[node[0]] = False
        last = alive[own.sizes[alive] == level]
        leaf = np.where(level == row["band_turns"], ~goes_on[last], shared_next[last] < level)
        leaves[node[last]] = leaf + own.each["below_leaves"][last]
        saved[node[last]] = own.each["below_saved"][last]
        done = last[own.each["ends"][last] > 0]
        ended[node[done]] = True
        end[0][node[done]], end[1][node[done]] = own.each["after_a"][done], own.each["after_b"][done]
        if level == row["band_turns"]:
            for i in last[goes_on[last]].tolist():
                keys[int(node[i])] = prefix_key(own.each["band"][i] + 1, own.each["after_a"][i], own.each["after_b"][i])
        levels.append(np.unique(at))
    for i in np.flatnonzero(np.r_[True, own.top[1:] != own.top[:-1]]).tolist():
        start = int(trie.base[0] + own.top[i])
        if own.each["band"][i] > 0 or own.shared_before > 0 or own.shared_after > 0:
            keys[start] = prefix_key(*(own.each[c][i] for c in ("band", "before_a", "before_b")))
    saved += (n_convs - owned) * chars
    for at in reversed(levels[1:]):
        np.add.at(leaves, trie.check[at], leaves[at])
        np.add.at(saved, trie.check[at], saved[at])
        np.add.at(children, trie.check[at], owned[at].astype(np.int64))
    return _node_rows(trie, known, top, keys, ended, end, least, depth, n_convs, children, leaves, saved)


def _node_rows(trie, known, top, keys, ended, end, least, depth, n_convs, children, leaves, saved) -> pa.RecordBatch:
    at = np.flatnonzero(known)
    parent = trie.check[at]
    is_top = top[at]
    key = pa.array([keys.get(x) for x in at.tolist()], pa.binary())
    above = pa.array([None if t else keys.get(x) for x, t in zip(parent.tolist(), is_top.tolist())], pa.binary())
    orphan = is_top | above.is_valid().to_numpy(zero_copy_only=False)
    return pa.RecordBatch.from_arrays(
        [
            key.is_valid(), pa.array(is_top & (depth[at] > 0)), key, above, pa.array(least[at]), pa.array(depth[at]),
            pa.array(least[parent], mask=orphan), pa.array(n_convs[at]), pa.array(children[at]), pa.array(leaves[at]), pa.array(saved[at]),
            *(pa.array(e[at], mask=~ended[at]) for e in end),
        ],
        schema=NODE_TYPE,
    )


def _walker(band_turns: int):
    """mapInArrow: the nodes of each shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in (*EACH, "sizes", "turn_keys", "chars")}
                row |= {c: batch.column(c)[i].as_py() for c in ("shared_before", "shared_after")}
                yield shard_nodes(row | {"band_turns": band_turns})

    return run


def _start_key(band: Column, a: str, b: str) -> Column:
    """prefix_key of columns."""
    return F.unhex(F.concat(*(F.lpad(F.hex(c.cast("long")), 16, "0") for c in (band, F.col(a), F.col(b)))))


def passed_up(sequences: DataFrame, parts: DataFrame, band_turns: int) -> DataFrame:
    """The sequences with below_leaves and below_saved: the subtree sums of where they go on in the next band.

    `parts` are the nodes of all shards without these sums. By doubling, each step adds those of twice as many bands below.
    """
    goes_on = (F.size("turn_keys") == band_turns) & (F.col("n") > F.col("ends"))
    start = _start_key(F.col("band"), "before_a", "before_b")
    below = _start_key(F.col("band") + 1, "after_a", "after_b")
    edges = sequences.filter(goes_on).select(below.alias("key"), F.when(F.col("band") > 0, start).alias("up"))
    sums = parts.filter("top").groupBy("key").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    current = write_read(sums.join(edges, "key"), "below")
    while current.filter("up IS NOT NULL").limit(1).count():
        more = current.filter("up IS NOT NULL").groupBy(F.col("up").alias("key"))
        more = more.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = current.select(F.col("key").alias("up"), F.col("up").alias("higher"))
        current = current.join(more, "key", "left").join(higher, "up", "left").select(
            "key", F.col("higher").alias("up"),
            *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
        )
        current = write_read(current, "below")
    sums = current.select(F.col("key").alias("below"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
    return (
        sequences.drop("below_leaves", "below_saved")
        .withColumn("below", F.when(goes_on, below))
        .join(sums, "below", "left")
        .withColumns({"below_leaves": F.coalesce("l", F.lit(0)), "below_saved": F.coalesce("s", F.lit(0))})
        .drop("below", "l", "s")
    )


# --- members that end in a node


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: ids in order as comma-joined blocks of at most BLOCK_IDS of one node each."""
    for batch in released(batches):
        a, b, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("after_a", "after_b", "conv_id"))
        if not len(ids):
            continue
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        stops = np.r_[first[1:], len(ids)]
        cuts = [x for lo, hi in zip(first.tolist(), stops.tolist()) for x in range(lo, hi, BLOCK_IDS)] + [len(ids)]
        text = batch.column("conv_id").cast(pa.string()).to_pylist()
        joined = [",".join(text[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
        at = cuts[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[at]), pa.array(b[at]), pa.array(ids[at]), pa.array(joined, pa.string())], names=["end_a", "end_b", "first", "ids"]
        )


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: SHA-256 of each node's blocks, which come in order; none is kept."""
    node, hasher = None, None
    for batch in released(batches):
        ends_a, ends_b, digests = [], [], []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("end_a", "end_b", "ids"))):
            if (a, b) == node:
                hasher.update(b",")
            else:
                if node is not None:
                    ends_a.append(node[0]), ends_b.append(node[1]), digests.append(hasher.hexdigest())
                node, hasher = (a, b), hashlib.sha256()
            hasher.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ends_a, pa.int64()), pa.array(ends_b, pa.int64()), pa.array(digests, pa.string())], names=["end_a", "end_b", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([hasher.hexdigest()])], names=["end_a", "end_b", "ends_sha256"])


def member_digests(last: DataFrame) -> DataFrame:
    """end_a, end_b, ends_sha256 of the ids that end in each node, in order and joined by commas."""
    last = last.select("after_a", "after_b", "conv_id")
    order = ["after_a", "after_b", "conv_id"]
    ranged = last.repartitionByRange(_ranges(last.count(), RANGE_ROWS), *order).sortWithinPartitions(*order)
    blocks = write_read(ranged.mapInArrow(_blocks, "end_a long, end_b long, first long, ids string"), "blocks")
    each = blocks.repartition("end_a", "end_b").sortWithinPartitions("end_a", "end_b", "first")
    return each.mapInArrow(_hashed, "end_a long, end_b long, ends_sha256 string")


# --- the operator


def conversation_trie(
    conversations: DataFrame, base: Column, kept: Column, most: int, band_turns: int = BAND, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """The prefix tree of `conversations` (conv_id, turn, role, text) whose first `kept` turns come from conversation `base`.

    One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over its
    subtree, code points of its last text for each member but one) and ends_sha256 of the members that end there.
    `base` and `kept` (at most `most`) are expressions of conv_id; kept = 0 leaves a conversation as it is.
    """
    apply_settings(conversations.sparkSession)
    rows, longest = rebuilt(numbered_turns(conversations), base, kept, most)
    several = longest > band_turns
    bands = banded(rows, band_turns, several)
    sequences = folded(bands).withColumns({"below_leaves": F.lit(0).cast("long"), "below_saved": F.lit(0).cast("long")})
    sequences = write_read(sequences, "sequences")
    walk = lambda seqs: write_read(shards(seqs, shard_turns).mapInArrow(_walker(band_turns), NODE), "nodes")
    parts = walk(sequences)
    if several:
        parts = walk(write_read(passed_up(sequences, parts, band_turns), "sequences"))
    real = lambda c: F.sum(F.when(F.col("top"), 0).otherwise(F.col(c))).alias(c)
    upper = parts.filter("shared").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("above").alias("above"),
        F.max("parent_conv_id").alias("parent_conv_id"), real("n_convs"), F.sum("n_children").alias("n_children"), real("n_leaves"),
        real("saved_tokens"), F.max("end_a").alias("end_a"), F.max("end_b").alias("end_b"),
    )
    upper = write_read(upper, "upper")
    nodes = parts.filter("NOT shared").select(*(c for c in upper.columns)).unionByName(upper)
    nodes = nodes.join(upper.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv_id")), "above", "left")
    ends = member_digests(bands.filter("is_last"))
    return nodes.join(ends, ["end_a", "end_b"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
