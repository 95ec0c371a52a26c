import hashlib
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm.prefix_trie import BLOCK_IDS, conversation_trie, pack_trie

SCHEMA = "conv_id long, turn long, role string, text string, base string, depth int, key binary"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "clash", 1, b"x") for r in rows], SCHEMA).repartition(partitions)


def turn_key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def wanted(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, turn_key(role, text), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves = 0 if children[node] else 1
        for child in children[node]:
            leaves, saved = leaves + sums[child][0], saved + sums[child][1]
        sums[node] = (leaves, saved)
    out = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(convs), len(node), parent, len(convs), len(children[node]), *sums[node], digest))
    return out


def found(spark, rows, **sizes):
    conv = F.col("conv_id")
    kept = F.crc32(conv.cast("string").cast("binary")) % 6
    got = conversation_trie(frame(spark, rows), conv - conv % 100, kept, 5, **sizes).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def conversations(seed, convs, longest, alphabet):
    r = random.Random(seed)
    return [
        (c * r.choice([1, 1, 37]), t, r.choice(["user", "assistant", None]), r.choice(alphabet))
        for c in range(convs)
        for t in range(r.randint(1, longest))
    ]


@pytest.mark.parametrize("sizes", [{}, {"band_turns": 3, "shard_turns": 9}, {"band_turns": 1, "shard_turns": 40}, {"shard_turns": 5}])
def test_equals_brute_force(spark, sizes):
    rows = conversations(1, 120, 9, ["", "a", "bb", None, "é🙂"])
    assert found(spark, rows, **sizes) == wanted(rows)


def test_long_conversations_over_many_bands(spark):
    r = random.Random(2)
    rows = [(1000 + c, t, "user", "same" if t < 40 else r.choice("ab")) for c in range(4) for t in range(50 + c)]
    assert found(spark, rows, band_turns=4, shard_turns=16) == wanted(rows)


def test_hot_prefix_and_copies(spark):
    hot = [(c, t, "system", "hot" if t < 7 else "x" * (c % 4)) for c in range(0, 3000, 10) for t in range(8)]
    rows = hot + conversations(3, 40, 5, ["a", "b"])
    assert found(spark, rows, band_turns=4, shard_turns=64) == wanted(rows)


def test_nulls_ties_and_turnless(spark):
    rows = [
        (None, 1, "user", "lost"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (5, 0, "", ""), (5, 3, "u", "x" * 50_000),
        (7, 1, "user", "b"), (7, 1, "user", "a"), (-250, 1, "a", "neg"), (-200, 1, "a", "base"), (-200, 2, "a", "neg"), (101, 1, "u", "t"),
        (102, 1, "u", "t"), (103, 1, "u", "t"), (104, 1, "u", "t"), (105, 1, "u", "t"), (106, 1, "u", "t"),
    ]
    assert found(spark, rows) == wanted(rows)
    assert any(depth == 0 for _, depth, *_ in found(spark, rows[7:]))


def test_empty(spark):
    assert found(spark, []) == set()


def test_ids_are_hashed_over_blocks(spark, monkeypatch):
    monkeypatch.setattr("quayside.llm.prefix_trie.RANGE_ROWS", 50)
    rows = [(c, 9, "u", "same") for c in range(1, 100)] + [(0, t, "u", "z") for t in range(6)]
    assert BLOCK_IDS > 99
    assert found(spark, rows) == wanted(rows)


def test_double_array_holds_its_trie():
    r = np.random.default_rng(4)
    parents, symbols, above = [], [], 1
    for _ in range(5):
        parent = np.sort(r.integers(0, above, 300))
        symbol = r.integers(0, 4000, 300)
        _, first = np.unique(parent * 4000 + symbol, return_index=True)
        first = np.sort(first)
        parents.append(parent[first])
        symbols.append(symbol[first])
        above = len(first)
    trie = pack_trie(parents, symbols)
    places = np.zeros(1, dtype=np.int64)
    for parent, symbol in zip(parents, symbols):
        at = trie.step(places[parent], symbol)
        assert (at > 0).all() and len(set(at.tolist())) == len(at)
        assert (trie.check[at] == places[parent]).all()
        places = at
    assert (trie.step(places, np.full(len(places), 1)) == -1).all()
