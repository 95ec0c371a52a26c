import random
import re
from itertools import combinations

import numpy as np
import pytest

from quayside.llm.components import components
from quayside.llm import ngram_join
from quayside.llm.ngram_join import drop_near_duplicates, near_duplicates, recall_of_bands


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Class and number of links of every row (rows by position)."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {}
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
            if sets[a] != sets[b]:
                links.setdefault(sets[a], set()).add(sets[b])
                links.setdefault(sets[b], set()).add(sets[a])
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), (True, 0)), (d is None, d or 0))
    return sorted(
        [(d, None if smallest[find(i)][0] else smallest[find(i)][1], len(links.get(sets[i], ()))) for i, (d, _) in enumerate(rows)], key=str
    )


def edited(text, seed, edits):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows(prose, edges):
    out = list(edges)
    for g in range(12):  # groups about the threshold
        base = prose(1000 + g, 60 + 20 * g)
        out += [(1000 + 20 * g + k, edited(base, 50 * g + k, k % 4)) for k in range(8)]
    hot = prose(7, 150)
    out += [(5000 + k, edited(hot, k, k % 3)) for k in range(120)]
    shared = prose(9, 60)
    out += [(7000 + k, shared + " " + prose(k + 5000, 60)) for k in range(40)]
    return out + [(9000 + k, prose(20_000 + k, 50)) for k in range(50)]


@pytest.mark.parametrize("bucket_sets", [256, 16])
def test_equals_brute_force(documents, rows, bucket_sets):
    got = near_duplicates(documents(rows), bucket_sets=bucket_sets).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute(rows)
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_one_row_of_each_class_stays(documents, rows):
    docs = documents(rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    marked = near_duplicates(docs).filter("kept")
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in marked.collect())))


def test_runs_are_repeated_until_the_recall_is_reached(documents, rows):
    got = near_duplicates(documents(rows), runs=1).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute(rows)


@pytest.mark.parametrize("bucket_sets, rounds", [(256, 2), (16, 3)])
def test_further_rounds_add_what_was_missed_and_nothing_twice(documents, rows, bucket_sets, rounds, monkeypatch):
    asked = []

    def once_more(found, newest):
        asked.append((found.copy(), newest.copy()))
        return np.array([float(len(asked) == rounds)])

    monkeypatch.setattr(ngram_join, "recall_of_bands", once_more)
    got = near_duplicates(documents(rows), bucket_sets=bucket_sets).collect()
    assert len(asked) == rounds
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute(rows)
    assert asked[0][0][:, 0].sum() >= 0.95 * asked[-1][0][:, 0].sum() > 0
    assert (asked[1][0] == asked[0][0] + asked[1][1]).all()


@pytest.mark.parametrize("rounds", [2, 3])
def test_rounds_for_lower_levels_split_large_buckets_again(documents, rows, rounds, monkeypatch):
    asked, begun = [], []

    def lower_bands_short(found, newest):
        asked.append((found.copy(), newest.copy()))
        return np.array([1.0, 1.0] + [float(len(asked) == rounds)] * (ngram_join.BANDS - 2))

    sign = ngram_join._sign
    monkeypatch.setattr(ngram_join, "recall_of_bands", lower_bands_short)
    monkeypatch.setattr(ngram_join, "_sign", lambda docs, folder, first, runs, levels: begun.append((first, runs, levels)) or sign(docs, folder, first, runs, levels))
    got = near_duplicates(documents(rows), runs=4, bucket_sets=4).collect()
    assert begun == [(0, 4, range(3)), (4, 4, range(1, 3)), (8, 8, range(1, 3))][:rounds]
    want = brute(rows)
    # Four runs may miss a link; none is found twice, and none is found that is not there.
    links = {r.doc_id: r.n_links for r in got}
    assert all(links[doc] <= n for doc, _, n in want if doc is not None)
    assert asked[-1][0][:, 0].sum() == sum(newest[:, 0].sum() for _, newest in asked)
    assert all((newest[:2] == 0).all() for _, newest in asked[1:])


def test_splitting_again_finds_pairs_that_were_parted(documents, prose, monkeypatch):
    """Near copies with a passage that hundreds of other texts share, split by one run of three levels."""
    passage = prose(5, 60)
    near = [(k, f"{passage} {prose(77, 8)} tail{k}") for k in range(40)]
    other = [(1000 + k, f"{prose(3_000 + k, 120)} {passage}") for k in range(200)]
    first = []

    def until_whole(found, newest):
        first.append(found[:, 0].sum())
        return np.array([1.0, 1.0] + [float(len(first) == 6)] * (ngram_join.BANDS - 2))

    monkeypatch.setattr(ngram_join, "recall_of_bands", until_whole)
    got = near_duplicates(documents(near + other), runs=2, bucket_sets=16).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute(near + other)


def test_one_band_below_the_target_is_seen():
    found = np.zeros((ngram_join.BANDS, 3), dtype=np.int64)
    found[1] = 1_000_000, 0, 3  # a large group of close copies
    assert recall_of_bands(found, found).min() == 1
    found[4] = 100, 40, 30  # few links near the threshold in buckets of the last level
    worst = recall_of_bands(found, found)
    assert worst[4] == pytest.approx(100 / (100 + 40**2 / 60)) and worst.argmin() == 4
    newest = np.zeros_like(found)
    newest[4] = 5, 2, 3  # less than one link is left
    assert recall_of_bands(found, newest).min() == 1


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert [r.n_links for r in near_duplicates(documents([(1, "a b c")])).collect()] == [0]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
