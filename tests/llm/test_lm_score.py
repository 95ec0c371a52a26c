import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import quayside.llm.lm_score as lm
from quayside.llm.lm_score import Filter, Layout, layout, score_documents
from quayside.llm.queries import remainder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def brute(rows):
    counts = Counter(x for d, t in rows if not held(d) for x in toks(t))
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(toks(t)), sum(counts[x] > 0 for x in toks(t)), n, sum(log10((counts[x] + 1) / (n + v + 1)) for x in toks(t))) for d, t in rows]


@pytest.mark.parametrize("head", [1 << 20, 4])
def test_base_equals_brute_force(documents, prose, edges, head, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_TOKENS", head)
    rows = edges + [(100 + i, prose(i % 30, 40).title()) for i in range(60)]
    got = score_documents(documents(rows), remainder(7) != 2).collect()
    key = lambda x: (str(x[0]), x[2], x[5])
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_scores_follow_exact_counts(documents, prose):
    rows = [(i, prose(i % 25, 40)) for i in range(80)]
    counts, pairs = Counter(), Counter()
    for d, t in rows:
        if not held(d):
            counts.update(toks(t))
            pairs.update(zip([None, *toks(t)], toks(t)))
    level = lambda c: (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0
    base = sum(counts.values()) + len(counts) + 1

    def score(t):
        total = 0.0
        for a, b in zip([None, *toks(t)], toks(t)):
            ca, cab = counts[a], level(pairs[a, b])
            total += log10((min(cab, ca) + lm.PRIOR * (counts[b] + 1) / base) / (ca + lm.PRIOR))
        return total

    got = {r.doc_id: r.score for r in score_documents(documents(rows), remainder(7) != 2).collect()}
    assert [got[d] for d, _ in rows] == pytest.approx([score(t) for _, t in rows], rel=1e-3)


def test_probabilities_add_up(documents):
    """Every known token and one unknown after a predecessor, each scored as the last word of a text."""
    words = [f"w{i}" for i in range(12)]
    train = [(i, f"{words[i % 3]} {words[i % 12]} {words[(i * 5) % 12]}") for i in range(200)]
    pairs = Counter(p for _, t in train for p in zip(toks(t), toks(t)[1:]))
    counts = Counter(x for _, t in train for x in toks(t))
    asked = [(1000 + k, f"{a} {b}") for k, (a, b) in enumerate((a, b) for a in words[:5] for b in [*words, "unseen"])]
    docs = documents([*train, *asked, *[(2000 + k, a) for k, a in enumerate(words[:5])]])
    got = {r.doc_id: r.score for r in score_documents(docs, F.col("doc_id") < 1000).collect()}
    base = sum(counts.values()) + len(counts) + 1
    level = lambda c: (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0

    def chance(a, b):
        return (min(level(pairs[a, b]), counts[a]) + lm.PRIOR * (counts[b] + 1) / base) / (counts[a] + lm.PRIOR)

    ends = {a: got[2000 + k] for k, a in enumerate(words[:5])}  # the word after an end, then an end
    for a in words[:5]:
        total = chance(a, None)
        for k, (own, b) in enumerate((x, y) for x in words[:5] for y in [*words, "unseen"]):
            if own == a:
                after = 10 ** (got[1000 + k] - (ends[a] - log10(chance(a, None)))) / chance(b, None)
                assert after == pytest.approx(chance(a, b), rel=1e-6)
                total += after
        quantised = sum(min(level(n), counts[a]) - n for (x, _), n in pairs.items() if x == a)
        assert total == pytest.approx(1 + quantised / (counts[a] + lm.PRIOR), rel=1e-6)
        assert 0.7 < total < 1.5


def test_filter_never_errs_downwards():
    shape = Layout(4, 4096)
    random = np.random.default_rng(5)
    gram = np.unique(random.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2))
    level = random.integers(1, 6, len(gram))
    bits = np.zeros(4 * 4096, dtype=bool)
    for g, q in zip(gram, level):
        for k in range(1, int(q) + 1):
            for place in shape.places(np.array([g]), k):
                bits[place + shape.segment(np.array([g])) * 4096] = True
    got = Filter(shape, np.packbits(bits, bitorder="little")).counts(gram)
    exact = (3 * 2.0 ** (level - 1) - 1) / 2
    assert (got >= exact).all() and (got == exact).mean() > 0.9


def test_layout_is_bounded():
    for n in (0, 1, 10**6, 10**9, 10**13):
        shape = layout(n)
        assert lm.MIN_BITS <= shape.segments * shape.segment_bits <= lm.MAX_BITS and shape.segment_bits >= 512


def test_empty_tables(documents):
    assert score_documents(documents([]), F.lit(True)).count() == 0
    untaught = score_documents(documents([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {(r.n_tokens, r.n_known, r.base_score) for r in untaught} == {(3, 0, 0.0), (1, 0, 0.0)}


def test_filter_grows_with_the_training_text():
    for n in (10**6, 10**8, 4 * 10**9, 10**12):
        shape = layout(n)
        assert shape.segments * shape.segment_bits >= lm.BITS_PER_TOKEN * n  # 64 MB at most before
        assert shape.segment_bits <= 1 << 26  # and a task holds one segment


def test_units_and_segments_change_nothing(documents, prose, edges, monkeypatch):
    rows = edges + [(100 + i, prose(i % 30, 40)) for i in range(60)]
    docs = documents(rows)
    one = sorted(map(str, score_documents(docs, remainder(7) != 2).drop("base_score", "score").collect()))
    scores = sorted(r.score for r in score_documents(docs, remainder(7) != 2).collect())
    monkeypatch.setattr(lm, "UNIT_TOKENS", 1)
    monkeypatch.setattr(lm, "HEAD_TOKENS", 4)
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 128)
    found = score_documents(docs, remainder(7) != 2).collect()
    assert sorted(str(r) for r in score_documents(docs, remainder(7) != 2).drop("base_score", "score").collect()) == one
    assert sorted(r.score for r in found) == pytest.approx(scores, rel=1e-3)


def test_packed_numbers_come_back():
    random = np.random.default_rng(3)
    for n in (0, 1, 1000):
        gram = np.unique(random.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (lm.unpacked_grams(lm.packed_grams(gram)) == gram).all()
        few = random.integers(0, 1 << 20, n, dtype=np.uint32)
        assert (lm.unpacked_numbers(lm.packed_numbers(few), np.uint32) == few).all()
