import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm.quality_rules import STATISTICS, fit, grow_forest, judge, keep_documents, measure, ratios, statistics
from quayside.llm.textarrays import slices


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    runs = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def texts(prose, edges):
    out = [t for _, t in edges] + ["a b c a b c", "x\ny\n x\nx\n\n\n", "#*$ %&| <> é#", "a a a a", "a\x0bb\x0cc\x1cd"]
    return out + [prose(i, 10 + i) for i in range(40)] + [prose(i, 30) + "\n" + prose(i, 30) for i in range(5)]


@pytest.mark.parametrize("limit", [1, 500, 1 << 20])
def test_statistics_equal_brute_force(prose, edges, limit):
    column = texts(prose, edges)
    got = [statistics(p) for p in slices(pa.array(column, pa.string()), limit)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = list(zip(*[np.concatenate([g[n] for g in got]).tolist() for n in names]))
    assert rows == [base(t) for t in column]


def test_forest_isolates_odd_rows():
    r = np.random.default_rng(1)
    rows = np.concatenate([r.normal(0, 1, (2000, 3)), r.normal(12, 1, (20, 3))])
    score = grow_forest(rows).score(rows)
    assert score[2000:].min() > np.quantile(score[:2000], 0.99)
    assert len(grow_forest(np.zeros((0, 3))).score(np.zeros((2, 3)))) == 2


def corpus(prose):
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = prose(i, 120)
        if bad:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "*** "), text.replace(" ", " | ")][i % 3]
        rows.append((i, text))
        if i % 2:
            labels.append((i, int(not bad), 0))
    return rows, labels


def test_junk_goes_and_clean_stays(spark, documents, prose, edges):
    rows, labels = corpus(prose)
    labels = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    rows += [(1000 + i, t) for i, (_, t) in enumerate(edges)]
    docs = documents(rows)
    got = judge(docs, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    clean = {i for i in range(400) if i % 5}
    assert len(clean & kept) >= 0.98 * len(clean)
    assert len(kept & set(range(0, 400, 5))) <= 2
    assert all(r.base_failed for r in got if r.doc_id >= 1000 and r.n_words < 50)
    left = keep_documents(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_without_labels_only_the_base_rules_hold(spark, documents, prose):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = judge(documents(corpus(prose)[0][:50] + [(900, "short")]), none).collect()
    assert all(r.kept != r.base_failed for r in got)
    assert judge(documents([]), none).count() == 0
    assert len(ratios({n: np.zeros(2) for n in STATISTICS})) == 2


def test_paths_equal_a_walk_down_each_tree():
    r = np.random.default_rng(5)
    rows = np.concatenate([np.round(r.normal(0, 1, (300, 4)), 1), np.zeros((40, 4)), r.normal(6, 1, (5, 4))])
    forest = grow_forest(rows, trees=12, tree_rows=64)

    def usual(n):
        return 0 if n < 2 else 1 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def down(t, own, node=0, depth=0):
        """Ids of rows by the leaf they reach, each with its path: splits passed and the usual rest."""
        if forest.left[t, node] < 0:
            rest = forest.path[t, node] - depth
            assert rest >= 0 and (depth <= 6) and (rest == 0 or any(rest == pytest.approx(usual(n)) for n in range(2, 65)))
            return {i: forest.path[t, node] for i in own}
        left = [i for i in own if rows[i, forest.feature[t, node]] < forest.cut[t, node]]
        right = [i for i in own if i not in set(left)]
        child = int(forest.left[t, node])
        return down(t, left, child, depth + 1) | down(t, right, child + 1, depth + 1)

    every = list(range(len(rows)))
    paths = [down(t, every) for t in range(12)]
    want = [2 ** (-np.mean([p[i] for p in paths]) / usual(64)) for i in every]
    assert forest.score(rows) == pytest.approx(want)


def test_rows_without_ids_are_sampled_one_by_one(spark, documents, prose):
    rows = [(None, "one two three four " * 20)] * 600 + [(k, prose(k, 60)) for k in range(300)]
    stats = measure(documents(rows)).filter("n_words >= 50")
    none = spark.createDataFrame([], "doc_id long, quality int")
    sizes = []

    def grown(sample, trees=0, *rest):
        sizes.append(len(sample))
        return grow_forest(sample, 2)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("quayside.llm.quality_rules.grow_forest", grown)
        patch.setattr("quayside.llm.quality_rules.REPEAT_SHARE", 1.0)
        fit(stats, none, sample_rows=300)
    assert 200 < sizes[0] < 400
