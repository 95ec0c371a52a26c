import random
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import language_id
from quayside.llm.language_id import ORDER, build_model, code_lengths, grams, identify
from quayside.llm.textarrays import slices


def tree(texts):
    """Counts of followers by context, and the same model byte by byte."""
    counts = defaultdict(Counter)
    for t in texts:
        padded = b"\0" * ORDER + t
        for i in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                counts[k, padded[i - k : i]][padded[i]] += 1

    def cost(context, byte):
        bits = 0.0
        for k in range(ORDER, -1, -1):
            seen = counts.get((k, context[ORDER - k :]))
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if byte in seen:
                return bits + log2(total / seen[byte])
            bits += log2(total / len(seen))
        return bits + 8

    return lambda t: sum(cost((b"\0" * ORDER + t)[i : i + ORDER], t[i]) for i in range(len(t)))


def test_code_lengths_equal_the_trees():
    r = random.Random(3)
    train = {name: [bytes(r.choice(abc) for _ in range(r.randint(1, 60))) for _ in range(30)] for name, abc in (("x", b"abcd "), ("y", b"abxyz "), ("z", b"\xc3\xa9a"))}
    codes, counts = [], []
    for texts in train.values():
        found = np.concatenate([grams(p)[0] for p in slices(pa.array([t.decode("latin-1") for t in texts]))])
        code, n = np.unique(found, return_counts=True)
        codes.append(code)
        counts.append(n)
    model = build_model(list(train), codes, counts)
    lengths = [tree([t.decode("latin-1").encode() for t in texts]) for texts in train.values()]
    for text in ("abcabc", "zzz", "é a", "q", "abxyzabcd", "日本"):
        part = next(slices(pa.array([text])))
        want = [length(text.encode()) for length in lengths]
        assert [model.bits(grams(part)[0], k).sum() for k in range(3)] == pytest.approx(want)
        assert code_lengths(model, part)[0].tolist() == pytest.approx(want)


def test_held_out_accuracy(spark, documents):
    words = {"en": ["the", "and", "of", "thing", "with"], "de": ["der", "und", "ein", "nicht", "schön"], "fr": ["le", "et", "une", "où", "être"]}
    r = random.Random(1)
    rows = []
    for i in range(300):
        lang = r.choice(list(words))
        rows.append((i, " ".join(r.choice(words[lang]) for _ in range(r.randint(3, 30))), lang, "a"))
    docs = documents(rows)
    got = {x.doc_id: x for x in identify(docs.filter("doc_id >= 200"), docs.filter("doc_id < 200")).collect()}
    assert sum(got[d].lang_pred == lang for d, _, lang, _ in rows[200:]) >= 98
    assert all(0 <= x.score <= 1 for x in got.values())


def test_edges(documents, edges, prose):
    docs = documents([(*r, "en", "a") for r in edges] + [(500, prose(1, 50), "en", "a"), (501, "12 34 !", "en", "a"), (502, "x", None, "a")])
    got = identify(docs, docs).collect()
    assert len(got) == len(edges) + 3
    by_id = {x.doc_id: x for x in got}
    assert {by_id[k].lang_pred for k in (1, 2, 4, 501)} == {"und"} and by_id[501].score == 0
    assert by_id[500].lang_pred == "en" and by_id[8].lang_pred == "en" and by_id[502].lang_pred == "en"
    untaught = identify(docs, docs.filter("lang IS NULL AND lang IS NOT NULL")).collect()
    assert {x.lang_pred for x in untaught} == {"und"} and len(untaught) == len(got)
    assert identify(documents([]), documents([])).count() == 0


def test_every_language_is_learned_and_copies_count_once(spark):
    from quayside.llm.language_id import fit

    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    one_long = [(" ".join(word() for _ in range(700)), f"l{i:02}") for i in range(12)]
    few = [(" ".join(word() for _ in range(9)), "few") for _ in range(4)]
    rows = one_long + few + [few[0]] * 400
    model = fit(spark.createDataFrame(rows, "text string, lang string"), 500)
    assert model.languages == sorted({lang for _, lang in rows})
    alone = fit(spark.createDataFrame(few, "text string, lang string"), 500)
    codes = np.concatenate([grams(p)[0] for p in slices(pa.array([t for t, _ in few]))])
    assert model.bits(codes, 0) == pytest.approx(alone.bits(codes, 0))


def test_texts_are_taken_in_order_up_to_the_bound(spark):
    from quayside.llm.language_id import fit

    texts = [(f"{i:03}" + "x" * 97, "a") for i in range(300)]
    spelled = fit(spark.createDataFrame(texts, "text string, lang string"), 1000)
    order = [r[0] for r in spark.createDataFrame(texts, "text string, lang string").selectExpr("text", "xxhash64(text) h").orderBy("h").limit(10).collect()]
    alone = fit(spark.createDataFrame([(t, "a") for t in order], "text string, lang string"), 1 << 20)
    codes = np.concatenate([grams(p)[0] for p in slices(pa.array([t for t, _ in texts]))])
    assert spelled.bits(codes, 0) == pytest.approx(alone.bits(codes, 0))


def counted(texts):
    found = np.concatenate([grams(p)[0] for p in slices(pa.array(texts))])
    return np.unique(found, return_counts=True)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_texts_are_cut_with_their_context(monkeypatch, size):
    r = random.Random(6)
    texts = ["".join(r.choice("ab c\u00e9") for _ in range(r.choice([0, 1, 2, 3, 40]))) for _ in range(60)]
    model = build_model(["x", "y"], *zip(*[counted(texts[:20]), counted(texts[20:25])]))
    (part,) = slices(pa.array(texts))
    want = code_lengths(model, part)
    monkeypatch.setattr(language_id, "SLICE_BYTES", size)
    assert code_lengths(model, part) == pytest.approx(want)


def test_tables_grow_with_the_languages_and_no_faster():
    r = np.random.default_rng(2)
    texts = ["".join(map(chr, r.integers(97, 123, 20_000))) for _ in range(12)]
    held = lambda m: sum(x.nbytes for tree in m.levels for level in tree for x in (level.grams, level.cost, level.contexts, level.escape))
    few, many = (build_model([str(i) for i in range(n)], *zip(*[counted([t]) for t in texts[:n]])) for n in (3, 12))
    assert held(many) < 4.2 * held(few)
