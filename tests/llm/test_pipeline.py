"""The pipeline against brute-force versions of its stages, each fed with what the one before keeps."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
import public_tokenizers
from quayside.llm.bpe import read_ranks
from quayside.llm.quality_rules import judge
from tests.llm.test_exact_dedup import norm
from tests.llm.test_mixing import mix_key, size, targets
from tests.llm.test_ngram_join import brute, edited


@pytest.fixture(scope="module")
def folder(spark, documents, prose, edges, tmp_path_factory):
    r = random.Random(9)
    rows = [(i, prose(i, 60 + i % 90), "en", r.choice(["a", "b", "c", None])) for i in range(240)]
    rows += [(1000 + i, rows[i][1] + " " * (i % 3), "en", "a") for i in range(30)]
    rows += [(2000 + i, edited(rows[40 + i % 8][1], i, 1), "de", "b") for i in range(40)]
    rows += [(3000 + i, prose(i, 90).replace(" ", "*** "), "en", "c") for i in range(30)]
    rows += [(4000 + (i or 0), t, "en", "a") for i, t in edges] + [rows[5], rows[5]]
    path = str(tmp_path_factory.mktemp("pipeline"))
    documents(rows, 4).write.parquet(f"{path}/documents.parquet")
    labels = [(d, int(d < 3000), 0) for d, *_ in rows if d % 2 and d < 4000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix", "encode"]
    names = set(contract.queries())
    assert {"pipeline"} | {f"op{k}" for k in range(1, 11)} <= names | {n.split("_")[0] for n in names}
    assert "pipeline" not in contract.oracle_sql()


def test_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = judge(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    passed = {r.doc_id for r in judged.filter("kept").collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect() if r.doc_id in passed]
    assert not any(3000 <= d < 4000 for d, *_ in rows) and len({d for d, *_ in rows if d < 1000}) >= 235

    groups = {}
    for row in sorted(rows, key=lambda x: (-len(x[1]), x[0])):
        groups.setdefault(norm(row[1]), row)
    rows = list(groups.values())

    classes = {d: c for d, c, _ in brute([r[:2] for r in rows])}
    rows = [r for r in rows if classes[r[0]] == r[0]]

    sizes, want = targets(rows)
    times, left = Counter(), {s: int(want[s]) for s in sizes}
    for s in sizes:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: mix_key(r[0], r[1]))
        epochs, rest = divmod(left[s], sizes[s])
        for r in own:
            part = max(0, min(size(r[1]), rest))
            rest -= part
            times[r[0]] = math.ceil((epochs * size(r[1]) + part) / size(r[1]))

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.RANKS_FILE)), special_tokens={}
    )
    expected = Counter()
    for d, text, lang, source in rows:
        ids = np.array(library.encode_ordinary(text), dtype="<u4")
        expected[d, lang, source, len(ids), ids.tobytes(), hashlib.sha256(text.encode()).hexdigest()] += times[d]
    got = Counter((r.doc_id, r.lang, r.source, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == +expected


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
