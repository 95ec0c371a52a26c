import hashlib
import re
from collections import defaultdict

import pytest

from quayside.llm.exact_dedup import build_index, drop_duplicates, mark_duplicates


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append((d, t))
    out = []
    for key, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(d, keep[0], len(own), hashlib.sha256(key.encode()).hexdigest()) for d, _ in own]
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,bucket", [(64, 16_384), (64, 2), (3, 2), (1, 1)])
def test_equals_brute_force(documents, edges, prose, bits, bucket):
    rows = edges + [(100 + i, prose(i % 7, 20) + " " * (i % 3)) for i in range(60)]
    got = mark_duplicates(documents(rows), bucket, bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected(rows)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_buckets_split_until_they_fit(documents, prose):
    docs = documents([(i, prose(i, 10)) for i in range(300)])
    index = build_index(docs, bucket_entries=16)
    buckets = index.slots().select("bucket", "local_depth", "entries").distinct().collect()
    assert max(b.entries for b in buckets) <= 16 and len({b.local_depth for b in buckets}) > 1
    assert sum(b.entries for b in buckets) == index.entries().count() == 300


def test_collisions_chain(documents, prose):
    index = build_index(documents([(i, prose(i, 10)) for i in range(40)]), bucket_entries=4, hash_bits=2)
    assert index.entries().groupBy("h").count().agg({"count": "max"}).first()[0] > 1
    assert index.entries().select("h", "chain").distinct().count() == 40


def test_empty_table_and_whole_rows(documents, edges):
    assert mark_duplicates(documents([])).count() == 0
    docs = documents(edges)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({norm(t) for _, t in edges})
    assert kept.filter("keep_id = 'clash'").count() == kept.count()
