import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quayside.llm.mixing import _cut_hot_keys, mix_sources, mixed_documents, sized
from quayside.llm.stored import stored


def mix_key(doc_id, text):
    """Key of a document in the mix."""
    return hashlib.md5(f"{'' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(rows):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, left, todo = {}, sum(sizes.values()), set(names)
    while todo:
        rate = left / sum(weight[s] for s in todo)
        over = {s for s in todo if 3 * sizes[s] < rate * weight[s]}
        if not over:
            out |= {s: rate * weight[s] for s in todo}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        todo -= over
    return sizes, out


def case(prose):
    sources = ["a", "b", "Z", "é", None, "tiny"]
    rows = [(i, prose(i, 5 + i % 40), "en", sources[i % 5 if i < 90 else 2]) for i in range(150)]
    return rows + [(500, "one two", "en", "tiny"), (501, None, "en", "a"), (502, "  ", "en", "none"), (3, prose(3, 8), "en", "é")]


def test_targets_and_cuts(documents, prose):
    rows = case(prose)
    sizes, want = targets(rows)
    for range_rows in (50_000, 4):
        got = mix_sources(documents(rows), range_rows=range_rows).collect()
        assert len(got) == len(rows)
        taken = Counter()
        for r in got:
            assert r.source_size == sizes[r.source]
            assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
            assert 0 <= r.taken <= 3 * r["size"]
            taken[r.source] += r.taken
        assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)


def test_order_is_that_of_the_hash(documents, prose):
    rows = [(i, prose(i, 10), "en", "a" if i < 30 else "b") for i in range(60)]
    got = {r.doc_id: r for r in mix_sources(documents(rows), range_rows=3).collect()}
    order = sorted(range(30, 60), key=lambda i: mix_key(i, rows[i][1]))
    shares = [got[i].taken / got[i]["size"] for i in order]
    assert shares == sorted(shares, reverse=True)


def test_reruns_agree_and_rows_repeat(documents, prose):
    rows = case(prose)
    one, two = (sorted(map(str, mix_sources(documents(rows, n)).drop("place").collect())) for n in (1, 5))
    assert one == two
    docs = documents(rows)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    want = {r.doc_id: -(-r.taken // r["size"]) for r in mix_sources(docs).collect() if r.taken and r.doc_id != 3}
    assert {d: n for d, n in times.items() if d != 3} == want


def test_edges(documents, edges):
    assert mix_sources(documents([])).count() == 0
    assert mix_sources(documents(edges)).count() == len(edges)
    empty = mix_sources(documents([(1, None), (2, "")])).collect()
    assert [(r["size"], r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


def test_hot_ids_and_equal_rows_are_cut(spark, documents, prose):
    """A third of the rows have a null id, another third are equal in all columns."""
    rows = [(None, prose(i, 5 + i % 7), "en", "a") for i in range(300)] + [(1, "three equal words", "en", "a")] * 300
    rows += [(i, prose(i, 6), "en", "b") for i in range(10, 310)]
    docs = documents(rows, 4)
    got = mix_sources(docs, range_rows=40).collect()
    sizes, want = targets(rows)
    assert len(got) == 900 and len({r.place for r in got}) == 900
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    assert dict(taken) == {s: int(want[s] + 1e-9) for s in sizes}
    # No range is ordered by one task with many times its share of rows.
    keyed = sized(stored(docs)).withColumn("range", F.substring("key", 1, 2))
    parts = _cut_hot_keys(keyed, 40).groupBy("source", "range", "part").count().agg({"count": "max"}).first()[0]
    assert parts < 80
    times = Counter(r.doc_id for r in mixed_documents(docs).collect())
    assert times[1] == sum(-(-r.taken // r["size"]) for r in got if r.doc_id == 1)
