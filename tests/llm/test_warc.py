import base64
import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from quayside.llm.warc import _records, _writer, read_chunks, records, write_archives

SCHEMA = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"https://x.org/{i}", f"<p>page {i % 5}</p>") for i in range(40)]
    out += [(50, None, None), (51, "", ""), (52, "http://a b\r\nWARC-Type: x/é", "é" * 400_000), (60, "u", "é" * 400_000)]
    return out + [(53, "u", "\r\n\r\nWARC/1.1\r\n"), (53, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>page 1</p>"), (54, "u", "only")]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)


def brute(rows, least=0):
    groups = defaultdict(list)
    for d, _, t in rows:
        groups[t or ""].append(d)
    out = []
    for text, ids in groups.items():
        data = text.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda d: (d is None, d or 0))
        out += [(str(d), len(data), digest, "revisit" if k and len(data) >= least else "response", ids[0] if k and len(data) >= least else None) for k, d in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("least,chunk", [(0, 1 << 18), (14, 1000)])
def test_round_trip(pages, rows, least, chunk):
    archives = write_archives(pages, min_revisit_bytes=least, chunk_bytes=chunk, archive_bytes=3000)
    assert archives.agg({"records": "sum"}).first()[0] == len(rows)
    chunks = read_chunks(archives, chunk_bytes=chunk)
    got = records(chunks).collect()
    assert sorted([(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(rows, least)
    whole = defaultdict(dict)
    for r in chunks.filter("record_type = 'response'").collect():
        assert len(r.chunk) <= chunk and (r.last or len(r.chunk) == chunk)
        whole[r.record_id, r.page_id][r.chunk_no] = r.chunk
    texts = {d: (t or "").encode() for d, _, t in rows}
    assert all(b"".join(v[k] for k in range(len(v))) == texts[d] for (_, d), v in whole.items())


def test_archives_are_plain_gzip_members(pages):
    path = write_archives(pages).first().path.removeprefix("file://")
    with gzip.open(path) as f:
        text = f.read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
    assert b"\r\nWARC-Type: x" not in text
    plain, packed = (list((f["warc-record-id"], b"".join(c for c, _ in own)) for f, own in _records(raw, 999)) for raw in (io.BytesIO(text), open(path, "rb")))
    assert plain == packed


def test_damage_is_reported(spark, pages, tmp_path):
    path = write_archives(pages).first().path
    data = gzip.open(path.removeprefix("file://")).read()
    at = data.index(b"<p>page") + 3
    broken = tmp_path / "broken.warc"
    broken.write_bytes(data[:at] + b"X" + data[at + 1 :])
    with pytest.raises(Exception, match="damaged"):
        read_chunks(spark.createDataFrame([(f"file://{broken}",)], "path string")).count()


def test_repeated_tasks_leave_other_files(tmp_path):
    write = _writer(f"file://{tmp_path}", "2024-01-01T00:00:00Z", 1 << 20, 1000)
    assert list(write([])) == []


def test_empty_table(pages):
    archives = write_archives(pages.limit(0))
    assert archives.count() == 0 and read_chunks(archives).count() == 0
