import hashlib
import random

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from quayside.llm.bpe import Vocabulary, decode_documents, encode_documents, read_ranks

RANKS = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(RANKS, public_tokenizers.PATTERN)


def random_texts():
    r = random.Random(4)
    tokens = list(RANKS)
    yield from (b"".join(r.choice(tokens) for _ in range(30)).decode("utf-8", "ignore") for _ in range(500))
    yield from ("".join(r.choice("abe rst") for _ in range(200)) for _ in range(300))
    yield from ("".join(r.choice("aeio") for _ in range(60)) for _ in range(300))
    yield from (f"a{chr(c)}b {chr(c)}{chr(c)} 1" for c in range(1, 0x3100))
    yield from ("a" * 5000, "ab" * 3000, " " * 999 + "x", "<|endoftext|>", "", "\n\n \n", "日本語" * 400, "-" * 7777)


def test_ids_equal_the_library(vocabulary, reference):
    texts = list(random_texts())
    for text, ids in zip(texts, vocabulary.encode(t.encode() for t in texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_one_by_one_equals_together(vocabulary):
    pieces = [p.encode() for t in random_texts() for p in vocabulary.pattern.findall(t)][:3000]
    ids, counts = vocabulary.merge_all(pieces)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [vocabulary.merge_one(p) for p in pieces]
    assert vocabulary.merge_all([])[0].tolist() == [] and vocabulary.merge_all([b""])[1].tolist() == [0]


def test_pairs_that_make_lower_ranks():
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"ab": 300, b"cd": 301, b"bcd": 5, b"abcd": 302, b"cda": 4, b"cdab": 3}
    vocabulary = Vocabulary(ranks, r"\S+")
    library = tiktoken.Encoding("low", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    for text in ["abcdabcd", "bcdcdab", *("".join(r.choice("abcd") for _ in range(r.randint(1, 30))) for _ in range(400))]:
        assert np.frombuffer(next(vocabulary.encode([text.encode()])), "<u4").tolist() == library.encode_ordinary(text)


def test_documents(documents, edges, prose, reference):
    rows = edges + [(100 + i, prose(i % 9, 50)) for i in range(30)]
    docs = documents(rows)
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN, ("doc_id", "place"))
    got = decode_documents(encoded, RANKS).collect()
    want = sorted(
        (str(d), len(ids := reference.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), t or "") for d, t in rows
    )
    assert sorted((str(r.doc_id), r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded.decode()) for r in got) == want
    assert {r.place for r in got} == {"clash"}
    assert encode_documents(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0
