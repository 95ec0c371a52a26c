"""Byte-level BPE by merge replay.

Texts are split into pieces; each distinct piece of a run of texts is merged once, together with all others. Their bytes
lie in one array, linked to their neighbours. An inverted index maps the rank of a token pair to the positions where such
a pair begins. Ranks are taken in rising order; all positions of a rank are merged at once, and only the pairs that a
merged token forms with its two neighbours enter the index anew. Where a merge makes a pair of a lower rank than its
own, a piece with several occurrences could depend on their order; such pieces are merged one by one instead.

Ids are kept as bytes, little-endian unsigned 32-bit integers. Decoding joins the bytes of the tokens and never fails.

Defined results: null and empty texts have no ids; every row of the input is one of the output, repeated rows too;
ids that the vocabulary lacks raise an error. Memory follows the distinct pieces of `RUN_BYTES` of text, or of the longest
text. Other columns are carried on request and not looked at.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quayside.llm.lookup import KeyTable
from quayside.llm.textarrays import release, released, slices
from quayside.session import apply_settings

RUN_BYTES = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Numbers(dict):
    """Keys numbered as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for bytes {missing}")
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (ranks[token[:k]] * self.size + ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        self.pairs = KeyTable(np.array([p for p, _ in pairs], dtype=np.uint64))
        self.merged = np.array([*[r for _, r in pairs], -1], dtype=np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it doesn't merge."""
        return self.merged[self.pairs.find(left.astype(np.uint64) * np.uint64(self.size) + right.astype(np.uint64))]

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of a piece: the leftmost pair of the lowest rank, one at a time."""
        token = [self.ranks[bytes([b])] for b in piece]
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        text = [self.tokens[t] for t in token]
        current = [self.ranks.get(text[i] + text[i + 1], -1) for i in range(n - 1)] + [-1]
        heap = [(r, i) for i, r in enumerate(current) if r >= 0]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if current[i] != rank:
                continue
            j = after[i]
            text[i], current[j], after[i] = text[i] + text[j], -1, after[j]
            text[j] = b""
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    current[k] = self.ranks.get(text[k] + text[after[k]], -1) if after[k] < n else -1
                    if current[k] >= 0:
                        heapq.heappush(heap, (current[k], k))
        return [self.ranks[t] for t in text if t]

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        n = int(lengths.sum())
        if not n:
            return np.zeros(0, dtype=np.int64), lengths
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        filled = lengths > 0
        token = self.of_byte[data]
        # Place n stands for none; a run is far shorter than 2^31 bytes.
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends[filled] - 1] = n
        before[starts[filled]] = n
        current = np.full(n + 1, -1, dtype=np.int32)
        inner = np.flatnonzero(after[:n] < n).astype(np.int32)
        current[inner] = self.rank_of(token[inner], token[inner + 1])
        alive = np.ones(n + 1, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def enter(at: np.ndarray, rank: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for own, r in zip(np.split(at, cuts), rank[np.concatenate([[0], cuts])].tolist()):
                if r in index:
                    index[r].append(own)
                else:
                    index[r] = [own]
                    heapq.heappush(ranks, r)

        first = np.flatnonzero(current >= 0).astype(np.int32)
        if len(first):
            enter(first, current[first])
        disordered: set[int] = set()
        while ranks:
            rank = heapq.heappop(ranks)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[current[at] == rank]
            if not len(at):
                continue
            gone = after[at]
            chained = at[1:] == gone[:-1]
            if chained.any():  # of pairs that overlap, every other one from the left
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), place, 0))
                at = at[(place - run) % 2 == 0]
                gone = after[at]
            following = after[gone]
            token[at] = rank
            after[at] = following
            before[following] = at
            alive[gone] = False
            current[gone] = -1
            current[at] = -1
            left = before[at]
            touched = np.concatenate([left[left < n], at[following < n]])
            if not len(touched):
                continue
            touched = np.unique(touched)
            new = self.rank_of(token[touched], token[after[touched]])
            current[touched] = new
            merges = new >= 0
            if merges.any():
                touched, new = touched[merges], new[merges]
                early = touched[new < rank]
                if len(early):
                    disordered.update((np.searchsorted(starts[filled], early, side="right") - 1).tolist())
                enter(touched, new)
        ids = token[alive[:n]]
        counts = np.diff(np.concatenate([[0], np.cumsum(alive[:n])])[np.concatenate([[0], ends])])
        if disordered:
            own = np.flatnonzero(filled)
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in disordered:
                parts[own[k]] = np.array(self.merge_one(pieces[own[k]]), dtype=np.int64)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of each text; the distinct pieces of all of them are merged together."""
        numbers = _Numbers()
        found = [np.fromiter(map(numbers.__getitem__, self.pattern.findall(t.decode())), dtype=np.int32) for t in texts]
        ids, counts = self.merge_all([p.encode() for p in numbers])
        starts = np.cumsum(counts) - counts
        packed = ids.astype("<u4")
        for pieces in found:
            n = counts[pieces]
            total = np.cumsum(n)
            at = np.repeat(starts[pieces] - total + n, n) + np.arange(total[-1] if len(total) else 0)
            yield packed[at].tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, n_tokens and ids of each document.

    The vocabulary is a file of fixed size and is sent to every worker.
    """
    spark = apply_settings(docs.sparkSession)
    shared = spark.sparkContext.broadcast((ranks, pattern))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        for batch in released(batches):
            for part in slices(batch.column("text"), RUN_BYTES):
                ids = list(vocabulary.encode(part.text(i) for i in range(part.count)))
                own = batch.slice(part.first, part.count)
                yield pa.record_batch(
                    [*[own.column(c) for c in carry], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[*carry, "n_tokens", "ids"],
                )
                release()

    kinds = dict(docs.dtypes)
    rows = docs.select(*[docs[c] for c in carry], docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(encode, ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], "n_tokens bigint, ids binary"]))


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """All columns of `encoded`, and decoded, the bytes that its ids stand for."""
    spark = apply_settings(encoded.sparkSession)
    shared = spark.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in released(batches):
            texts = [b"".join(map(token, np.frombuffer(x.as_py() or b"", dtype="<u4").tolist())) for x in batch.column("ids")]
            yield batch.append_column("decoded", pa.array(texts, pa.binary()))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(decode, f"{schema}, decoded binary")
