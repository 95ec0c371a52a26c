"""License scans by ordered signature rules.

A text is read as words, runs of letters and digits after lower-casing A-Z, every character beyond ASCII counting as a letter.
Words of all texts of a slice are compared at once with the keywords of the rules; only where all words of one of a
rule's gates are in a text does its regular expression run, over the text's words with one space between them. The places found
are resolved in the order of the rules' kinds: a place that lies within one of a higher kind, or within a longer or
earlier rule's of its own kind, is suppressed. Base phrases come first and are never suppressed.

Rows are read where they lie, without a shuffle. Work on whole texts is in slices of a few MB; longer texts are
cut between words for the keywords, and only a text that some rule's gate lets through is normalised as a whole.

Defined results: null text counts as empty and has no words and no places; repeated rows give repeated results; an empty
table gives an empty result. Only `text` and the columns asked for are looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from quayside.llm.license_rules import CONFIDENCE, PRIORITY, Rule, build_rules
from quayside.llm.lookup import KeyTable
from quayside.llm.textarrays import SLICE_BYTES, mix, released, slices
from quayside.session import apply_settings

DETECTION = "struct<label: string, kind: string, rule: int, first_word: bigint, last_word: bigint, kept: boolean>"
FIELDS = f"n_words bigint, detections array<{DETECTION}>, score double"

#: Lower-cased bytes of words, a space for every other byte.
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_CLEAN[~_IS_WORD[_CLEAN]] = 0x20
_TABLE = _CLEAN.tobytes()

_PREFIX = 8


def _word_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A key of each word: its first eight bytes and its length. Words with equal keys may differ in what follows."""
    key = np.zeros(len(starts), dtype=np.uint64)
    last = len(data) - 1
    for k in range(_PREFIX):
        own = data[np.minimum(starts + k, last)].astype(np.uint64)
        own[lengths <= k] = 0
        key |= own << np.uint64(8 * k)
    return mix(key) ^ lengths.astype(np.uint64)


@dataclass
class Place:
    rule: Rule
    first: int
    last: int
    kept: bool = True


class Scanner:
    """The rules, found by their keywords."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = rules
        words = sorted({w for rule in rules for gate in rule.gates for w in gate})
        self.number = {w: i for i, w in enumerate(words)}
        self.lengths = np.zeros(1 + max(map(len, words)), dtype=bool)
        self.lengths[[len(w) for w in words]] = True
        data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
        lengths = np.array([len(w) for w in words])
        keys = _word_keys(data, np.cumsum(lengths) - lengths, lengths)
        distinct, self.first_of = np.unique(keys, return_inverse=True)
        self.table = KeyTable(distinct)
        # Words that share a key open the same gates.
        self.gates: dict[int, list[tuple[frozenset[int], int]]] = defaultdict(list)
        for rule in rules:
            for gate in rule.gates:
                numbers = frozenset(int(self.first_of[self.number[w]]) for w in gate)
                rarest = int(self.first_of[self.number[max(gate, key=len)]])
                self.gates[rarest].append((numbers, rule.order))

    def keywords(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, and (text, keyword) of the keywords found, for texts that lie one after the other in `data`."""
        data = _CLEAN[data]
        inside = _IS_WORD[data]
        before = np.concatenate(([False], inside[:-1]))
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        before[cuts] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False]))
        after[cuts - 1] = False
        lengths = np.flatnonzero(inside & ~after) + 1 - starts
        counts = np.diff(np.searchsorted(starts, offsets))
        able = np.flatnonzero((lengths < len(self.lengths)) & self.lengths[np.minimum(lengths, len(self.lengths) - 1)])
        found = self.table.find(_word_keys(data, starts[able], lengths[able]))
        hit = np.flatnonzero(found >= 0)
        text = np.searchsorted(offsets, starts[able[hit]], side="right") - 1
        return counts, text, found[hit].astype(np.int64)

    def opened(self, keywords: set[int]) -> list[Rule]:
        """Rules that have a gate with all its words among the keywords."""
        orders = {order for k in keywords for gate, order in self.gates.get(k, ()) if gate <= keywords}
        return [self.rules[i] for i in sorted(orders)]

    def places(self, text: bytes, rules: list[Rule]) -> list[Place]:
        """Where the rules match, in words of the text, those that others cover marked as suppressed."""
        clean = b" ".join(text.translate(_TABLE).split())
        found = [(rule, m.start(), m.end()) for rule in rules for m in rule.pattern.finditer(clean)]
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(clean, dtype=np.uint8) == 0x20)
        firsts = np.searchsorted(spaces, [x[1] for x in found]).tolist()
        lasts = np.searchsorted(spaces, [x[2] for x in found]).tolist()
        return resolve([Place(rule, first, last) for (rule, _, _), first, last in zip(found, firsts, lasts)])


def resolve(places: list[Place]) -> list[Place]:
    """The places in the order of the text; `kept` is false for those that others of higher rank contain.

    Kinds are taken from the highest down. Among places sorted by where they begin, the longer and then the earlier rule
    first, one is contained if the furthest end so far is not before its own.
    """
    places.sort(key=lambda p: (p.first, -p.last, p.rule.order))
    kept: list[Place] = []
    for kind in sorted({PRIORITY[p.rule.kind] for p in places}):
        own = [p for p in places if PRIORITY[p.rule.kind] == kind]
        if kind == PRIORITY["base"]:
            kept = own
            continue
        above, at, furthest = kept, 0, -1
        for p in own:
            while at < len(above) and above[at].first <= p.first:
                furthest = max(furthest, above[at].last)
                at += 1
            p.kept = p.last > furthest
            if p.kept:
                furthest = p.last
        kept = sorted(above + [p for p in own if p.kept], key=lambda p: p.first)
    return places


def confidence(places: list[Place]) -> float:
    """How surely a text states a license: 1 less the doubts of its labels, each by its best place."""
    best: dict[str, float] = {}
    for p in places:
        if p.kept:
            best[p.rule.label] = max(best.get(p.rule.label, 0.0), CONFIDENCE[p.rule.kind])
    return 1.0 - float(np.prod([1.0 - best[label] for label in sorted(best)])) if best else 0.0


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of some MB, cut between words (at the next place where that is possible)."""
    at = 0
    while at < len(data):
        stop = min(at + SLICE_BYTES, len(data))
        while stop < len(data):
            between = np.flatnonzero(~_IS_WORD[_CLEAN[data[stop : stop + SLICE_BYTES]]])
            if len(between):
                stop += int(between[0])
                break
            stop = min(stop + SLICE_BYTES, len(data))
        yield data[at:stop]
        at = stop


def scan_column(scanner: Scanner, column: pa.Array) -> Iterator[tuple[int, list[Place]]]:
    """Number of words and places of each text."""
    for part in slices(column):
        counts = np.zeros(part.count, dtype=np.int64)
        keywords: dict[int, set[int]] = defaultdict(set)
        runs = [(part.data, part.offsets)] if part.count > 1 else [(x, np.array([0, len(x)])) for x in _parts(part.data)]
        for data, offsets in runs:
            if not len(data):
                continue
            words, text, found = scanner.keywords(data, offsets)
            counts += words
            for pair in np.unique(text * len(scanner.number) + found).tolist():
                keywords[pair // len(scanner.number)].add(pair % len(scanner.number))
        for i in range(part.count):
            rules = scanner.opened(keywords[i]) if i in keywords else []
            yield int(counts[i]), scanner.places(part.text(i), rules) if rules else []


def scan_licenses(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns asked for, n_words, every detection (suppressed ones with kept = false) and a score from 0 to 1.

    A detection's words are numbered from 0; `last_word` is within it.
    """
    apply_settings(docs.sparkSession)
    source = docs.select(*columns, F.col("text").cast("string").alias("__text"))
    schema = StructType([*docs.select(*columns).schema.fields, *_parse_datatype_string(FIELDS).fields])
    detection = pa.struct([
        ("label", pa.string()), ("kind", pa.string()), ("rule", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("kept", pa.bool_()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(build_rules())
        for batch in released(batches):
            counts, scores, rows = [], [], []
            for n, places in scan_column(scanner, batch.column(batch.num_columns - 1)):
                counts.append(n)
                scores.append(confidence(places))
                rows.append([
                    {"label": p.rule.label, "kind": p.rule.kind, "rule": p.rule.order, "first_word": p.first, "last_word": p.last, "kept": p.kept}
                    for p in places
                ])
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(counts, pa.int64()), pa.array(rows, pa.list_(detection)), pa.array(scores, pa.float64())],
                names=[*columns, "n_words", "detections", "score"],
            )

    return source.mapInArrow(run, schema)
