"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: for the contexts of up to three bytes before a byte, the counts of what
followed. A byte costs -log2 of its probability in the longest context that was seen; a byte new to that context costs
an escape (as often as the context has distinct followers) and is coded in the next shorter one, down to all 256
bytes alike. Statistics are frozen while a text is scored, so its code length under a language is one sum over its bytes,
and depends on nothing but the four bytes at each place: every cost that training can know is computed once, in tables of each
language's own contexts, so the model grows with the number of languages and no faster. A slice of text is coded for its distinct
four-byte grams, one language after the other; a text longer than a slice is cut, with three bytes of context, and its lengths added.

The trees are fitted on the different labelled texts of each language, in the order of their hashes until they hold
`SAMPLE_BYTES`; the last comes in whole, so every language with text has one, and copies count once. Every text is scored as a whole. The score is the share of the best language in the
probabilities that all languages give the text.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text where no row has a
language to learn from. Equal code lengths go to the language that sorts first. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.textarrays import Slice, released, slices
from quayside.session import apply_settings, new_folder

ORDER = 3
SAMPLE_BYTES = 1 << 20
SLICE_BYTES = 1 << 20
UNKNOWN = "und"

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The four bytes that end at each byte of a slice, as one number, and the texts' bounds; zeros come before a text."""
    out = np.zeros(len(part.data), dtype=np.uint32)
    for back in range(ORDER + 1):
        out[back:] |= part.data[: len(part.data) - back].astype(np.uint32) << np.uint32(8 * back)
    # What reaches back over a text's start is taken out again.
    starts = part.offsets[:-1][np.diff(part.offsets) > 0]
    for place in range(ORDER):
        at = starts[starts + place < len(out)] + place
        own = np.searchsorted(part.offsets, at, side="right") == np.searchsorted(part.offsets, at - place, side="right")
        out[at[own]] &= _mask(place + 1)
    return out, part.offsets


@dataclass
class Level:
    """A language's known grams and contexts of one length, in order, with their costs in bits: of the byte, and of escaping."""

    grams: np.ndarray
    cost: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass
class Model:
    languages: list[str]
    #: Of each language, from the shortest context up.
    levels: list[list[Level]]

    def bits(self, codes: np.ndarray, language: int) -> np.ndarray:
        """Cost of each byte under a language; `codes` as grams() makes them."""
        return _code(self.levels[language], codes)


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each asked number among the known ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


def _code(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """Costs of the bytes from the longest of the given levels down."""
    out = np.zeros(len(codes))
    left = np.arange(len(codes))
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        own = codes[left] & _mask(order + 1)
        at, known = _find(level.grams, own)
        out[left[known]] += level.cost[at[known]]
        left, own = left[~known], own[~known]
        if not len(left):
            return out
        at, known = _find(level.contexts, own >> np.uint32(8))
        out[left[known]] += level.escape[at[known]]
    out[left] += 8.0
    return out


def _mask(size: int) -> np.uint32:
    return np.uint32((1 << (8 * size)) - 1)


def build_tree(code: np.ndarray, count: np.ndarray) -> list[Level]:
    """Tables of a language from its distinct four-byte grams and how often each occurs."""
    levels: list[Level] = []
    for order in range(ORDER + 1):
        key, which = np.unique(code & _mask(order + 1), return_inverse=True)
        n = np.bincount(which, weights=count, minlength=len(key))
        context, of = np.unique(key >> np.uint32(8), return_inverse=True)
        total, followers = np.bincount(of, weights=n, minlength=len(context)), np.bincount(of, minlength=len(context))
        cost = np.log2((total + followers)[of] / n)
        levels.append(Level(key, cost, context, np.log2((total + followers) / followers)))
    return levels


def build_model(languages: list[str], codes: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    return Model(languages, [build_tree(code, count) for code, count in zip(codes, counts)])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        lang = batch.column("lang").to_pylist()
        for name in sorted(set(lang)):
            chosen = batch.column("text").filter(pa.array([x == name for x in lang]))
            for part in slices(chosen, SLICE_BYTES):
                code, count = np.unique(grams(part)[0], return_counts=True)
                yield pa.record_batch(
                    [pa.array([name] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(count.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


def _by_language(values: dict[str, float], other: Column) -> Column:
    for name, value in values.items():
        other = F.when(F.col("lang") == name, F.lit(value)).otherwise(other)
    return other


def _last_hashes(texts: DataFrame, sample_bytes: int) -> dict[str, int]:
    """The hash up to which each language's texts (lang, hash, bytes) are taken: the first where they hold `sample_bytes`.

    Only hashes in a low range, of a few times that size at first, come to the driver.
    """
    # One row per language, and the model holds a tree for each.
    totals = texts.groupBy("lang").agg(F.sum("bytes").alias("bytes")).collect()
    share = {row["lang"]: min(4.0 * sample_bytes / row["bytes"], 1.0) for row in totals}
    uniform = F.col("hash").cast("double") / F.lit(2.0**64) + F.lit(0.5)
    last: dict[str, int] = {}
    while share:
        low = texts.filter(uniform <= _by_language(share, F.lit(-1.0))).select("lang", "hash", "bytes").toPandas()
        for name, own in low.sort_values("hash").groupby("lang"):
            held = own["bytes"].cumsum().to_numpy()
            if held[-1] >= sample_bytes or share[name] == 1.0:
                last[name] = int(own["hash"].iloc[min(int(np.searchsorted(held, sample_bytes)), len(held) - 1)])
        share = {name: min(8 * part, 1.0) for name, part in share.items() if name not in last}
    return last


def fit(labelled: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Model from rows of text and lang, both not null."""
    folder = new_folder(labelled.sparkSession, "language-id")
    rows = labelled.select(labelled["lang"].cast("string").alias("lang"), labelled["text"].cast("string").alias("text")).filter(
        "lang IS NOT NULL AND octet_length(text) > 0"
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows.groupBy("lang", "hash").agg(F.max(F.octet_length("text").cast("long")).alias("bytes")).write.parquet(f"{folder}/texts")
    last = _last_hashes(labelled.sparkSession.read.parquet(f"{folder}/texts"), sample_bytes)
    rows.filter(_by_language(last, F.lit(None).cast("long")) >= F.col("hash")).select("lang", "text").distinct().mapInArrow(
        _count, "lang string, gram bigint, n bigint"
    ).groupBy("lang", "gram").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/grams")
    found = labelled.sparkSession.read.parquet(f"{folder}/grams").orderBy("lang", "gram").toPandas()
    languages = sorted(found["lang"].unique())
    own = [found[found["lang"] == name] for name in languages]
    if not languages:
        return Model([], [])
    return build_model(languages, [o["gram"].to_numpy().astype(np.uint32) for o in own], [o["n"].to_numpy() for o in own])


def has_letter(part: Slice, i: int) -> bool:
    own = part.data[part.offsets[i] : part.offsets[i + 1]]
    if _LETTERS[own].any():
        return True
    return bool((own >= 0x80).any()) and any(c.isalpha() for c in own.tobytes().decode("utf-8", "replace"))


def code_lengths(model: Model, part: Slice) -> np.ndarray:
    """Bits of each text that is not empty, texts x languages, by runs of about SLICE_BYTES."""
    filled = np.flatnonzero(np.diff(part.offsets))
    out = np.zeros((len(filled), len(model.languages)))
    for first in range(0, len(part.data), SLICE_BYTES):
        last = min(first + SLICE_BYTES, len(part.data))
        begin = max(first - ORDER, 0)
        bounds = np.clip(part.offsets, begin, last) - begin
        # Only whole slices hold more than one text; a cut through a text keeps the bytes before as its context.
        codes = grams(Slice(0, part.count, part.data[begin:last], bounds))[0][first - begin :]
        own, which = np.unique(codes, return_inverse=True)
        starts = np.clip(part.offsets[filled], first, last) - first
        held = np.flatnonzero(np.clip(part.offsets[filled + 1], first, last) - first > starts)
        for k in range(len(model.languages)):
            out[held, k] += np.add.reduceat(model.bits(own, k)[which], starts[held])
    return out


def identify_slice(model: Model, part: Slice) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * part.count, [0.0] * part.count
    if not model.languages or not len(part.data):
        return names, scores
    filled = np.flatnonzero(np.diff(part.offsets))
    total = code_lengths(model, part)
    best = total.argmin(axis=1)
    share = 1 / np.exp2(np.maximum(total.min(axis=1)[:, None] - total, -1000.0)).sum(axis=1)
    for at, i in enumerate(filled):
        if has_letter(part, i):
            names[i], scores[i] = model.languages[best[at]], float(share[at])
    return names, scores


def identify(docs: DataFrame, labelled: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs`, learned from `labelled` (text, lang)."""
    spark = apply_settings(docs.sparkSession)
    model = spark.sparkContext.broadcast(fit(labelled, sample_bytes))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            names, scores = [], []
            for part in slices(batch.column("text"), SLICE_BYTES):
                own = identify_slice(model.value, part)
                names += own[0]
                scores += own[1]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, lang_pred string, score double")
