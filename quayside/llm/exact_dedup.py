"""Exact duplicates through an extendible-hash index on shared files, in DataFrame functions only.

Build. Every distinct normalised text is one entry. Entries are grouped by hash *and text*, so Spark's aggregate compares
the bytes, and texts that only share a hash become a chain of entries. Copies fold on the map side, so that a text with
a third of all rows sends one row per task. The directory starts with one slot; a bucket with more entries than its
capacity splits on the next bit of the hash, which doubles the directory where needed. A bucket's depth is therefore
the first at which it is not overfull, and that is computed for all buckets at once from counts per slot. Buckets are
written in key order, each by the task that owns its key range.

Probe. A row finds its slot by the leading bits of its hash, the slot's bucket in the directory, and its entry in the
bucket's chain by the digest.

Defined results: null text counts as empty; all empty texts are copies of each other; a null doc_id ranks after every
other id. Rows that agree in everything are told apart by their place in the input, so that one of them stays. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.stored import placed, stored
from quayside.session import apply_settings, new_folder

#: Entries in a bucket of the index: about 1 MB.
BUCKET_ENTRIES = 16_384

#: The characters that normalisation deletes.
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


@dataclass(frozen=True)
class HashIndex:
    """Folders of the bucket files and of the directory, and the number of leading bits that address a slot."""

    spark: SparkSession
    buckets: str
    directory: str
    depth: int

    def slots(self) -> DataFrame:
        return self.spark.read.parquet(self.directory)

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(self.buckets)


def _slot(h: Column, depth: int) -> Column:
    # Spark takes a shift by 64 as one by 0.
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def _rows(docs: DataFrame, hash_bits: int) -> DataFrame:
    text = F.col("text").cast("string")
    norm = normalised(text)
    return placed(docs, "_place").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_place").alias("place"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("chars"),
        F.shiftleft(F.xxhash64(norm), 64 - hash_bits).alias("h"),
        norm.alias("norm"),
    )


def build_index(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES, hash_bits: int = 64) -> HashIndex:
    """Index of the distinct normalised texts of `docs` (doc_id, text).

    An entry holds h, chain (its place among the texts with that hash), digest, copies, and the row that stays: the most
    code points, then the smallest doc_id. `hash_bits` below 64 makes collisions, for tests.
    """
    spark = apply_settings(docs.sparkSession)
    folder = new_folder(spark, "exact-index")
    rows = _rows(stored(docs), hash_bits)
    # Most code points first, then the smallest id, null last, then the earliest row.
    rank = F.struct((-F.col("chars")).alias("minus_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    entries = (
        rows.groupBy("h", "norm")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(rank).alias("best"))
        .select(
            "h",
            F.sha2(F.col("norm"), 256).alias("digest"),
            "copies",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.place").alias("keep_place"),
        )
    )
    entries.write.parquet(f"{folder}/heap")
    heap = spark.read.parquet(f"{folder}/heap")

    total = heap.count()
    depth = 0
    while total > bucket_entries << depth:
        depth += 1
    depth = min(depth + 3, 40) if depth else 0  # room for uneven buckets
    slots = heap.groupBy(_slot(F.col("h"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    slots.write.parquet(f"{folder}/slots")
    slots = spark.read.parquet(f"{folder}/slots")
    # Each slot under every depth of the directory; the first depth at which its bucket is not overfull is where splitting ended.
    by_depth = slots.select(
        "slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth")
    ).withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {depth} - local_depth)"))
    fits = (
        by_depth.groupBy("local_depth", "prefix")
        .agg(F.sum("n").alias("entries"))
        .filter((F.col("entries") <= bucket_entries) | (F.col("local_depth") == depth))
    )
    directory = (
        by_depth.join(fits, ["local_depth", "prefix"])
        .groupBy("slot")
        .agg(F.min(F.struct("local_depth", "prefix", "entries")).alias("b"))
        .select("slot", F.expr(f"shiftleft(b.prefix, {depth} - b.local_depth)").alias("bucket"), "b.local_depth", "b.entries")
    )
    directory.write.parquet(f"{folder}/directory")
    directory = spark.read.parquet(f"{folder}/directory")

    chain = Window.partitionBy("h").orderBy("digest")
    (
        heap.withColumn("chain", F.row_number().over(chain))
        .withColumn("slot", _slot(F.col("h"), depth))
        .join(directory.select("slot", "bucket"), "slot")
        .drop("slot")
        .repartitionByRange("bucket", "h")
        .sortWithinPartitions("bucket", "h", "chain")
        .write.parquet(f"{folder}/buckets")
    )
    return HashIndex(spark, f"{folder}/buckets", f"{folder}/directory", depth)


def mark_duplicates(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES, hash_bits: int = 64) -> DataFrame:
    """One row per row of `docs`: doc_id, place, keep_id, group_size, kept, text_sha256."""
    apply_settings(docs.sparkSession)
    docs = stored(docs)
    index = build_index(docs, bucket_entries, hash_bits)
    rows = _rows(docs, hash_bits).select("doc_id", "place", "h", F.sha2(F.col("norm"), 256).alias("digest"))
    found = rows.withColumn("slot", _slot(F.col("h"), index.depth)).join(index.slots().select("slot", "bucket"), "slot")
    return found.join(index.entries(), ["bucket", "h", "digest"]).select(
        "doc_id",
        "place",
        "keep_id",
        F.col("copies").alias("group_size"),
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The rows of `docs`, all columns, that stay."""
    apply_settings(docs.sparkSession)
    docs, place = stored(docs), "_place_of_row"
    stay = mark_duplicates(docs, bucket_entries).filter("kept").select(F.col("place").alias(place))
    return placed(docs, place).join(stay, place, "left_semi").drop(place)
