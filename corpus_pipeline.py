"""From raw documents to token ids: each stage's rows are written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.bpe import decode_documents, encode_documents, read_ranks
from quayside.llm.exact_dedup import drop_duplicates
from quayside.llm.mixing import mixed_documents
from quayside.llm.ngram_join import drop_near_duplicates
from quayside.llm.quality_rules import keep_documents
from quayside.session import apply_settings, new_folder

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for; the one at the end of a budget stays whole."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers) and the SHA-256 of what they decode to."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(RANKS_FILE))
    encoded = encode_documents(docs, ranks, public_tokenizers.PATTERN, ("doc_id", "lang", "source"))
    digest = F.sha2("decoded", 256).alias("decoded_sha256")
    return decode_documents(encoded, ranks).select("doc_id", "lang", "source", "n_tokens", "ids", digest)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: SQL can express neither the forest nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last stage's rows."""
    apply_settings(spark)
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for step, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{step}-{name}")
        docs = spark.read.parquet(f"{folder}/{step}-{name}")
    return docs
