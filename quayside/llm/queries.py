"""Query keys of the numbered operators, each over its whole table, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def key(name: str, sql: str | None = None):
    """Register a query of (spark, sf_dir) under a name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@key(
    "op1_exact_dedup",
    r"""
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
        FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) = 1 AS kept,
           sha256(norm) AS text_sha256
    FROM t""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.exact_dedup import mark_duplicates

    return mark_duplicates(table(spark, sf_dir, "documents")).drop("place")


@key(
    "op3_mix_sources",
    r"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
        FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (
        SELECT *, source_size * 3.0::DOUBLE AS cap,
               [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS weight
        FROM s),
    r AS (
        SELECT *, ((SELECT sum(source_size) FROM s)
                   - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                  / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
        FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, encode(source))),
    t AS (
        SELECT source, source_size,
               least(cap, coalesce((SELECT max(rate) FROM r WHERE cap / weight > rate) * weight, cap)) AS target
        FROM r),
    p AS (
        SELECT d.doc_id, d.size, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS epochs,
               sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS begun
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - begun)) AS BIGINT) AS taken
    FROM p""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@key("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("place")


@key("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.quality_rules import judge

    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


def remainder(divisor: int):
    """crc32 of the id as text, modulo a divisor; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


@key("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.language_id import identify

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, docs.filter(remainder(4) != 2).select("text", "lang"))
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@key("op8_html_extract")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


@key("op9_lm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.lm_score import score_documents

    return score_documents(table(spark, sf_dir, "documents"), remainder(7) != 2)


@key("op4_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quayside.llm.bpe import decode_documents, encode_documents, read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decode_documents(encoded, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@key("op5_warc")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.warc import chunk_table, records, write_archives

    return records(chunk_table(write_archives(table(spark, sf_dir, "pages"))))


@key("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.quality_classifier import classify

    labels = table(spark, sf_dir, "labels").filter(remainder(3) != 1).select("doc_id", "quality")
    found = classify(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


@key(
    "op13_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (
        SELECT a.vec_id AS anchor_id, a.label, a.x, b.vec_id AS positive_id,
               CAST(list_dot_product(a.x, b.x) AS BIGINT) AS positive_score
        FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE a.vec_id % 100 = 0
        QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, b.vec_id) <= 5),
    n AS (
        SELECT p.anchor_id, p.positive_id, p.positive_score, b.vec_id AS negative_id,
               CAST(list_dot_product(p.x, b.x) AS BIGINT) AS negative_score
        FROM p JOIN v b ON p.label <> b.label)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
           negative_id, positive_score, negative_score
    FROM n
    WHERE 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
    QUALIFY rank <= 10""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.hard_negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@key("op12_license_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.license_scan import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d["kind"] == "base")
    kept = F.filter("detections", lambda d: d["kept"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"), F.array_max(base["first_word"]).alias("last_word"),
        labels(base).alias("base_labels"), labels(kept).alias("labels"), "score",
    )


@key(
    "op11_prefix_trie",
    """
    WITH RECURSIVE t AS (
        SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    c AS (
        SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
               xor(4294967295, list_reduce(
                   list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda z: ord(z)::BIGINT)),
                   lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i:
                       CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 6 AS h
        FROM t),
    r AS (
        SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
        UNION ALL
        SELECT c.conv_id, 10 + t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
    s AS (
        SELECT c.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS turns
        FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
    p AS (
        SELECT conv_id, 0 AS depth, len(turns) AS size, sha256('') AS path, CAST(NULL AS VARCHAR) AS parent, 0 AS chars, turns FROM s
        UNION ALL
        SELECT conv_id, depth + 1, size, sha256(path || length(turns[depth + 1].role) || ':' || turns[depth + 1].role || turns[depth + 1].text),
               path, length(turns[depth + 1].text), turns
        FROM p WHERE depth < size),
    n AS (
        SELECT path, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               any_value(chars) AS chars,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
        FROM p GROUP BY path),
    k AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
    up AS (
        SELECT path AS node, path AS ancestor FROM n
        UNION ALL
        SELECT up.node, n.parent FROM up JOIN n ON up.ancestor = n.path WHERE n.parent IS NOT NULL),
    below AS (
        SELECT ancestor, count(*) FILTER (WHERE k.parent IS NULL) AS n_leaves,
               sum((n.n_convs - 1) * n.chars) AS saved_tokens
        FROM up JOIN n ON up.node = n.path LEFT JOIN k ON k.parent = n.path GROUP BY ancestor)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
           b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM n LEFT JOIN n q ON n.parent = q.path LEFT JOIN k ON k.parent = n.path JOIN below b ON b.ancestor = n.path""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.prefix_trie import conversation_trie

    conv = F.col("conv_id")
    kept = F.crc32(conv.cast("string").cast("binary")) % 6
    return conversation_trie(table(spark, sf_dir, "conversations"), conv - conv % 100, kept, most=5)
