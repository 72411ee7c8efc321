"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.alignment import align_tokenizers
from eventmart.llm.common import words_of
from eventmart.llm.decontamination import contaminated
from eventmart.llm.divergence import divergence_rules
from eventmart.llm.hardneg import hard_negatives
from eventmart.llm.licenses import license_scan
from eventmart.llm.mixing import mix_sources
from eventmart.llm.neardup import near_duplicates
from eventmart.llm.packing import best_fit_pack, token_pieces
from eventmart.llm.sharding import minimax_shards
from eventmart.llm.site_quality import site_quality
from eventmart.llm.spans import span_dedup
from eventmart.llm.substrings import substring_dedup
from eventmart.llm.warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
                       F.sha2(F.col("text"), 256).alias("group"))
    out = minimax_shards(rows, "group", "size", 40, ["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: the source is the host, the language within it the path."""
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup(table(spark, sf_dir, "documents"))


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_of(F.col("text")).alias("words"))
    return mix_sources(docs, "source", F.col("words"), ["doc_id"]).drop("words")


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"), label.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return best_fit_pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "length")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minimax_shards, op2_divergence_rules, op3_license_scan, op4_decontamination, op5_site_quality,
                            op6_sentence_spans, op7_repeated_substrings, op8_source_mix, op9_warc_round_trip, op10_near_duplicates,
                            op11_hard_negatives, op12_token_alignment, op13_best_fit_packing)}

# What SQL can express. The others are tested against brute force in tests/llm.
ORACLES = {
    "op9_warc_round_trip": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
        d AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS keeper,
                     [('0x' || substr(h, (k * 5 + 1)::INT, 5))::BIGINT for k in range(8)] AS parts FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((parts[(i // 4 + 1)::INT] >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)
                                for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
        FROM d""",
    "op10_near_duplicates": r"""
        WITH RECURSIVE w AS (SELECT doc_id, [x for x in regexp_split_to_array(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+') if x <> ''] AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest([array_to_string(ws[i + 1:i + 3], ' ') for i in range(greatest(len(ws) - 2, 1))]) AS g
              FROM w WHERE len(ws) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
              JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
              GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(na.n) + any_value(nb.n) - count(*))),
        links AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
        reach AS (SELECT doc_id AS node, doc_id AS seen FROM w
                  UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.seen)
        SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id, d.doc_id = min(r.seen) AS kept
        FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.vec_id AS aid, b.vec_id AS bid, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, bid) <= 5)
        SELECT p.aid AS anchor_id, p.bid AS positive_id,
               (row_number() OVER (PARTITION BY p.aid, p.bid ORDER BY s.score DESC, s.bid))::INT AS rank,
               s.bid AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.aid = p.aid AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
        QUALIFY rank <= 5""",
}
