"""The ``opN_`` queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm import conversations, html_text, langid, lines, mixing, packing, quality, simhash, substrings, token_alignment, token_files, topk, warc
from obsframe.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("spans")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages written to the shared scratch folder, and every record read back through the index."""
    folder = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.search(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as the host: the text without boilerplate lines, and what was dropped."""
    found = lines.drop_boilerplate(table(spark, sf_dir, "documents"), F.col("source"))
    return found.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop(*quality.FLOORS)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents and the calibrated probability that each had."""
    found = mixing.sample(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(conversations.repair(conversations.damage(table(spark, sf_dir, "conversations"))))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all documents' ids in the shared scratch folder, read back as a whole."""
    folder = token_files.new_folder(spark)
    token_files.write(table(spark, sf_dir, "documents"), folder)
    return token_files.read_all(spark, folder).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *token_alignment.STATS, "n_best", "count_sum", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_simhash_dedup, op3_main_text, op4_warc_index, op5_exact_topk, op6_line_dedup, op7_quality_rules, op8_best_fit_packing, op9_source_mixing, op10_language_id,
                                op11_conversation_repair, op12_token_files, op13_token_alignment)}

WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= {warc.MIN_SHARED} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN last USING (payload_digest)"""

TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES: dict[str, str] = {"op4_warc_index": WARC_SQL, "op5_exact_topk": TOPK_SQL, "op6_line_dedup": lines.oracle(),
                           "op7_quality_rules": quality.oracle(), "op9_source_mixing": mixing.oracle()}
