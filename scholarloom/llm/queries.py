"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, exact_dedup, html_extract, line_dedup, near_dedup, packing, piece_bpe, suffix_dedup, toxicity, warc
from .common import table


def tokenizer_file(spark: SparkSession, name: str) -> str:
    """Path of a public tokenizer's file; the folder can be set as scholarloom.tokenizers."""
    folder = spark.conf.get("scholarloom.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(spark, "word_bpe_49k.json"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_report(table(spark, sf_dir, "documents"), tokenizer_file(spark, "piece_bpe_32k.model"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).drop("__key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc, op2_exact_dedup, op3_line_dedup, op4_toxicity, op5_packing, op6_html, op7_ann, op8_suffix_array, op9_sentencepiece, op10_minhash)}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages)
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(hex, CAST(1 + (i // 4) * 5 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
        FROM p WINDOW w AS (PARTITION BY html)""",
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_FOLD}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, i, line, translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
        k AS (SELECT key, min(doc_id) AS first_doc FROM l WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)),
        j AS (SELECT l.*, k.first_doc IS NOT NULL AND l.doc_id <> k.first_doc AS drop_it FROM l LEFT JOIN k USING (key))
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE drop_it) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
}
