"""The opN_ queries and their SQL: each applies its operator to a whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_filter
from .runtime import table

#: Where the public tokenizers' files are; a parameter, as they are no part of this library.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def tokenizer_path(name: str) -> str:
    """The file's place: by the tokenizer package where it is installed, else in TOKENIZERS."""
    if "TOKENIZERS_DIR" not in os.environ:
        try:
            import public_tokenizers
        except ImportError:
            pass
        else:
            return public_tokenizers.path(name)
    return f"{TOKENIZERS}/{name}"


def op2_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import scores

    return scores(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"), digest_all=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_groups

    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", (toxicity.fold("doc_id") == 1).alias("held_out"), "score", predicted.alias("predicted"), "worst")


#: The contract's rules.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = url_filter.train(url_filter.labelled(spark))
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), weights, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import recognise

    return recognise(table(spark, sf_dir, "documents"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_dedup import duplicate_spans

    return duplicate_spans(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "n_chunks", "kept", "first_doc_id")


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    read = warc.verify(warc.read_bundles(warc.write_bundles(table(spark, sf_dir, "pages"))))
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_best_two_fit_packing, op3_lm_score, op4_exact_dedup, op5_minhash_near_dedup, op6_url_filter, op7_licence_scan, op8_chunk_dedup, op9_warc_bundles, op10_decontamination)}

ORACLE_SQL = {
    "op6_url_filter": url_filter.oracle_sql(URL_RULES),
    "op9_warc_bundles": """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op4_exact_dedup": r"""
WITH normed AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM normed
""",
}
