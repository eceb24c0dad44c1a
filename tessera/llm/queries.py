"""The queries over the shared tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, exact_dedup, fingerprints, html_extract, jaccard_join, mixing, packing, substring_dedup, suffix_dedup, toxicity
from .common import table


def byte_bpe() -> str:
    """Path of the public byte-level BPE vocabulary that the packing query counts in."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_ids(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digests(chat.format_conversations(chat.log_of(rows.unionByName(extra))))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_mix_sources": op2_mix_sources,
        "op3_html_extraction": op3_html_extraction,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_toxicity": op5_toxicity,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_fingerprints": op9_fingerprints,
        "op10_exact_dedup": op10_exact_dedup,
    }


ORACLE = {
    "op6_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        said AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                string_agg('<s>[INST]' || role || chr(10) || regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\2\\\3', 'g') || '[/INST]</s>', '' ORDER BY turn, role, text) AS formatted
            FROM rows GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
            sha256(loss) AS loss_sha256, length(formatted) AS formatted_chars
        FROM said""",
    "op10_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
}
