"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from genrec.llm import (
    cover_tree,
    html_text,
    oracle,
    order_minhash,
    personal_data,
    piece_sampling,
    prefix_trie,
    quality_rules,
    secret_scan,
    source_mix,
    structure_repair,
    token_files,
    tool_calls,
    url_filters,
)
from genrec.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_conversations(table(spark, sf_dir, "conversations"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair(table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_cover_tree, op3_html_text, op4_piece_sampling, op5_personal_data, op6_url_filters,
        op7_token_files, op8_source_mix, op9_order_minhash, op10_tool_calls, op11_structure_repair,
        op12_secret_scan, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
