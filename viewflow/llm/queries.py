"""The operators over the given tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from viewflow.llm import align, bpe, counts, html, langid, lm, neardup, packing, pii, quality, repair, topk, toxicity
from viewflow.llm.common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_copies(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path).drop("ids")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.links(table(spark, sf_dir, "documents"), *paths)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces without their ids."""
    return corpus_pipeline.run(spark, sf_dir).drop("ids")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_language_id": op2_language_id,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_top_k": op4_top_k,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_personal_data": op7_personal_data,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": pipeline,
}

LLM_ORACLES: dict[str, str] = {"op4_top_k": topk.ORACLE}
