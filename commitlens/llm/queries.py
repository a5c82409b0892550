"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them.

Every query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from commitlens.llm.chat import formatted_conversations
from commitlens.llm.collocations import collocations
from commitlens.llm.common import table
from commitlens.llm.decontaminate import leaks
from commitlens.llm.htmltext import main_text
from commitlens.llm.neardup import near_duplicates
from commitlens.llm.ngram import language_scores
from commitlens.llm.oracles import ORACLE
from commitlens.llm.pieces import round_trips
from commitlens.llm.pii import personal_spans
from commitlens.llm.quality import quality_verdicts
from commitlens.llm.secrets import secret_spans
from commitlens.llm.sharding import shard_rows
from commitlens.llm.spelling import spelling_variants
from commitlens.llm.tokens import token_counts

__all__ = ["ORACLE", "QUERIES"]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql("select * from values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                        "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)")
    return formatted_conversations(known.union(control))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "host_rejected")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_decontaminate, op3_html_text, op4_chat, op5_token_counts, op6_pii, op7_lm_score,
    op8_sentencepiece, op9_quality, op10_minhash, op11_spelling_variants,
    op12_collocations, op13_sharding)}
