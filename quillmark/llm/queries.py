"""The queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import bytebpe, chat_format, divergence, exact_dedup, fill_middle, flac, html_blocks, katz, langid, packing, partenum, url_graph, whitening
from quillmark.llm.common import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chat(table(spark, sf_dir, "conversations"), chat_format.SCHEMAS)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(table(spark, sf_dir, "pages"), url_graph.RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(table(spark, sf_dir, "documents"))


def op4_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op9_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.features(flac.encode_column(table(spark, sf_dir, "documents")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judge(table(spark, sf_dir, "documents"), keep="largest")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_url_filters, op3_ngram_jaccard, op4_katz_scoring, op5_language_id, op6_html_extraction, op7_packing, op8_distribution_divergence, op9_flac, op10_byte_bpe, op11_fill_middle, op12_exact_dedup, op13_whitening)}
