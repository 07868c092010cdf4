"""One query for each operator, over its whole table. ``oracles`` holds the SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardflow.llm import (
    brown_lm, chat_format, decontaminate, gam_quality, html_text, language_id, line_dedup, merge_replay, ngram_join,
    prefix_trie, quality_rules, token_counts, whitening,
)
from hazardflow.llm.store import crc_fold


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _held_out(folds: int, remainder: int):
    return crc_fold(F.col("doc_id"), folds) == remainder


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json")) as definition:
        return token_counts.count_tokens(_documents(spark, sf_dir), definition.read())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    rules = quality_rules.fit(docs, _labels(spark, sf_dir))
    return quality_rules.apply(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.remove_repeats(docs, removed="n_removed_lines")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(_documents(spark, sf_dir))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = gam_quality.fit(docs, _labels(spark, sf_dir).filter(~_held_out(4, 2)))
    scored = gam_quality.predict(docs, model, threshold=0.7)
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_documents(spark, sf_dir), _benchmark(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return merge_replay.digests(merge_replay.encode(_documents(spark, sf_dir), tokens, public_tokenizers.PATTERN, decoded=True))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    tokens = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    model = language_id.fit(docs.filter(~_held_out(4, 2)), tokens)
    return language_id.predict(docs, model).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = whitening.coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = whitening.whiten(codes, whitening.fit(codes, components=16))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.turns(conversations), every=100, folds=6))


QUERIES = {name: function for name, function in list(globals().items()) if name.startswith("op")}
