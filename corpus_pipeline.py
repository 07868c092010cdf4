"""Training-text pipeline over the documents table: five stages, each written and read by the next."""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardflow.llm import decontaminate, language_id, line_dedup, merge_replay, ngram_join
from hazardflow.llm.store import crc_fold, stored, unused

#: Odds at which a document counts as being in no language: short texts that say little either way stay.
NO_LANGUAGE = 1000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table teaches; languages are learned as in op10.

    One without a letter goes, and one that is ``NO_LANGUAGE`` times likelier in no language than in its
    best one. Where there is no language to learn, all documents with a letter stay.
    """
    names = docs.columns
    tokens = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    model = language_id.fit(docs.filter(crc_fold(F.col("doc_id"), 4) != 2), tokens) if "lang" in names else None
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {name: f"c{i}" for i, name in enumerate(names)}
    found = language_id.predict(inner, model, at["doc_id"], at["text"], keep=tuple(inner.columns), margin=True)
    return found.filter((F.col("lang_pred") != "und") & (F.col("margin") > -math.log(NO_LANGUAGE))).select(*inner.columns).toDF(*names)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines of 50 words or more; n_chars follows the text.

    A document whose words are all in such copies goes; its first copy stays. One that had no word
    before stays.
    """
    removed = unused("removed", docs.columns)
    out = line_dedup.remove_repeats(docs, removed=removed)
    out = out.filter(~((F.col(removed) > 0) & ~F.col("text").rlike(line_dedup.WORD))).drop(removed)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; of equal rows one stays."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    tokens = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return merge_replay.digests(merge_replay.encode(docs, tokens, public_tokenizers.PATTERN, decoded=True), "ids")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode_tokens),
]

#: Language ID is learned, so SQL cannot give the rows; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table; each stage's rows are stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
