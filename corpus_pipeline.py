"""A corpus from raw documents to packed sequences: each stage works on what the one before it kept.

SQL cannot express the stages; tests/llm holds each against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import common, ngramjoin, packing, substrings, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5. The classifier learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id"))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by equal five-word shingles (similarity 0.8 or more)."""
    return ngramjoin.one_of_each(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages of 20 words or more that stand earlier in the corpus."""
    return substrings.remove_repeats(docs, size=20)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, cache=150_000)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("substring_dedup", cut_repeats), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents. What a stage returns is written to the shared folder and read again; what
    the one before it returned is removed then."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = common.shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
