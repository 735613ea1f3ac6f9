"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage is ``function(spark, docs, sf_dir)``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstream.llm import bpe, decontam, jaccard, langid, linededup
from revstream.llm.common import stored
from revstream.llm.queries import TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text, without mixtures of languages; ``lang`` stays as it was given.

    The model learns from the labelled rows of the input. Rejected are documents without text or letters, and those
    in which no language has 40 % of the letters. Texts in scripts that no learned language uses stay.
    """
    return langid.keep_determined(docs, langid.learn(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the line chunks that an earlier document has."""
    return linededup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", tokenize),
]

# Viterbi labelling and subword merges have no SQL form; tests/llm compares the operators with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
