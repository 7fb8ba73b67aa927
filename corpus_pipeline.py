"""Corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and
returns the columns of documents; the last one returns the encoded documents.  `run` writes every
stage's result to the shared folder as Parquet and rereads it.

Defined cases, in every stage: a null id is kept as such; rows that repeat are judged each (exact duplicates of a text
leave one row); columns beside those of documents are carried along up to the last stage; an empty table stays empty.
A null or empty text has no language and goes in the first stage; a stage called on its own treats it as an empty text:
one of equal empty texts stays, it links with nothing, its topic is `empty`, and it has no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, langid, mixing, ngram_join
from tessera.llm.common import materialise, table

TOKENIZER = "byte_bpe_50k.tiktoken"
MIN_KNOWN = 0.05             # share of a text's n-grams that its language's filter must recognise
WORDS, SIMILARITY = 5, 80    # near duplicates: shingles of five words, similarity 0.8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language (null, no letters, or unknown n-grams)."""
    return langid.accepted(docs, langid.fit(docs), MIN_KNOWN)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts: the largest doc_id."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the smallest doc_id."""
    return ngram_join.survivors(docs, WORDS, SIMILARITY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their raked weights."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (uint32, little-endian) of every document, and the digest of what they decode to."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("ngram_jaccard", near), ("mixing", mix), ("byte_bpe", encode)]

ORACLE_SQL = None            # language ID and BPE have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
