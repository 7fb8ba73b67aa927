"""Registered queries of the operators: thin readings of their outputs over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, centroids, chat_tree, exact_dedup, grid_join, langid, mixing, ngram_join, quality,
                         sql, suffix_dedup, token_files, toxicity, turn_repair)
from tessera.llm.common import held_out, table

TOKENIZER = "byte_bpe_50k.tiktoken"
TOKENIZER_JSON = "byte_bpe_50k.json"


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    nodes, paths = chat_tree.format_tree(turns.unionByName(chat_tree.probe(spark)))
    return chat_tree.read_back(nodes, paths)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.classes(table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out("doc_id", 5, 0)))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out("doc_id", 4, 2)))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.calibrate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "tokens",
                      *[F.round(c, 6).alias(c) for c in ("rate", "p", "weight")], "sampled", F.round("marginal_error", 6).alias("marginal_error"))


def op7_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.link_classes(table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    back = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"), n=4, pct=85)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out("doc_id", 5, 0)))
    return quality.score(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.report(turns, turn_repair.damage(turns))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_JSON))
    return token_files.read(manifest, folder).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_tree": op1_chat_tree,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_grid_join": op7_grid_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_ngram_join": op9_ngram_join,
    "op10_quality": op10_quality,
    "op11_turn_repair": op11_turn_repair,
    "op12_token_files": op12_token_files,
    "op13_centroids": op13_centroids,
}

ORACLES = {
    "op1_chat_tree": sql.OP1,
    "op7_grid_join": sql.OP7,
    "op9_ngram_join": sql.OP9,
    "op11_turn_repair": sql.OP11,
    "op13_centroids": sql.op13(),
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op6_mixing": mixing.oracle(),
}
