"""The queries of this subpackage, one an operator, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, gif, language, mixing, secrets, simhash, sql, substrings, toxicity, winnowing
from tessera.session import attach, table


def op1_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes stored as GIF frames, read back and described."""
    docs = table(attach(spark), sf_dir, "documents")
    return gif.digests(gif.store_bytes(docs, "doc_id", "text"), "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links reach."""
    found = simhash.near_duplicates(table(attach(spark), sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document gives to a mix of all sources; quality labels weigh the sampling."""
    docs, labels = table(attach(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(mixing.sized(docs, labels)).select("doc_id", "size", "source_size", "target", "taken")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings only, formatted and read back."""
    there = table(attach(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(there.unionByName(own)))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the public word-end vocabulary and decoded again."""
    docs = table(attach(spark), sf_dir, "documents")
    return bpe.digests(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from labelled documents outside the held-out fold."""
    docs = table(attach(spark), sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.train(docs, ~held, public_tokenizers.path("piece_bpe_32k.model"))
    return language.predict(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; a document is its own repository, its source the owner."""
    return secrets.report(secrets.scan(table(attach(spark), sf_dir, "documents")))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness and the next document's."""
    return winnowing.compare_edited(table(attach(spark), sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from labelled documents outside the held-out fold."""
    docs, labels = table(attach(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.crc_of_id() % 5 == 0
    net, prior = toxicity.fit(docs, labels, ~held)
    scored = toxicity.score(docs, net, prior=prior)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated 20-word windows."""
    return substrings.digests(substrings.dedup(table(attach(spark), sf_dir, "documents")))


QUERIES = {
    "op1_gif": op1_gif,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_chat": op4_chat,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_secrets": op7_secrets,
    "op8_winnowing": op8_winnowing,
    "op9_toxicity": op9_toxicity,
    "op10_substrings": op10_substrings,
}

ORACLE_SQL = {"op3_mixing": sql.MIXING, "op4_chat": sql.CHAT, "op7_secrets": sql.SECRETS}
