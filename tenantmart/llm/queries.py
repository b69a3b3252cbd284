"""The registered queries of the corpus operators: each runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, hard_negatives, html_text, mixing, quality, rules, sharding, simhash, spelling, token_files, toxicity
from .common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_digests(spark, token_files.write_ids(table(spark, sf_dir, "documents"), WORD_BPE))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id, text = chat.PROBE
    probe = spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.chat_digests(spark, chat.write_chats(rows, BYTE_BPE), BYTE_BPE)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digests(spark, sharding.write_shards(table(spark, sf_dir, "documents")))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("drawn")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling(table(spark, sf_dir, "documents"), spelling.ODD)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.with_odd_labels(hard_negatives.usable(table(spark, sf_dir, "embeddings")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_quality, op3_exact_dedup, op4_token_files, op5_simhash, op6_html, op7_chat, op8_sharding, op9_rules, op10_mixing,
    op11_spelling, op12_hard_negatives, op13_toxicity)}
ORACLE_SQL = {"op3_exact_dedup": exact_dedup.ORACLE_SQL, "op7_chat": chat.ORACLE_SQL, "op11_spelling": spelling.ORACLE_SQL,
              "op12_hard_negatives": hard_negatives.ORACLE_SQL}
