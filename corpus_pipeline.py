"""A training-corpus pipeline from the operators of ``tenantmart.llm``.

Quality classifier (rejected documents go), exact de-duplication, SimHash
near-duplicates (one document of each group stays), mixing to target weights
(a document can come twice), then BPE ids.  Every stage works on all rows that
the stage before it kept; the stages hand over Parquet tables on the shared
folder, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenantmart.llm import bpe, exact_dedup, mixing, quality, simhash
from tenantmart.llm.common import materialise, table
from tenantmart.llm.queries import WORD_BPE


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, WORD_BPE)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL has no hashed n-gram model, SimHash, seeded draw or BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
