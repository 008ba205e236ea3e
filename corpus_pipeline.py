"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

1. language: documents whose language can't be identified go;
2. near_duplicates: one document of each group of near duplicates stays;
3. decontaminate: documents that contain a benchmark item go;
4. mix: documents stay with the rate that the target mix of domains gives them
   (at most once each; toxic documents have rate 0);
5. shard: every document left gets its shard and slot.

Every stage works on all its predecessor kept.  The first four return the
columns of ``documents``, the last the assignment by id.  Nulls, empty and
repeated rows and empty tables: see the operator of the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import decontam, jaccard, langid, mixing, sharding
from headway.llm.store import drop_table, write_table

N_SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs, N_SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

# The trained classifiers, packing and similarity components are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_table(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
