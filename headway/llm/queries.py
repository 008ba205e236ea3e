"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, html, jaccard, langid, licenses, lines, lm, middle, mixing, multiindex, sharding, topk, vafile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mixing")
def op1_mixing(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_decontamination", decontam.ORACLE_SQL)
def op2_decontamination(spark, sf_dir):
    return decontam.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_license_scan")
def op3_license_scan(spark, sf_dir):
    return licenses.digest(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    return langid.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


@query("op5_jaccard_join", jaccard.ORACLE_SQL)
def op5_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op6_line_dedup", lines.ORACLE_SQL)
def op6_line_dedup(spark, sf_dir):
    return lines.clean(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    return sharding.digest(table(spark, sf_dir, "documents"), n_shards=40)


@query("op8_topk_search", topk.ORACLE_SQL)
def op8_topk_search(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query("op10_lm_scoring")
def op10_lm_scoring(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


@query("op11_fill_in_middle", middle.ORACLE_SQL)
def op11_fill_in_middle(spark, sf_dir):
    return middle.digest(table(spark, sf_dir, "documents"))


@query("op12_approximate_neighbours")
def op12_approximate_neighbours(spark, sf_dir):
    return multiindex.search(table(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op13_centroid_clustering", vafile.ORACLE_SQL)
def op13_centroid_clustering(spark, sf_dir):
    return vafile.cluster(table(spark, sf_dir, "embeddings"))
