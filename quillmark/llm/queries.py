"""The registered queries of the ten operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, licenses, minmax, mixing, moore_lewis, packing, quality, token_store, toxicity, warc
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, read_table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_output(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op5_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.search(spark, read_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moore_lewis.score(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    found: list[Query] = [
        op1_license_scan, op2_token_output, op3_toxicity, op4_minmax_near_dedup, op5_cover_tree_topk, op6_quality_rules, op7_cross_entropy_difference, op8_mixture_packing, op9_poisson_mixing, op10_arc_to_warc,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.sql(),
        "op5_cover_tree_topk": covertree.SQL,
        "op7_cross_entropy_difference": moore_lewis.SQL,
        "op9_poisson_mixing": mixing.SQL,
        "op10_arc_to_warc": warc.SQL,
    }
