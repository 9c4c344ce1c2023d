"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontamination, licenses, linededup, minhash, mixing, ngram, quality, sharding, sql, suffixdedup, topk
from tablewright.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.removed(table(spark, sf_dir, "documents"))


def op3_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.scores(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignments(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dropped_lines(table(spark, sf_dir, "documents"))


def op6_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(table(spark, sf_dir, "documents"))
    return found.withColumn("license_lines", F.concat_ws(",", "license_lines"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).drop("copies")


def op9_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_suffix_array, op3_ngram, op4_sharding, op5_line_dedup, op6_license_digest, op7_decontamination, op8_mixing, op9_ball_tree, op10_minhash)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
