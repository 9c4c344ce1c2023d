"""The corpus pipeline: five stages, each over all that the one before it kept.

quality: documents that score below the threshold go; near_duplicates: one document of
each group stays; decontamination: benchmark passages are cut out of the texts; mixing:
documents are left out or repeated to meet the sources' target weights; sharding: every
row gets its shard and slot. All stages but the last return the columns of documents.

Defined cases: a null or empty text is scored as the model scores no text, links with
nothing, holds no benchmark passage, weighs nothing in the mix (its row is taken as often
as its source's whole repetitions say) and fills a slot; a text whose words are all cut
out goes; rows that repeat a doc_id are one document to the near-duplicate stage, which
keeps one of them; a null doc_id or source is a value of its own; an empty table passes as
an empty table; further columns, whatever their names, stay as they are, but shard and
slot, which the last stage sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontamination, minhash, mixing, quality, sharding
from tablewright.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL can't train a classifier or hash shingles; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
