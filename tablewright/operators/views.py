"""Views over run metrics and ingestion logs."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def layer(table: Column, names: tuple[str, ...] = ("bronze", "silver", "gold")) -> Column:
    """The layer that a table's name begins with."""
    return functools.reduce(lambda a, n: a.when(F.lower(table).like(f"{n}%"), n), names[1:], F.when(F.lower(table).like(f"{names[0]}%"), names[0])).otherwise("other")


def pipeline_health(runs: DataFrame) -> DataFrame:
    """Each table's latest run, with its rejection rate."""
    last = F.row_number().over(W.partitionBy("table_name").orderBy(F.desc("started_at"), F.desc("run_id")))
    latest = runs.withColumn("__n", last).filter("__n = 1")
    rate = F.when(F.col("rows_read") > 0, F.round(100.0 * F.col("rows_rejected") / F.col("rows_read"), 2)).otherwise(F.lit(0.0))
    return latest.select("table_name", layer(F.col("table_name")).alias("layer"), "run_id", "status", "started_at", "rows_read", "rows_rejected", rate.alias("rejection_rate"))


def rejection_trend(runs: DataFrame) -> DataFrame:
    """Runs, failures, rows, rate and durations of each table and day."""
    n = lambda status: F.sum(F.when(F.col("status") == status, 1).otherwise(0))
    out = runs.groupBy("table_name", F.col("started_at").cast("date").alias("run_date")).agg(
        F.count("*").alias("runs"), n("failed").alias("failed_runs"), n("skipped").alias("skipped_runs"), F.sum("rows_read").alias("rows_read"), F.sum("rows_rejected").alias("rows_rejected"),
        F.avg("duration_seconds").alias("avg_duration"), F.max("duration_seconds").alias("max_duration"),
    )
    rate = F.when(F.col("rows_read") > 0, F.round(100.0 * F.col("rows_rejected") / F.col("rows_read"), 2)).otherwise(F.lit(0.0))
    return out.withColumn("rejection_rate", rate)


def dq_summary(quality: DataFrame, runs: DataFrame) -> DataFrame:
    """Issues by table, layer, day, kind, action and column."""
    both = quality.join(runs.select("run_id", "table_name", "started_at"), "run_id")
    return both.groupBy("table_name", layer(F.col("table_name")).alias("layer"), F.col("started_at").cast("date").alias("run_date"), "issue_type", "action", "column_name").agg(F.sum("affected_rows").alias("affected_rows"), F.count_distinct("run_id").alias("runs"))


def of_layers(tables: dict[str, DataFrame], columns: dict[str, str]) -> DataFrame:
    """The same columns of several layers' tables under new names, one below the other, with the layer."""
    parts = [df.select(*[F.col(a).alias(b) for a, b in columns.items()], F.lit(name).alias("layer")) for name, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


#: Columns of the tables of rejected and of duplicate rows, and their names in the views.
REJECTED = {"_dq_run_id": "run_id", "_dq_table_name": "table_name", "_dq_load_id": "load_id", "_dq_column_name": "column_name", "_dq_rejection_reason": "rejection_reason", "_dq_rule_name": "rule_name", "_dq_rejected_at": "rejected_at", "_dq_natural_id": "natural_id", "_dq_record": "record_json"}
DUPLICATES = {"_dq_run_id": "run_id", "_dq_table_name": "table_name", "_dq_load_id": "load_id", "_dq_natural_keys": "natural_keys", "_dq_detected_at": "detected_at"}


def rejected(tables: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows of all layers that have a table of them."""
    return of_layers(tables, REJECTED)


def duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate rows of all layers that have a table of them."""
    return of_layers(tables, DUPLICATES)


def unresolved(tables: dict[str, DataFrame]) -> DataFrame:
    """Unresolved foreign keys, or their records, of all layers that have a table of them, as they stand; columns that one lacks are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("layer", F.lit(name)) for name, df in tables.items()])


def dim_load(runs: DataFrame) -> DataFrame:
    return runs.groupBy("load_id").agg(F.count_distinct("run_id").alias("runs"), F.count_distinct("table_name").alias("tables"), F.min("started_at").cast("date").alias("load_date"))


def dim_run(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "load_id", "table_name", layer(F.col("table_name")).alias("layer"), "status", "started_at", "duration_seconds").distinct()


def ingestion(parts: dict[str, DataFrame]) -> DataFrame:
    """File, object and list ingestion in one form: (ingestion_type, run_id, source, status, row_count, at)."""
    return functools.reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("ingestion_type"), "run_id", "source", "status", "row_count", "at") for kind, df in parts.items()])
