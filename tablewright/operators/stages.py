"""Whole-table steps that a stage names: dedupe, duplicate reports, periods, sentinels, foreign keys, flows."""

from __future__ import annotations

import functools
import operator as op
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.errors import ConfigError
from tablewright.operators.relational import keep_first


def dedupe_keep_last(df: DataFrame, partition_by: list[str], order_by: list[str], order_desc: bool = True) -> DataFrame:
    """The last row of each key; ties go by the other columns."""
    if not partition_by or not order_by:
        raise ConfigError("dedupe_keep_last needs partition_by and order_by")
    return keep_first(df, partition_by, [F.col(c).desc_nulls_last() if order_desc else F.col(c).asc_nulls_last() for c in order_by])


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows, or one for each value of columns (the first by the others)."""
    return keep_first(df, columns, []) if columns else df.distinct()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have, with n_rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of such keys."""
    return df.join(duplicate_keys(df, keys), keys, "left_semi")


def check_duplicates(df: DataFrame, keys: list[str], action: str = "reject") -> DataFrame:
    """reject keeps one row of each key; flag and log keep all."""
    if action not in ("reject", "flag", "log"):
        raise ConfigError(f"check_duplicates: action {action!r}")
    return keep_first(df, keys, []) if action == "reject" else df


def latest_per_period(df: DataFrame, partition_by: list[str], period: str, order: str) -> DataFrame:
    """All rows at the largest order of their (partition, period)."""
    groups = [*partition_by, period]
    # maxima are summed up before the shuffle and joined back, so that no task needs a whole period
    newest = df.groupBy(*[F.col(c).alias(f"__g_{c}") for c in groups]).agg(F.max(order).alias("__newest"))
    same = functools.reduce(op.and_, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in groups], F.col(order) == F.col("__newest"))
    return df.join(newest, same, "left_semi")


def period_sets(df: DataFrame, period: str, partition_by: list[str] | None = None) -> DataFrame:
    """What a replace_by_partition write will replace: distinct periods, with their partitions."""
    return df.select(*(partition_by or []), period).distinct()


def ensure_sentinels(df: DataFrame, records: list[dict], key: str | None = None) -> DataFrame:
    """df and the records in its own types, missing columns null; with key, records that df has already are left out."""
    out = df
    for r in records:
        unknown = set(r) - set(df.columns)
        if unknown:
            raise ConfigError(f"sentinel has unknown columns {sorted(unknown)}")
        row = df.sparkSession.range(1).select(*[F.lit(r.get(f.name)).try_cast(f.dataType).alias(f.name) for f in df.schema.fields])
        out = out.unionByName(row.join(df, key, "left_anti").select(*df.columns) if key else row)
    return out


def unresolved_fks(df: DataFrame, checks: list[dict]) -> DataFrame:
    """A row for each check {column, sentinel}: fk_column, sentinel, unresolved_count, total_count, unresolved_pct; one pass over df."""
    if not checks:
        raise ConfigError("check_unresolved_fks needs checks")
    sums = [F.sum(F.when(F.col(c["column"]) == F.lit(c["sentinel"]), 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(checks)]
    one = df.agg(F.count("*").alias("total"), *sums)
    rows = F.explode(F.array(*[F.struct(F.lit(c["column"]).alias("fk_column"), F.lit(str(c["sentinel"])).alias("sentinel"), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("n")) for i, c in enumerate(checks)]))
    pct = F.when(F.col("total") > 0, F.round(100.0 * F.col("r.n") / F.col("total"), 2)).otherwise(F.lit(0.0))
    return one.select("total", rows.alias("r")).select("r.fk_column", "r.sentinel", F.col("r.n").alias("unresolved_count"), F.col("total").alias("total_count"), pct.alias("unresolved_pct"))


def unresolved_records(df: DataFrame, checks: list[dict], limit: int | None = None) -> DataFrame:
    """Rows with an unresolved key as JSON, with the names of those keys."""
    bad = F.filter(F.array(*[F.when(F.col(c["column"]) == F.lit(c["sentinel"]), F.lit(c["column"])) for c in checks]), lambda x: x.isNotNull())
    out = df.select(F.to_json(F.struct(*df.columns)).alias("record"), bad.alias("fk_columns")).filter(F.size("fk_columns") > 0)
    return out.limit(limit) if limit else out


def previous_period(df: DataFrame, keys: list[str], period: str, amount: str) -> DataFrame:
    """For each key and period: amount (0 where the key is lost), previous_amount in the period observed before, and is_lost_key.

    A key with a row in one period and none in the next observed one appears there as lost.
    Null keys are equal to each other.
    """
    periods = df.select(period).distinct()
    following = periods.select(F.col(period).alias("__from"), F.lead(period).over(W.orderBy(period)).alias("__to"))
    before = df.join(following, F.col(period) == F.col("__from")).filter(F.col("__to").isNotNull())
    before = before.select(*[F.col(k).alias(f"__b_{k}") for k in keys], F.col("__to").alias("__b_period"), F.col(amount).alias("__b_amount"), F.lit(True).alias("__b"))
    same = functools.reduce(op.and_, [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in keys], F.col(period) == F.col("__b_period"))
    both = df.select(*keys, period, amount, F.lit(True).alias("__a")).join(before, same, "full")
    own = F.col("__a").isNotNull()
    return both.select(
        *[F.when(own, F.col(k)).otherwise(F.col(f"__b_{k}")).alias(k) for k in keys], F.coalesce(F.col(period), F.col("__b_period")).alias(period),
        F.when(own, F.col(amount)).otherwise(F.lit(0).cast(df.schema[amount].dataType)).alias(amount), F.col("__b_amount").alias("previous_amount"), (~own & F.col("__b_amount").isNotNull()).alias("is_lost_key"),
    )


def override_dates(fact: DataFrame, checks: list[dict], date_column: str, as_of: date, lookback_days: int = 90) -> DataFrame:
    """For each foreign key with unresolved rows in the lookback: fk_column, unresolved_count and the day before the first one, from which to load again."""
    recent = fact.filter(F.col(date_column).cast("date") >= F.lit(as_of - timedelta(days=lookback_days)))
    parts = []
    for c in checks:
        rows = recent.filter(F.col(c["column"]) == F.lit(c["sentinel"])).agg(F.count("*").alias("unresolved_count"), F.date_sub(F.min(F.col(date_column).cast("date")), 1).alias("watermark_override"))
        parts.append(rows.select(F.lit(c["column"]).alias("fk_column"), "unresolved_count", "watermark_override").filter("unresolved_count > 0"))
    return functools.reduce(DataFrame.unionByName, parts)


def merged_overrides(held: DataFrame, new: DataFrame, key: str = "pipeline_name") -> DataFrame:
    """Overrides by key, the earlier date of both."""
    return held.unionByName(new, allowMissingColumns=True).groupBy(key).agg(F.min("watermark_override").alias("watermark_override"))


def delta_load(df: DataFrame, keys: list[str], order_by: str, watermark: object | None) -> DataFrame:
    """Rows later than the watermark (all without one), the last of each key."""
    newer = df if watermark is None else df.filter(F.col(order_by) > F.lit(watermark))
    return dedupe_keep_last(newer, keys, [order_by])


def natural_key_json(keys: list[str]):
    return F.to_json(F.struct(*keys))


def rejected_records(df: DataFrame, keys: list[str], reason: str, column: str, rule: str, table: str, run_id: str = "", load_id: str = "", at=None) -> DataFrame:
    """Rows in the form of the rejected-row table."""
    return df.select(
        natural_key_json(keys).alias("_dq_natural_id"), F.to_json(F.struct(*df.columns)).alias("_dq_record"), F.lit(reason).alias("_dq_rejection_reason"), F.lit(column).alias("_dq_column_name"),
        F.lit(rule).alias("_dq_rule_name"), F.lit(table).alias("_dq_table_name"), F.lit(run_id).alias("_dq_run_id"), F.lit(load_id).alias("_dq_load_id"), F.lit(at).cast("timestamp").alias("_dq_rejected_at"),
    )


def duplicate_records(df: DataFrame, keys: list[str], table: str, run_id: str = "", load_id: str = "", at=None) -> DataFrame:
    """Duplicate rows in the form of the duplicate-row table."""
    rows = duplicate_rows(df, keys)
    return rows.select(
        natural_key_json(keys).alias("_dq_natural_id"), F.to_json(F.struct(*df.columns)).alias("_dq_record"), F.lit(table).alias("_dq_table_name"), F.lit(run_id).alias("_dq_run_id"),
        F.lit(load_id).alias("_dq_load_id"), F.lit(",".join(keys)).alias("_dq_natural_keys"), F.lit(at).cast("timestamp").alias("_dq_detected_at"),
    )
