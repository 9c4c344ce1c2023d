"""Column checks: what a rule finds, and what is done about it."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.errors import ConfigError


def _acted(df: DataFrame, column: str, bad: Column, action: str, fill: Any) -> tuple[DataFrame, DataFrame]:
    """df after the action on its bad rows, and those rows."""
    if action not in ("reject", "warn", "fill"):
        raise ConfigError(f"column {column!r}: action {action!r}")
    found = df.filter(bad)
    if action == "reject":
        return df.filter(~bad), found
    if action == "fill" and fill is not None:
        return df.withColumn(column, F.when(bad, F.lit(fill).cast(df.schema[column].dataType)).otherwise(F.col(column))), found
    return df, found


def not_null(df: DataFrame, column: str, on_null: str = "reject", fill_value: Any = None) -> tuple[DataFrame, DataFrame]:
    """Nulls are rejected, kept (warn; fill without a value) or filled."""
    return _acted(df, column, F.col(column).isNull(), on_null, fill_value)


def in_set(df: DataFrame, column: str, allowed_values: list, on_violation: str = "reject", fill_value: Any = None) -> tuple[DataFrame, DataFrame]:
    """Values outside the set are rejected, kept or filled; null passes."""
    if not allowed_values:
        raise ConfigError(f"column {column!r}: in_set needs allowed_values")
    return _acted(df, column, F.coalesce(~F.col(column).isin(*allowed_values), F.lit(False)), on_violation, fill_value)


def violations(found: DataFrame, keys: list[str], column: str, rule: str, sample_limit: int | None = None) -> DataFrame:
    """Bad rows in the form of a violation log: keys, column, rule, value."""
    out = found.select(*keys, F.lit(column).alias("column_name"), F.lit(rule).alias("rule_name"), F.col(column).cast("string").alias(f"value_{column}"))
    return out.limit(sample_limit) if sample_limit else out
