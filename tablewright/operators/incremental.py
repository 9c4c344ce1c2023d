"""Loading only what is new: bounds from the target, from overrides, and whole periods."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_mark(target: DataFrame | None, column: str) -> Any:
    """The largest value in the target; None where there is no target, column or row."""
    if target is None or column not in target.columns:
        return None
    return target.agg(F.max(column)).first()[0]


def chosen_mark(mark: Any, override: str | None = None, table_override: date | None = None) -> Any:
    """A manual override (yyyy-mm-dd) beats all; one from the table counts if it is earlier."""
    if override:
        try:
            return date.fromisoformat(override)
        except ValueError:
            pass
    if table_override is not None and mark is not None:
        held = mark.date() if hasattr(mark, "date") and callable(mark.date) else mark
        return table_override if str(table_override) < str(held) else mark
    return mark


def table_override(overrides: DataFrame, pipeline: str) -> date | None:
    return overrides.filter(F.col("pipeline_name") == pipeline).agg(F.min("watermark_override")).first()[0]


def later_than(df: DataFrame, column: str, mark: Any) -> DataFrame:
    """Rows after the mark; all rows without a mark or column."""
    return df if mark is None or column not in df.columns else df.filter(F.col(column) > F.lit(mark))


def periods_from(df: DataFrame, column: str, mark: Any) -> DataFrame:
    """Rows of the mark's period and later ones."""
    return df if mark is None or column not in df.columns else df.filter(F.col(column) >= F.lit(mark))


def touched_periods(df: DataFrame, watermark_column: str, mark: Any, period_column: str) -> DataFrame:
    """All rows of each period in which any row is later than the mark."""
    if mark is None:
        return df
    return df.join(later_than(df, watermark_column, mark).select(period_column).distinct(), period_column, "left_semi").select(*df.columns)
