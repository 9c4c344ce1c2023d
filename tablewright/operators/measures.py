"""Measures over facts: totals in a date window, comparisons, currency choice, averages of sums, security.

A measure is evaluated at a grain, with the day it is asked for passed in. What a report
would compute by lifting filters is computed at the coarser grain and joined back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Window:
    """Condition on a date column for a day."""

    name: str
    test: Callable[[Column, Column], Column]


def _month(d: Column) -> Column:
    return F.trunc(d, "month").cast("date")


def _between(first: Callable[[Column], Column], last: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda c, day: c.between(first(day), last(day))


#: The prior month to date keeps the day's number, so that after a shorter month it runs into the current one.
WINDOWS = {
    "today": Window("today", lambda c, d: c == d),
    "yesterday": Window("yesterday", lambda c, d: c == F.date_sub(d, 1)),
    "mtd": Window("mtd", _between(_month, lambda d: d)),
    "pmtd": Window("pmtd", _between(lambda d: F.add_months(_month(d), -1), lambda d: F.date_add(F.add_months(_month(d), -1), F.dayofmonth(d) - 1))),
    "last_month": Window("last_month", _between(lambda d: F.add_months(_month(d), -1), lambda d: F.date_sub(_month(d), 1))),
    "next_month": Window("next_month", _between(lambda d: F.add_months(_month(d), 1), lambda d: F.last_day(F.add_months(_month(d), 1)))),
    "ytd": Window("ytd", lambda c, d: F.lit(True)),
    "ytd_to_date": Window("ytd_to_date", _between(lambda d: F.trunc(d, "year").cast("date"), lambda d: d)),
    "pytd": Window("pytd", lambda c, d: F.year(c) == F.year(d) - 1),
    "pytd_to_date": Window("pytd_to_date", _between(lambda d: F.add_months(F.trunc(d, "year"), -12), lambda d: F.add_months(d, -12))),
    "last_12_months": Window("last_12_months", lambda c, d: (c > F.add_months(d, -12)) & (c <= d)),
}


def windowed(value: Column, date_column: Column, window: str, as_of: Column) -> Column:
    """Sum of value over the rows in the window."""
    return F.sum(F.when(WINDOWS[window].test(date_column, as_of), value))


def dated(fact: DataFrame, grain: list[str], value: str, date_column: str, as_of: str, windows: list[str]) -> DataFrame:
    """One column a window, at the grain, in one pass."""
    day, d = F.lit(as_of).cast("date"), F.col(date_column).cast("date")
    return fact.groupBy(*grain).agg(*[windowed(F.expr(value), d, w, day).alias(w) for w in windows])


def twelve_month_average(fact: DataFrame, grain: list[str], value: str, date_column: str, as_of: str) -> DataFrame:
    out = dated(fact, grain, value, date_column, as_of, ["last_12_months"])
    return out.select(*grain, (F.col("last_12_months") / 12).alias("average_12_months"))


def comparator(current: Column, previous: Column) -> Column:
    """Relative change: null without a previous value, 0 for a previous 0."""
    return F.when(previous.isNotNull(), F.coalesce(F.try_divide(current - previous, previous), F.lit(0.0)))


def arrow(x: Column) -> Column:
    return F.when(x > 0, "↑").when(x == 0, "-").when(x < 0, "↓")


def change_word(x: Column) -> Column:
    return F.when(x > 0, "Positive").when(x < 0, "Negative").when(x == 0, "No Change")


def ratio(a: Column, b: Column, alternative: object = None) -> Column:
    """a / b, the alternative where b is 0 or null."""
    return F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(alternative).cast("double"))


def in_currency(columns: dict[str, str], selected: str | None, default: str | None = None) -> Column:
    """The column of the selected currency, chosen when the plan is built; the default one, or null, for others."""
    name = columns.get(selected or "") or default
    return F.col(name) if name else F.lit(None).cast("double")


def selected(column: Column, default: object = None) -> Column:
    """The one value that a column has in the group, else the default."""
    return F.when(F.min(column) == F.max(column), F.min(column)).otherwise(F.lit(default))


def shown(amount: Column, symbol: Column | str, decimals: int = 0) -> Column:
    """An amount as text with its currency's sign."""
    return F.concat(F.lit(symbol) if isinstance(symbol, str) else symbol, F.format_number(amount, decimals))


def by_field(df: DataFrame, grain: list[str], fields: list[tuple[str, str]]) -> DataFrame:
    """A field parameter: for each row of the grain and each (label, measure) in order: field, field_order and value, from which a report picks."""
    rows = F.explode(F.array(*[F.struct(F.lit(label).alias("field"), F.lit(i).alias("field_order"), F.col(c).cast("double").alias("value")) for i, (label, c) in enumerate(fields)]))
    return df.select(*grain, rows.alias("f")).select(*grain, "f.*")


def excluding(value: Column, test: Column) -> Column:
    """Sum over rows for which the dimension's test holds."""
    return F.sum(F.when(test, value))


def average_of_daily_sums(fact: DataFrame, grain: list[str], value: str, date_column: str) -> DataFrame:
    daily = fact.groupBy(*grain, F.col(date_column).cast("date").alias("__day")).agg(F.sum(F.expr(value)).alias("__sum"))
    return daily.groupBy(*grain).agg(F.avg("__sum").alias("average_daily"))


def at_coarser_grain(fact: DataFrame, grain: list[str], keep: list[str], measure: Column, name: str) -> DataFrame:
    """The measure at keep alone, beside every row of the grain."""
    return fact.select(*grain).distinct().join(fact.groupBy(*keep).agg(measure.alias(name)), keep)


def across_facts(parts: list[tuple[DataFrame, str]], grain: list[str], formula: str, name: str) -> DataFrame:
    """Facts already summed to the grain, joined there and combined by a formula."""
    every = functools.reduce(lambda a, b: a.join(b, grain, "full"), [df for df, _ in parts])
    return every.select(*grain, F.expr(formula).alias(name))


def visible(fact: DataFrame, bridge: DataFrame, fact_key: str, bridge_key: str, user_column: str, user: str) -> DataFrame:
    """Rows whose key the bridge gives to the user."""
    own = bridge.filter(F.col(user_column) == F.lit(user)).select(F.col(bridge_key).alias("__key")).distinct()
    return fact.join(own, F.col(fact_key) == F.col("__key"), "left_semi")


def in_hierarchy(people: DataFrame, user: str, person: str, reports_to: str, director: str, is_manager: str) -> DataFrame:
    """A manager's own row and those of people below."""
    mine = [F.col(c) == F.lit(user) for c in (person, reports_to, director)]
    return people.filter(F.col(is_manager) & functools.reduce(lambda a, b: a | b, mine))


# --- facts and dimensions -------------------------------------------------------


def fk(key: Column, found: Column, missing: int = 0, unmatched: int = -1) -> Column:
    """A dimension's id: missing for a null key, unmatched where the dimension has none."""
    return F.when(key.isNull(), F.lit(missing)).otherwise(F.coalesce(found, F.lit(unmatched)))


def in_other_currency(amount: Column, own: Column, other: Column | str, rate: Column) -> Column:
    """The amount itself in the same currency, else by the rate (null without one)."""
    other = F.lit(other) if isinstance(other, str) else other
    return F.when(own == other, amount).otherwise(F.try_divide(amount, F.nullif(rate, F.lit(0))))


def volume(quantity: Column, weight: Column) -> Column:
    return quantity * weight


def margin(amount: Column, cost: Column, quantity: Column, rebate: Column | None = None) -> Column:
    """What is left of an amount after costs and rebate; those that are missing count as 0."""
    return amount - F.coalesce(cost * quantity, F.lit(0)) - (F.coalesce(rebate, F.lit(0)) if rebate is not None else F.lit(0))


def with_attribute(items: DataFrame, key: str, chain: list[tuple[DataFrame, str, str]], value: str, name: str) -> DataFrame:
    """items with one attribute that a chain of tables leads to: each link is (table, column so far, column of the table).

    The chain is followed apart from the items and brought to one value (the largest) an
    item's key, so that an item with several values or none stays one row.
    """
    first, _, entry = chain[0]
    found = first.withColumn("__entry", F.col(entry))
    for table, left, right in chain[1:]:
        found = found.join(table.withColumn("__right", F.col(right)), F.col(left) == F.col("__right")).drop("__right")
    one = found.groupBy("__entry").agg(F.max(value).alias(name))
    return items.join(one, F.col(key) == F.col("__entry"), "left").drop("__entry")


def natural_key(*parts: Column, delimiter: str = "|", null: str = "") -> Column:
    return F.concat_ws(delimiter, *[F.coalesce(p.cast("string"), F.lit(null)) for p in parts])


def date_dimension(days: DataFrame, column: str = "date_value", financial_start: int = 5) -> DataFrame:
    """Calendar columns of days, with a financial year that begins in month financial_start and is named by the year it ends in."""
    d = F.col(column).cast("date")
    moved = F.add_months(d, 13 - financial_start if financial_start > 1 else 0)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"), d.alias("full_date"), F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), F.dayofmonth(d).alias("day_of_month"), F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"), F.year(d).alias("year"), F.date_format(d, "yyyy-MM").alias("year_month"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.year(moved).alias("financial_year"), F.month(moved).alias("financial_month"), F.quarter(moved).alias("financial_quarter"),
    )


def spaced(df: DataFrame) -> DataFrame:
    """Column names with spaces before capitals, as reports show them."""
    import re

    return df.toDF(*[re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", c) for c in df.columns])
