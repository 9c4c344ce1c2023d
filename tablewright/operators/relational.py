"""Joins, unions, projections and aggregations as functions from DataFrames to a DataFrame."""

from __future__ import annotations

import functools
import operator as op
from typing import Any

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.errors import ConfigError
from tablewright.plans.config import Column, GroupBy, Join, Union

#: A side that a plan wants broadcast is so only up to this size by Catalyst's estimate; beyond it, Spark chooses.
BROADCAST_BYTES = 256 << 20
COMPARE = {"=": op.eq, "!=": op.ne, "<": op.lt, "<=": op.le, ">": op.gt, ">=": op.ge}


def tiebreak(df: DataFrame, but: tuple[str, ...] | list[str] = ()) -> list[C]:
    """All columns that can be ordered, so that row numbers don't depend on the run."""
    return [F.col(f"`{f.name}`").asc_nulls_last() for f in df.schema.fields if f.name not in but and "map<" not in f.dataType.simpleString()]


def keep_first(df: DataFrame, by: list[str], order: list[C]) -> DataFrame:
    """One row for each key, the first in order and then by all other columns."""
    place = F.row_number().over(W.partitionBy(*[F.col(f"`{k}`") for k in by]).orderBy(*(order + tiebreak(df, by) or [F.lit(1)])))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def small(df: DataFrame) -> bool:
    """Whether Catalyst's estimate of df's size lets it be broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= BROADCAST_BYTES


def joined(left: DataFrame, right: DataFrame, spec: Join, right_broadcast: bool = False) -> DataFrame:
    """left joined to right. The result has left's columns, then right's: one that left has too is named alias__column if the
    join has an alias, else it is left's value (for keys of right and full joins, right's where left has no row)."""
    if spec.dedupe_by:
        order = F.col(spec.dedupe_order_by)
        right = keep_first(right, list(spec.dedupe_by), [order.desc_nulls_last() if spec.dedupe_desc else order.asc_nulls_last()])
    name = spec.alias or spec.name
    other = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") for c in right.columns])
    tests = []
    for c in spec.conditions:
        a = left[_resolved(left, c.left)]
        b = other[f"__r_{c.right.rpartition('.')[2]}"]
        tests.append(COMPARE[c.operator](a, b))
    how = spec.type
    on = functools.reduce(op.and_, tests) if tests else F.lit(True)
    if (spec.broadcast or right_broadcast) and how in ("inner", "left", "cross") and small(right):
        other = F.broadcast(other)
    both = left.join(other, on) if how == "cross" else left.join(other, on, how)
    keys = {c.right.rpartition(".")[2]: _resolved(left, c.left) for c in spec.conditions if c.operator == "="}
    out = []
    for c in left.columns:
        mine = F.col(f"`{c}`")
        same = [r for r, mate in keys.items() if mate == c and r == c]
        out.append(F.coalesce(mine, F.col(f"`__r_{same[0]}`")).alias(c) if how in ("right", "full") and same and not spec.alias else mine)
    for c in right.columns:
        if c not in left.columns:
            out.append(F.col(f"`__r_{c}`").alias(c))
        elif spec.alias:
            out.append(F.col(f"`__r_{c}`").alias(f"{name}__{c}"))
    return both.select(*out)


def _resolved(df: DataFrame, reference: str) -> str:
    """The column of df that a.b or b names: alias__column first."""
    alias, _, c = reference.rpartition(".")
    for name in (f"{alias}__{c}", c):
        if name in df.columns:
            return name
    raise ConfigError(f"no column {reference!r} among {df.columns}")


def mapped(df: DataFrame, column_map: dict[str, str]) -> DataFrame:
    """df with target columns from expressions; a source column taken by its bare name is renamed, all others stay."""
    gone = {v for v in column_map.values() if v in df.columns} | set(column_map)
    return df.select(*[F.expr(v).alias(k) for k, v in column_map.items()], *[F.col(f"`{c}`") for c in df.columns if c not in gone])


def united(parts: list[DataFrame], spec: Union) -> DataFrame:
    """UNION ALL of parts (UNION with distinct). By name, columns come in alphabetical order; by position, they have the first one's names."""
    if spec.mode == "by_position":
        if len({len(p.columns) for p in parts}) > 1:
            raise ConfigError(f"union by position of {[len(p.columns) for p in parts]} columns")
        out = functools.reduce(DataFrame.union, parts)
    else:
        if not spec.allow_missing_columns and len({frozenset(p.columns) for p in parts}) > 1:
            raise ConfigError(f"union by name of different columns: {[sorted(p.columns) for p in parts]}")
        out = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        out = out.select(*[f"`{c}`" for c in sorted(out.columns)])
    return out.distinct() if spec.distinct else out


AGGREGATES = {
    "sum": F.sum, "avg": F.avg, "mean": F.mean, "min": F.min, "max": F.max, "count": F.count, "first": F.first, "last": F.last, "collect_list": F.collect_list,
    "collect_set": F.collect_set, "stddev": F.stddev, "stddev_pop": F.stddev_pop, "stddev_samp": F.stddev_samp, "variance": F.variance, "var_pop": F.var_pop,
    "var_samp": F.var_samp, "approx_count_distinct": F.approx_count_distinct, "count_distinct": F.count_distinct, "countdistinct": F.count_distinct,
}


def aggregate(spec: dict) -> C:
    """One aggregation: function, column or expression, distinct, alias (by default function_column). first and last take order_by, without which they depend on the order of rows."""
    name = str(spec.get("function", "")).lower()
    if name not in AGGREGATES:
        raise ConfigError(f"aggregate {name!r}; known are {sorted(AGGREGATES)}")
    text = spec.get("expression") or spec.get("column") or ("*" if name == "count" else None)
    if text is None:
        raise ConfigError(f"aggregate {name!r} needs a column or an expression")
    of = F.lit(1) if text == "*" else F.expr(text)
    if spec.get("order_by"):
        if name not in ("first", "last"):
            raise ConfigError(f"aggregate {name!r} has no order")
        by = spec["order_by"]
        order = F.struct(*[F.expr(c) for c in ([by] if isinstance(by, str) else by)])
        out = (F.min_by if name == "first" else F.max_by)(of, order)
    elif spec.get("distinct") and name not in ("min", "max", "count_distinct", "countdistinct", "collect_set", "approx_count_distinct"):
        if name == "count":
            out = F.count_distinct(of)
        elif name == "sum":
            out = F.sum_distinct(of)
        elif name in ("avg", "mean"):
            out = F.sum_distinct(of) / F.count_distinct(of)
        else:
            raise ConfigError(f"aggregate {name!r} has no distinct form")
    else:
        out = AGGREGATES[name](of)
    alias = spec.get("alias") or f"{name}_{'all' if text == '*' else text}".replace(".", "_")
    return out.alias(alias)


def grouped(df: DataFrame, spec: GroupBy) -> DataFrame:
    """Keys and aggregations, then the having filters; without aggregations the distinct keys."""
    keys = [F.expr(k).alias(k.rpartition(".")[2]) for k in spec.keys]
    out = df.groupBy(*keys).agg(*[aggregate(a) for a in spec.aggregations]) if spec.aggregations else df.select(*keys).distinct()
    return functools.reduce(DataFrame.filter, spec.having, out)


def expression(spec: Column, own: bool = False) -> C:
    """A column's value before its cast: its inputs (several are joined by the delimiter, nulls left out), else its default."""
    parts = [F.expr(i["expression"]) if "expression" in i else F.col(f"{i['source']}.{i['column']}" if i.get("source") else i["column"]) for i in spec.inputs]
    default = literal(spec.default)
    if not parts:
        return F.col(spec.name) if own else default
    out = parts[0] if len(parts) == 1 else F.concat_ws(spec.delimiter, *parts)
    if spec.default is None:
        return out
    if spec.data_type is not None and not spec.extensions.get("transform"):
        # both sides in the declared type: a default of another type than the input's must not turn the input into its own
        return F.when(out.isNull(), cast(default, spec)).otherwise(cast(out, spec))
    return F.coalesce(out, default)


def literal(x: Any) -> C:
    return F.lit(x)


def cast(c: C, spec: Column) -> C:
    """The declared type, null for values that it can't hold."""
    return c if spec.data_type is None else c.try_cast(spec.data_type.spark_type())
