"""Merging a batch of rows into a table, as a function of two DataFrames: every strategy is one classified full outer join."""

from __future__ import annotations

import functools
import operator as op
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.errors import ConfigError, WriterError


@dataclass(frozen=True)
class MergeSpec:
    keys: tuple[str, ...]
    strategy: str = "update_all"
    compare: tuple[str, ...] = ()  # columns that make a change; by default all but keys
    milestones: tuple[str, ...] = ()
    as_of: object = None  # when versions end and begin, for scd_type2
    start_column: str = "valid_from"
    end_column: str = "valid_to"
    current_column: str = "is_current"
    deleted_column: str = "is_deleted"
    missing_in_source: str = "flag"  # or ignore, for soft_delete


def faults(source: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """Keys of source that can't be merged: null in part, or on several rows; empty if all is well."""
    null = functools.reduce(op.or_, [F.col(k).isNull() for k in keys])
    return source.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(null | (F.col("n_rows") > 1))


def checked(source: DataFrame, spec: MergeSpec, target: str = "target") -> None:
    """Raise where faults() finds any."""
    if not spec.keys:
        raise WriterError(target, "merge", "needs a natural key")
    bad = faults(source, spec.keys).take(1)
    if bad:
        raise WriterError(target, "merge", f"null or repeated natural key: {bad[0].asDict()}")


def _changed(columns: list[str]) -> Column:
    return functools.reduce(op.or_, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in columns], F.lit(False))


def classified(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """The rows of target after the merge, with _class: insert, update, unchanged, target_only, expire or delete."""
    missing = [k for k in spec.keys if k not in source.columns or k not in target.columns]
    if missing:
        raise ConfigError(f"merge: no key columns {missing}")
    if spec.strategy == "scd_type2":
        return _versioned(target, source, spec)
    names = list(target.columns) + [c for c in source.columns if c not in target.columns]
    t = target.select(*target.columns, *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in names if c not in target.columns])
    own = set(source.columns)
    s = source.select(*[F.col(c) if c in own else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in names])
    if spec.strategy == "insert_only":
        new = s.join(t.select(*spec.keys), list(spec.keys), "left_anti").select(*names)
        return t.withColumn("_class", F.lit("unchanged")).unionByName(new.withColumn("_class", F.lit("insert")))
    both = t.withColumn("_t", F.lit(True)).alias("t").join(s.withColumn("_s", F.lit(True)).alias("s"), functools.reduce(op.and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in spec.keys]), "full")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    values = [c for c in names if c not in spec.keys]
    kind = F.when(~in_t, "insert").when(~in_s, "target_only")
    pick = {c: F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in own else F.col(f"t.{c}") for c in values}
    if spec.strategy == "update_all":
        kind = kind.otherwise("update")
    elif spec.strategy == "update_changed":
        compare = [c for c in (spec.compare or values) if c in own]
        kind = kind.when(_changed(compare), "update").otherwise("unchanged")
        pick = {c: F.when(in_s & (~in_t | _changed(compare)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in own else F.col(f"t.{c}") for c in values}
    elif spec.strategy == "accumulating":
        if not spec.milestones:
            raise ConfigError("accumulating needs milestone_columns")
        pick |= {c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in spec.milestones}
        kind = kind.otherwise("update")
    elif spec.strategy == "soft_delete":
        flag = spec.deleted_column
        if flag not in own:
            raise ConfigError(f"soft_delete needs {flag!r} in the source")
        if spec.missing_in_source == "flag":
            pick[flag] = F.when(in_s, F.col(f"s.{flag}")).otherwise(F.lit(True))
            kind = F.when(~in_t, "insert").when(~in_s & ~F.coalesce(F.col(f"t.{flag}"), F.lit(False)), "delete").when(~in_s, "target_only")
        kind = kind.otherwise("update")
    else:
        raise ConfigError(f"merge strategy {spec.strategy!r}")
    keys = {k: F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")) for k in spec.keys}
    return both.select(*[(keys | pick)[c].alias(c) for c in names], kind.alias("_class"))


def _versioned(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """History stays; of a changed key the current version ends at as_of and a new one begins, in one go."""
    if spec.as_of is None:
        raise ConfigError("scd_type2 needs as_of")
    at = F.lit(spec.as_of).cast(target.schema[spec.start_column].dataType)
    scd = (spec.start_column, spec.end_column, spec.current_column)
    values = [c for c in target.columns if c not in spec.keys and c not in scd]
    compare = [c for c in (spec.compare or values) if c in source.columns]
    s = source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in (*spec.keys, *values)])
    history = target.filter(~F.coalesce(F.col(spec.current_column), F.lit(False))).withColumn("_class", F.lit("target_only"))
    current = target.filter(spec.current_column)
    both = current.withColumn("_t", F.lit(True)).alias("t").join(s.withColumn("_s", F.lit(True)).alias("s"), functools.reduce(op.and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in spec.keys]), "full")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    changed = in_t & in_s & _changed(compare)
    held = F.struct(*[F.col(f"t.{c}").alias(c) if c not in (spec.end_column, spec.current_column) else F.when(changed, at.cast(target.schema[c].dataType) if c == spec.end_column else F.lit(False)).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns], F.when(changed, "expire").when(in_s, "unchanged").otherwise("target_only").alias("_class"))
    begin = {spec.start_column: at, spec.end_column: F.lit(None).cast(target.schema[spec.end_column].dataType), spec.current_column: F.lit(True)}
    new = F.struct(*[(begin[c] if c in begin else F.col(f"s.{c}")).alias(c) for c in target.columns], F.lit("insert").alias("_class"))
    rows = both.select(F.explode(F.filter(F.array(F.when(in_t, held), F.when(in_s & (~in_t | changed), new)), lambda x: x.isNotNull())).alias("r")).select("r.*")
    return history.unionByName(rows)


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """The rows of target after the merge."""
    return classified(target, source, spec).drop("_class")


def class_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_class").agg(F.count("*").alias("n_rows"))


def untouched(target: DataFrame, source: DataFrame, by: list[str]) -> DataFrame:
    """target without the partitions that source has; by names the period and, before it, what groups periods."""
    replaced = source.select(*[F.col(c).alias(f"__p_{c}") for c in by]).distinct()
    same = functools.reduce(op.and_, [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in by])
    return target.join(replaced, same, "left_anti")


def replace_partitions(target: DataFrame, source: DataFrame, by: list[str]) -> DataFrame:
    """target without the partitions that source has, and source."""
    return untouched(target, source, by).unionByName(source, allowMissingColumns=True)
