"""Compiling a plan: stages of sources, joins, columns, filters, groups and steps become one DataFrame.

Order within a stage: source filters; the base (union, previous stage or first source);
joins; columns and their transforms; filters; grouping; the stage's step. Nothing here
runs a Spark job except reading a high-water mark.
"""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import ConfigError, PlanBuilderError
from tablewright.operators import incremental, relational
from tablewright.plans import registry
from tablewright.plans.config import Column, Stage, Table
from tablewright.sources import readers

#: In a union, the stage before.
PREVIOUS = "_previous"


class PlanBuilder:
    """Builds a table's rows from its plan."""

    def __init__(self, config: Table):
        self.config = config

    def load_sources(self, spark: SparkSession) -> dict[str, DataFrame]:
        return readers.load_sources(spark, self.config.sources)

    def context(self, **values: object) -> registry.Context:
        return registry.Context(keys=self.config.natural_keys, table=self.config.target, **values)

    def build(self, spark: SparkSession, context: registry.Context | None = None, sources: dict[str, DataFrame] | None = None, target: DataFrame | None = None, watermark_override: str | None = None, table_override=None) -> DataFrame:
        """The rows of the last stage. sources may be given instead of read; target bounds an incremental load."""
        if not self.config.stages:
            raise ConfigError(f"{self.config.name!r} has no stages and no columns")
        context = context or self.context()
        given = sources if sources is not None else self.load_sources(spark)
        given = self.bounded(given, target, context, watermark_override, table_override)
        return functools.reduce(lambda df, stage: self.build_stage(spark, stage, given, df, context), self.config.stages, None)

    def bounded(self, sources: dict[str, DataFrame], target: DataFrame | None, context: registry.Context, override: str | None, table_override) -> dict[str, DataFrame]:
        """Sources after the incremental filter."""
        inc = self.config.incremental
        if inc.filter_mode == "none":
            return sources
        by_period = inc.filter_mode == "period"
        mark = incremental.high_mark(target, (inc.period_column if by_period else inc.watermark_column) or "")
        mark = incremental.chosen_mark(mark, override, table_override)
        context.state["watermark"] = mark
        fixed = {n for s in self.config.sources if not s.incremental for n in (s.name, s.alias)}

        def filtered(df: DataFrame) -> DataFrame:
            if by_period:
                return incremental.periods_from(df, inc.source_period_column or "", mark)
            if self.config.policies.load_mode == "replace_by_partition" and inc.source_period_column in df.columns and inc.source_watermark_column in df.columns:
                return incremental.touched_periods(df, inc.source_watermark_column, mark, inc.source_period_column)
            return incremental.later_than(df, inc.source_watermark_column or "", mark)

        return {n: df if n in fixed else filtered(df) for n, df in sources.items()}

    def build_stage(self, spark: SparkSession, stage: Stage, sources: dict[str, DataFrame], input_df: DataFrame | None = None, context: registry.Context | None = None) -> DataFrame:
        context = context or self.context()
        sources = dict(sources)
        for name, tests in stage.source_filters.items():
            if name not in sources:
                raise PlanBuilderError(stage.name, None, f"filter on unknown source {name!r}")
            sources[name] = functools.reduce(DataFrame.filter, tests, sources[name])
        df, base = self._base(stage, sources, input_df)
        qualifiers = [base] if base else []
        if base:
            df = df.alias(base)
        for j in stage.joins:
            if j.source not in sources:
                raise PlanBuilderError(stage.name, None, f"join with unknown source {j.source!r}")
            hint = any(s.broadcast for s in self.config.sources if j.source in (s.name, s.alias))
            try:
                early = self._early(stage, j, df)
                df = relational.joined(early, sources[j.source], j, hint)
            except ConfigError as e:
                raise PlanBuilderError(stage.name, None, str(e)) from e
            qualifiers.append(j.alias or j.name)
        if stage.columns:
            df = self._projected(stage, df, qualifiers, context)
        df = functools.reduce(DataFrame.filter, stage.filters, df)
        if stage.group_by:
            df = relational.grouped(df, stage.group_by)
        if step := stage.extensions.get("stage_plugin"):
            df = self._stepped(stage, step, df, context)
        return df

    def _early(self, stage: Stage, join, df: DataFrame) -> DataFrame:
        """df with those of the stage's columns that a condition names and that no source has."""
        wanted = {c.left.rpartition(".")[2] for c in join.conditions} - set(df.columns)
        for spec in stage.columns:
            if spec.name in wanted and len(spec.inputs) == 1 and "column" in spec.inputs[0] and spec.inputs[0]["column"] in df.columns:
                df = df.withColumn(spec.name, F.col(f"`{spec.inputs[0]['column']}`"))
        return df

    def _base(self, stage: Stage, sources: dict[str, DataFrame], before: DataFrame | None) -> tuple[DataFrame, str | None]:
        if stage.union:
            known = sources | ({PREVIOUS: before} if before is not None else {})
            parts = []
            for u in stage.union.sources:
                if u["source"] not in known:
                    raise PlanBuilderError(stage.name, None, f"union of unknown source {u['source']!r}")
                df = known[u["source"]]
                parts.append(relational.mapped(df, u["column_map"]) if u.get("column_map") else df)
            return relational.united(parts, stage.union), None
        if before is not None:
            return before, None
        if not self.config.sources and not sources:
            raise PlanBuilderError(stage.name, None, "no source, union or stage before")
        name = self.config.sources[0].name if self.config.sources else next(iter(sources))
        return sources[name], name

    def _projected(self, stage: Stage, df: DataFrame, qualifiers: list[str], context: registry.Context) -> DataFrame:
        scope = Scope(df, qualifiers)
        raw, after = [], []
        for spec in stage.columns:
            value = relational.expression(scope.bare(spec), own=stage.union is not None)
            transform = spec.extensions.get("transform")
            # a transform gets the raw value; the declared type comes after it
            raw.append((value if transform else relational.cast(value, spec)).alias(spec.name))
            if transform:
                after.append((spec, transform))
        try:
            df = df.select(*raw)
            for spec, transform in after:
                name, options = (transform, {}) if isinstance(transform, str) else (transform["name"], {k: v for k, v in transform.items() if k != "name"})
                options = options | {k: v for k, v in spec.extensions.items() if k not in ("transform", "description", "classification", "glossary", "sensitivity")}
                began = time.monotonic()
                df = registry.column_transform(name)(df, spec.name, options, context)
                self._timed(context, name, "column", began)
                df = df.withColumn(spec.name, relational.cast(F.col(f"`{spec.name}`"), spec))
        except ConfigError as e:
            raise PlanBuilderError(stage.name, None, str(e)) from e
        return df

    def _stepped(self, stage: Stage, step: str, df: DataFrame, context: registry.Context) -> DataFrame:
        options = {k: v for k, v in stage.extensions.items() if k not in ("stage_plugin", "on_error")}
        began = time.monotonic()
        try:
            out = registry.stage_step(step)(df, options, context)
            self._timed(context, step, "stage", began)
            return out
        except ConfigError as e:
            if stage.extensions.get("on_error") == "passthrough":
                return df
            raise PlanBuilderError(stage.name, None, str(e)) from e

    @staticmethod
    def _timed(context: registry.Context, name: str, kind: str, began: float) -> None:
        if context.metrics is not None:
            context.metrics.plugin(name, kind, time.monotonic() - began)

    def to_sql(self, stage: Stage) -> str:
        return stage_sql(self.config, stage)

    def explain(self) -> str:
        return explained(self.config)


class Scope:
    """Resolves alias.column in the text of expressions to the joined columns' own names."""

    def __init__(self, df: DataFrame, qualifiers: list[str]):
        self.columns, self.qualifiers = set(df.columns), set(qualifiers)

    def text(self, sql: str) -> str:
        """Outside quotes: alias.c becomes alias__c where such a column exists, else c."""
        import re

        def name(m: re.Match) -> str:
            if m[1]:  # a quoted text
                return m[0]
            alias, c = m[2], m[3]
            if alias not in self.qualifiers:
                return m[0]
            return f"`{alias}__{c}`" if f"{alias}__{c}" in self.columns else f"`{c}`" if c in self.columns else m[0]

        return re.sub(r"('(?:[^'\\]|\\.)*')|\b([A-Za-z_]\w*)\.([A-Za-z_]\w*)\b", name, sql)

    def bare(self, spec: Column) -> Column:
        from dataclasses import replace

        inputs = tuple({"expression": self.text(i["expression"])} if "expression" in i else {"expression": self.text(f"{i['source']}.{i['column']}") if i.get("source") else f"`{i['column']}`"} for i in spec.inputs)
        return replace(spec, inputs=inputs)


def column_sql(spec: Column) -> str:
    parts = [i.get("expression") or ".".join(i[k] for k in ("source", "column") if i.get(k)) for i in spec.inputs]
    out = parts[0] if len(parts) == 1 else f"concat_ws('{spec.delimiter}', {', '.join(parts)})" if parts else ("NULL" if spec.default is None else repr(spec.default))
    if parts and spec.default is not None:
        out = f"coalesce({out}, {spec.default!r})"
    if spec.data_type:
        out = f"try_cast({out} AS {spec.data_type.to_spark_sql()})"
    return f"{out} AS {spec.name}"


def stage_sql(config: Table, stage: Stage) -> str:
    """The stage as a SELECT that Spark SQL can run over views named as the sources (steps and transforms are named in comments)."""
    select = ",\n       ".join(column_sql(c) for c in stage.columns) or "*"
    at = config.stages.index(stage) if stage in config.stages else 0
    if stage.union:
        word = " UNION " if stage.union.distinct else " UNION ALL "
        base = "(" + word.join(f"SELECT * FROM {u['source']}" for u in stage.union.sources) + ")"
    else:
        base = config.stages[at - 1].name if at else config.sources[0].name if config.sources else "(SELECT 1)"
    joins = "".join(f"\n{j.type.upper()} JOIN {j.source} AS {j.alias or j.name}" + (" ON " + " AND ".join(f"{c.left} {c.operator} {j.alias or j.name}.{c.right.rpartition('.')[2]}" for c in j.conditions) if j.conditions else "") for j in stage.joins)
    sql = f"SELECT {select}\nFROM {base}{joins}"
    if stage.filters:  # filters see the output's names
        sql = f"SELECT * FROM (\n{sql}\n)\nWHERE " + " AND ".join(f"({f})" for f in stage.filters)
    if g := stage.group_by:
        sums = [f"{a['function']}({'DISTINCT ' if a.get('distinct') else ''}{a.get('expression') or a.get('column') or '*'}) AS {a.get('alias') or a['function'] + '_' + str(a.get('column') or 'all').replace('.', '_')}" for a in g.aggregations]
        sql = f"SELECT {', '.join([*g.keys, *sums])}\nFROM (\n{sql}\n)\nGROUP BY {', '.join(g.keys)}"
        if g.having:
            sql += "\nHAVING " + " AND ".join(f"({h})" for h in g.having)
    step = stage.extensions.get("stage_plugin")
    return sql + (f"\n-- then {step}" if step else "")


def generate_sql(config: Table) -> str:
    """All stages, each as a common table expression of the next."""
    *first, last = config.stages
    body = ",\n".join(f"{s.name} AS (\n{stage_sql(config, s)}\n)" for s in first)
    return (f"WITH {body}\n" if first else "") + stage_sql(config, last)


def explained(config: Table) -> str:
    """The plan in words."""
    lines = [f"table {config.target} ({config.policies.load_mode}" + (f", {config.policies.merge_strategy}" if config.policies.load_mode == "merge" else "") + ")", f"  keys: {', '.join(config.natural_keys) or 'none'}"]
    lines += [f"  source {s.name}: {s.table or s.path or 'generated'}" + (" broadcast" if s.broadcast else "") for s in config.sources]
    for s in config.stages:
        lines.append(f"  stage {s.name}")
        lines += [f"    {j.type} join {j.alias or j.name}: " + (", ".join(f"{c.left} {c.operator} {c.right}" for c in j.conditions) or "all rows") for j in s.joins]
        for c in s.columns:
            marks = [m for m, on in (("key", c.natural), ("not null", not c.nullable), ("temporary", c.temporary)) if on]
            lines.append(f"    column {c.name}" + (f" {c.data_type.to_spark_sql()}" if c.data_type else "") + (f" ({', '.join(marks)})" if marks else ""))
        lines += [f"    filter {f}" for f in s.filters]
        if s.group_by:
            lines.append(f"    group by {', '.join(s.group_by.keys)}")
        if step := s.extensions.get("stage_plugin"):
            lines.append(f"    step {step}")
    return "\n".join(lines)


def compiled(spark: SparkSession, plan: dict, sources: dict[str, DataFrame] | None = None, **how: object) -> DataFrame:
    """The rows of a plan given as a dictionary."""
    from tablewright.plans.config import table

    return PlanBuilder(table(plan)).build(spark, sources=sources, **how)  # type: ignore[arg-type]
