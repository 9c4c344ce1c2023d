"""Named column transforms and stage steps that plans refer to.

A column transform is a function (df, column, options, context) -> df on the projected
column; a stage step is a function (df, options, context) -> df.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.errors import ConfigError
from tablewright.functions import checks, cleaning
from tablewright.operators import stages


@dataclass(frozen=True)
class Entry:
    name: str
    kind: str
    function: Callable
    description: str = ""
    tags: tuple[str, ...] = ()


_ENTRIES: dict[tuple[str, str], Entry] = {}


def _register(kind: str, name: str, description: str, tags: tuple[str, ...]) -> Callable:
    def put(function: Callable) -> Callable:
        _ENTRIES[kind, name] = Entry(name, kind, function, description or (function.__doc__ or "").strip(), tuple(tags))
        return function

    return put


def register_column(name: str, description: str = "", tags: tuple[str, ...] = ()) -> Callable:
    return _register("column", name, description, tags)


def register_stage(name: str, description: str = "", tags: tuple[str, ...] = ()) -> Callable:
    return _register("stage", name, description, tags)


def get_column(name: str) -> Callable | None:
    return (e := _ENTRIES.get(("column", name))) and e.function


def get_stage(name: str) -> Callable | None:
    return (e := _ENTRIES.get(("stage", name))) and e.function


def list_plugins(kind: str | None = None, tags: tuple[str, ...] = ()) -> list[Entry]:
    return [e for (k, _), e in sorted(_ENTRIES.items()) if (not kind or k == kind) and set(tags) <= set(e.tags)]


def clear_registry() -> None:
    _ENTRIES.clear()


@dataclass
class Context:
    """What the steps of one run share: the plan's keys, its clock and run, state for the writer, and sinks for rows set aside."""

    keys: list[str] = field(default_factory=list)
    table: str = ""
    run_id: str = ""
    load_id: str = ""
    as_of: object = None
    state: dict = field(default_factory=dict)
    rows: dict[str, list[DataFrame]] = field(default_factory=dict)  # by sink: what sink() is handed when the run writes
    sink: Callable[[str, DataFrame], None] | None = None
    metrics: object = None

    def put(self, name: str, df: DataFrame) -> None:
        self.rows.setdefault(name, []).append(df)

    def flush(self) -> None:
        """Hand the rows set aside to the sink."""
        for name, parts in self.rows.items():
            for df in parts:
                if self.sink:
                    self.sink(name, df)
        self.rows.clear()


def create_plugin_context(**values: object) -> Context:
    return Context(**values)  # type: ignore[arg-type]


def create_null_context() -> Context:
    return Context()


def _plain(name: str, function: Callable) -> None:
    register_column(name, function.__doc__ or "", ("cleaning",))(lambda df, c, options, ctx: df.withColumn(c, function(F.col(f"`{c}`"), **options)))


for _name in ("mask_email", "clean_decimal", "parse_mixed_date", "clean_uk_postcode", "clean_contact_name", "clean_company_name", "sanitize_name", "extract_period"):
    _plain(_name, getattr(cleaning, _name))


def _set_aside(ctx: Context, found: DataFrame, column: str, rule: str, action: str, options: dict) -> None:
    if options.get("log_table"):
        ctx.put(options["log_table"], checks.violations(found, ctx.keys, column, rule, options.get("sample_limit", 100)))
    if action == "reject":
        ctx.put("rejected", stages.rejected_records(found, ctx.keys or found.columns, f"{rule} on {column}", column, rule, ctx.table, ctx.run_id, ctx.load_id, ctx.as_of))


@register_column("not_null", "reject, keep or fill nulls", ("quality",))
@register_column("log_nulls_to_table", "not_null with a log of its rows", ("quality",))
def _not_null(df: DataFrame, column: str, options: dict, ctx: Context) -> DataFrame:
    action = options.get("on_null", "reject")
    out, found = checks.not_null(df, column, action, options.get("fill_value"))
    _set_aside(ctx, found, column, "not_null", action, options)
    return out


@register_column("in_set", "reject, keep or fill values outside a set", ("quality",))
@register_column("log_invalid_to_table", "in_set with a log of its rows", ("quality",))
def _in_set(df: DataFrame, column: str, options: dict, ctx: Context) -> DataFrame:
    action = options.get("on_violation", "reject")
    out, found = checks.in_set(df, column, options.get("allowed_values") or [], action, options.get("fill_value"))
    _set_aside(ctx, found, column, "in_set", action, options)
    return out


def _list(x: object) -> list:
    return [] if x is None else [p.strip() for p in x.split(",")] if isinstance(x, str) else list(x)  # type: ignore[call-overload]


@register_stage("dedupe_keep_last", tags=("dedupe",))
def _dedupe(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.dedupe_keep_last(df, _list(o.get("partition_by")) or ctx.keys, _list(o.get("order_by")), o.get("order_desc", True))


@register_stage("distinct", tags=("dedupe",))
def _distinct(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.distinct_rows(df, _list(o.get("columns")) or None)


@register_stage("check_duplicates", tags=("quality",))
def _duplicates(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    keys = _list(o.get("columns")) or ctx.keys
    ctx.put("duplicates", stages.duplicate_records(df, keys, ctx.table, ctx.run_id, ctx.load_id, ctx.as_of))
    return stages.check_duplicates(df, keys, o.get("action", "reject"))


@register_stage("period_replace", tags=("incremental",))
@register_stage("composite_period_replace", tags=("incremental",))
def _periods(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    ctx.state["replace_by"] = [*_list(o.get("partition_by")), o.get("period_column", "source_period")]
    return df


@register_stage("filter_latest_file_per_period", tags=("incremental",))
def _latest(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.latest_per_period(df, _list(o.get("partition_by", "platform")), o.get("period_column", "source_period"), o.get("order_by", "source_modified"))


@register_stage("ensure_sentinels", tags=("dimension",))
def _sentinels(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.ensure_sentinels(df, o.get("records") or [], o.get("key"))


@register_stage("check_unresolved_fks", tags=("quality",))
def _unresolved(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    ctx.put(o.get("summary_table") or "unresolved_fks", stages.unresolved_fks(df, o.get("checks") or []))
    ctx.put(o.get("records_table") or "unresolved_records", stages.unresolved_records(df, o["checks"], o.get("sample_limit", 100)))
    return df


@register_stage("self_join_previous_period", tags=("flow",))
def _flow(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.previous_period(df, _list(o.get("keys")) or ctx.keys, o["period_column"], o["amount_column"])


@register_stage("schedule_fk_reresolution", tags=("incremental",))
def _again(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    ctx.put("watermark_overrides", stages.override_dates(df, o.get("checks") or [], o["date_column"], ctx.as_of, o.get("lookback_days", 90)))
    return df


@register_stage("delta_load", tags=("incremental",))
@register_stage("incremental_dedupe", tags=("incremental",))
def _delta(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    return stages.delta_load(df, _list(o.get("keys")) or ctx.keys, o["order_by"], ctx.state.get("watermark"))


@register_stage("incremental_append", tags=("incremental",))
def _append(df: DataFrame, o: dict, ctx: Context) -> DataFrame:
    mark = ctx.state.get("watermark")
    return df if mark is None else df.filter(F.col(o["order_by"]) > F.lit(mark))


def column_transform(name: str) -> Callable:
    if not (f := get_column(name)):
        raise ConfigError(f"no column transform {name!r}; known are {[e.name for e in list_plugins('column')]}")
    return f


def stage_step(name: str) -> Callable:
    if not (f := get_stage(name)):
        raise ConfigError(f"no stage step {name!r}; known are {[e.name for e in list_plugins('stage')]}")
    return f
