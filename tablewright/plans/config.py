"""Table plans as frozen objects, read from dictionaries or YAML with defaults, templates and macros."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tablewright.errors import ConfigError
from tablewright.functions.types import TypeSpec, parse_type

JOIN_TYPES = {"inner": "inner", "left": "left", "right": "right", "full": "full", "cross": "cross"}
OPERATORS = {"=", "!=", "<", "<=", ">", ">="}
LOAD_MODES = {"append", "overwrite", "merge", "replace_by_partition"}
STRATEGIES = {"update_all", "update_changed", "insert_only", "scd_type2", "accumulating", "soft_delete"}


@dataclass(frozen=True)
class Source:
    name: str
    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: dict = field(default_factory=dict)
    generated: dict | None = None
    alias: str | None = None
    broadcast: bool = False
    columns: tuple[str, ...] = ()
    incremental: bool = True


@dataclass(frozen=True)
class Column:
    name: str
    data_type: TypeSpec | None = None
    default: Any = None
    nullable: bool = True
    natural: bool = False
    temporary: bool = False
    inputs: tuple[dict, ...] = ()
    delimiter: str = "||"
    extensions: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Condition:
    left: str
    right: str
    operator: str = "="


@dataclass(frozen=True)
class Join:
    source: str
    name: str
    type: str = "left"
    alias: str | None = None
    conditions: tuple[Condition, ...] = ()
    broadcast: bool = False
    dedupe_by: tuple[str, ...] = ()
    dedupe_order_by: str | None = None
    dedupe_desc: bool = True


@dataclass(frozen=True)
class Union:
    sources: tuple[dict, ...]
    mode: str = "by_name"
    distinct: bool = False
    allow_missing_columns: bool = False


@dataclass(frozen=True)
class GroupBy:
    keys: tuple[str, ...]
    aggregations: tuple[dict, ...] = ()
    having: tuple[str, ...] = ()


@dataclass(frozen=True)
class Stage:
    name: str
    columns: tuple[Column, ...] = ()
    joins: tuple[Join, ...] = ()
    union: Union | None = None
    source_filters: dict = field(default_factory=dict)
    filters: tuple[str, ...] = ()
    group_by: GroupBy | None = None
    extensions: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Incremental:
    filter_mode: str = "none"
    watermark_column: str | None = None
    source_watermark_column: str | None = None
    period_column: str | None = None
    source_period_column: str | None = None


@dataclass(frozen=True)
class Policies:
    load_mode: str = "append"
    merge_strategy: str = "update_all"
    partition_scheme: tuple[str, ...] = ()
    hash_columns: tuple[str, ...] = ()
    milestone_columns: tuple[str, ...] = ()
    scd: dict = field(default_factory=dict)
    soft_delete: dict = field(default_factory=dict)
    orchestration: dict = field(default_factory=dict)
    creation: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    name: str
    layer: str = ""
    target_schema: str | None = None
    description: str = ""
    sources: tuple[Source, ...] = ()
    stages: tuple[Stage, ...] = ()
    policies: Policies = Policies()
    incremental: Incremental = Incremental()
    dq: dict = field(default_factory=dict)
    tags: tuple[str, ...] = ()
    extensions: dict = field(default_factory=dict)

    @property
    def columns(self) -> tuple[Column, ...]:
        """The columns of the last stage that declares any."""
        return next((s.columns for s in reversed(self.stages) if s.columns), ())

    @property
    def natural_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.natural]

    @property
    def temporary_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.temporary]

    def filter_columns(self, **wanted: Any) -> list[Column]:
        """Columns whose fields or extensions have all the wanted values."""
        return [c for c in self.columns if all((getattr(c, k) if hasattr(c, k) else c.extensions.get(k)) == v for k, v in wanted.items())]

    @property
    def persistent_columns(self) -> list[str]:
        return [c.name for c in self.columns if not c.temporary]

    @property
    def target(self) -> str:
        """schema.name, the schema being the layer where none is given."""
        schema = self.target_schema or self.layer
        return f"{schema}.{self.name}" if schema else self.name


@dataclass(frozen=True)
class Environment:
    """Named sources by layer, with the paths and formats of one installation."""

    name: str
    layers: dict[str, dict[str, dict]] = field(default_factory=dict)

    def source(self, layer: str, name: str) -> Source:
        if name not in self.layers.get(layer, {}):
            raise ConfigError(f"environment {self.name!r} has no {name!r} in layer {layer!r}")
        return source({"name": name} | self.layers[layer][name])


def environment(d: dict) -> Environment:
    layers = {layer: {s["name"]: {k: v for k, v in s.items() if k != "name"} for s in sources} if isinstance(sources, list) else dict(sources) for layer, sources in (d.get("layers") or {}).items()}
    return Environment(_need(d, "name", "an environment"), layers)


def _texts(x: Any) -> tuple[str, ...]:
    """One text, comma-separated texts or a list, as a tuple."""
    if x is None:
        return ()
    return tuple(p.strip() for p in x.split(",") if p.strip()) if isinstance(x, str) else tuple(x)


def _need(d: dict, key: str, what: str) -> Any:
    if d.get(key) in (None, ""):
        raise ConfigError(f"{what} needs {key!r}: {d}")
    return d[key]


def column(d: dict) -> Column:
    inputs = d.get("inputs") or []
    if isinstance(inputs, dict | str):
        inputs = [inputs]
    inputs = [{"expression": x} if isinstance(x, str) else x for x in inputs]
    for x in inputs:
        if ("expression" in x) == ("column" in x):
            raise ConfigError(f"column {d.get('name')!r}: an input has either an expression or a column: {x}")
    kind = d.get("data_type") or d.get("type")
    extensions = dict(d.get("extensions") or {})
    return Column(_need(d, "name", "a column"), parse_type(kind) if kind else None, d.get("default"), d.get("nullable", True), bool(d.get("natural", False)), bool(d.get("temporary", False)), tuple(inputs), d.get("delimiter") or "||", extensions)


def source(d: dict) -> Source:
    s = Source(
        _need(d, "name", "a source"), _table_name(d), d.get("path"), d.get("format", "parquet"), dict((d.get("options") or {}).get("options") or d.get("options") or {}), d.get("generated") if isinstance(d.get("generated"), dict) else {} if d.get("generated") else None,
        d.get("alias"), bool(d.get("broadcast", False)), _texts(d.get("columns")), d.get("incremental", True) is not False,
    )
    if sum(x is not None for x in (s.table, s.path, s.generated)) != 1:
        raise ConfigError(f"source {s.name!r} needs exactly one of table, path and generated")
    return s


def _table_name(d: dict) -> str | None:
    return ".".join(d[k] for k in ("catalog", "schema", "table") if d.get(k)) if d.get("table") else None


def join(d: dict) -> Join:
    kind = str(d.get("type", "left")).lower()
    if kind not in JOIN_TYPES:
        raise ConfigError(f"join type {kind!r}; known are {sorted(JOIN_TYPES)}")
    conditions = []
    for c in d.get("conditions") or []:
        left = c.get("left") or ".".join(c[k] for k in ("left_source", "left_column") if c.get(k))
        operator = c.get("operator", "=")
        if operator not in OPERATORS:
            raise ConfigError(f"join operator {operator!r}; known are {sorted(OPERATORS)}")
        if not left:
            raise ConfigError(f"join condition needs a left side: {c}")
        conditions.append(Condition(left, _need(c, "right", "a join condition"), operator))
    by = _texts(d.get("dedupe_by"))
    if by and not d.get("dedupe_order_by"):
        raise ConfigError(f"join of {d.get('source')!r}: dedupe_by needs dedupe_order_by")
    of = _need(d, "source", "a join")
    return Join(of, d.get("name") or of, kind, d.get("alias"), tuple(conditions), bool(d.get("broadcast", False)), by, d.get("dedupe_order_by"), bool(d.get("dedupe_desc", True)))


def _union(d: Any) -> Union:
    d = {"sources": d} if isinstance(d, list) else d
    sources = tuple({"source": s} if isinstance(s, str) else s for s in d.get("sources") or [])
    if len(sources) < 2:
        raise ConfigError("a union needs two sources or more")
    if d.get("mode", "by_name") not in ("by_name", "by_position"):
        raise ConfigError(f"union mode {d['mode']!r}")
    return Union(sources, d.get("mode", "by_name"), bool(d.get("distinct", False)), bool(d.get("allow_missing_columns", False)))


def _group_by(d: dict) -> GroupBy:
    keys = _texts(d.get("keys") or d.get("columns"))
    if not keys:
        raise ConfigError("group_by needs a key or more")
    return GroupBy(keys, tuple(d.get("aggregations") or ()), _filters(d.get("having")))


def _filters(x: Any) -> tuple[str, ...]:
    return () if x is None else (x,) if isinstance(x, str) else tuple(x)


def stage(d: dict) -> Stage:
    union = d.get("union") or d.get("unions")
    return Stage(
        _need(d, "name", "a stage"), tuple(column(c) for c in d.get("columns") or []), tuple(join(j) for j in d.get("joins") or []), _union(union) if union else None, {k: _filters(v) for k, v in (d.get("source_filters") or {}).items()},
        _filters(d.get("filters")), _group_by(d["group_by"]) if d.get("group_by") else None, dict(d.get("extensions") or {}),
    )


def table(d: dict) -> Table:
    """A plan from its dictionary. Columns at the top level belong to the first stage with joins, or to one of their own; natural_key marks columns."""
    d = dict(d)
    stages = [dict(s) for s in d.get("stages") or []]
    if d.get("columns"):
        home = next((s for s in stages if s.get("joins") or s.get("union")), None)
        if home is None:
            stages.insert(0, home := {"name": "columns"})
        home.setdefault("columns", d["columns"])
    keys = set(_texts(d.get("natural_key")))
    for s in stages:
        s["columns"] = [c | {"natural": True} if c.get("name") in keys else c for c in s.get("columns") or []]
    p = dict(d.get("policies") or {})
    o = {**(d.get("optimisation") or {}), **(p.get("optimisation") or {}), **{k: v for k, v in p.items() if k in ("load_mode", "merge_strategy", "partition_scheme", "hash_columns", "milestone_columns", "scd", "soft_delete")}}
    mode, strategy = o.get("load_mode", "append"), o.get("merge_strategy", "update_all")
    if mode not in LOAD_MODES or strategy not in STRATEGIES:
        raise ConfigError(f"load_mode {mode!r} of {sorted(LOAD_MODES)}, merge_strategy {strategy!r} of {sorted(STRATEGIES)}")
    policies = Policies(mode, strategy, _texts(o.get("partition_scheme")), _texts(o.get("hash_columns")), _texts(o.get("milestone_columns")), dict(o.get("scd") or {}), dict(o.get("soft_delete") or {}), dict(p.get("orchestration") or {}), dict(p.get("creation") or {}))
    i = d.get("incremental") or {}
    incremental = Incremental(i.get("filter_mode", "none"), i.get("watermark_column"), i.get("source_watermark_column") or i.get("watermark_column"), i.get("period_column"), i.get("source_period_column") or i.get("period_column"))
    if incremental.filter_mode not in ("none", "watermark", "period"):
        raise ConfigError(f"filter_mode {incremental.filter_mode!r}")
    dq = d.get("dq") or {}
    checked = any((s.get("extensions") or {}).get("stage_plugin") == "check_duplicates" for s in stages)
    if bool(dq.get("duplicates_table")) != checked and not (dq.get("duplicates_table") and d.get("shared_dq")):
        warnings.warn(f"table {d.get('name')!r}: " + ("no stage looks for duplicates, so dq.duplicates_table stays empty" if dq.get("duplicates_table") else "check_duplicates without dq.duplicates_table keeps its rows in the context only"), stacklevel=2)
    return Table(_need(d, "name", "a table"), d.get("layer", ""), d.get("target_schema"), d.get("description", ""), tuple(source(s) for s in d.get("sources") or []), tuple(stage(s) for s in stages), policies, incremental, dict(d.get("dq") or {}), _texts(d.get("tags")), dict(d.get("extensions") or {}))


# --- defaults, templates, macros ----------------------------------------------


def merged(base: Any, over: Any) -> Any:
    """over upon base, dictionaries key by key."""
    if isinstance(base, dict) and isinstance(over, dict):
        return base | {k: merged(base[k], v) if k in base else v for k, v in over.items()}
    return over


_MACRO = re.compile(r"\$\{([^{}]+)\}")


def expanded(x: Any, scope: dict) -> Any:
    """x with ${a.b} replaced from scope; a text that is one macro takes the value's own type."""
    if isinstance(x, dict):
        return {k: expanded(v, scope) for k, v in x.items()}
    if isinstance(x, list):
        return [expanded(v, scope) for v in x]
    if not isinstance(x, str):
        return x

    def value(path: str) -> Any:
        at: Any = scope
        for key in path.strip().split("."):
            if not isinstance(at, dict) or key not in at:
                raise ConfigError(f"macro ${{{path}}}: no {key!r}; there are {sorted(at) if isinstance(at, dict) else at!r}")
            at = at[key]
        return expanded(at, scope)

    whole = _MACRO.fullmatch(x.strip())
    return value(whole[1]) if whole else _MACRO.sub(lambda m: str(value(m[1])), x)


def with_templates(d: dict, templates: dict[str, dict | None] | list[dict]) -> dict:
    """d with each column that names a template (by its own name or by template:) filled up from it. Templates are a mapping by name or a list with names."""
    by_name = {n: t or {} for n, t in templates.items()} if isinstance(templates, dict) else {t["name"]: t for t in templates}

    def filled(c: dict) -> dict:
        base = by_name.get(c.get("template") or c.get("name"))
        return {k: v for k, v in (merged(base, c) if base else c).items() if k != "template"}

    columns = lambda x: x | {"columns": [filled(c) for c in x["columns"]]} if x.get("columns") else x
    return columns(d) | ({"stages": [columns(s) for s in d["stages"]]} if d.get("stages") else {})


class YamlConfigProvider:
    """Reads tables from YAML files or dictionaries, upon defaults (a path, or defaults.yaml beside the file)."""

    def __init__(self, defaults_path: str | None = None, auto_discover_defaults: bool = True):
        self.defaults_path, self.auto = defaults_path, auto_discover_defaults

    @staticmethod
    def read(path: str | Path) -> dict:
        import yaml  # an optional dependency: only files need it

        out = yaml.safe_load(Path(path).read_text()) or {}
        if not isinstance(out, dict):
            raise ConfigError(f"{path}: not a mapping")
        return out

    def load(self, path: str | Path) -> Table:
        beside = Path(path).parent / "defaults.yaml"
        defaults = self.defaults_path or (beside if self.auto and beside.exists() else None)
        return self.load_dict(self.read(path), self.read(defaults) if defaults else {})

    def load_dict(self, d: dict, defaults: dict | None = None) -> Table:
        return table(resolved(d, defaults or {}))


def resolved(d: dict, defaults: dict) -> dict:
    """d upon defaults (under a key 'defaults' or bare), with templates and macros applied."""
    inner = defaults.get("defaults", defaults)
    templates = defaults.get("common_columns") or inner.get("common_columns") or []
    base = {k: v for k, v in inner.items() if k in ("policies", "optimisation", "dq", "incremental", "tags", "layer", "target_schema")}
    out = merged(base, d)
    if inner.get("dq") and not (d.get("dq") or {}).get("duplicates_table"):
        out["shared_dq"] = True  # a layer's table is there for all plans, whether one looks for duplicates or not
    return expanded(with_templates(out, templates), merged(out, {"defaults": inner}))
