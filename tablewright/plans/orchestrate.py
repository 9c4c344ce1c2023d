"""Which plans run now, in what order, and how their results are kept."""

from __future__ import annotations

import glob
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.errors import ConfigError
from tablewright.plans.config import Table, YamlConfigProvider


def _set(x: object) -> set[str]:
    return set() if x is None else {str(v).strip().lower() for v in (x.split(",") if isinstance(x, str) else x if isinstance(x, Iterable) else [x])}


def schedule_allows(batch: dict, schedule: str) -> bool:
    """Active, and of the schedule; 'all' asks for every active batch."""
    return bool(batch.get("active", True)) and (schedule == "all" or schedule.lower() in _set(batch.get("schedules")))


def time_allows(batch: dict, now: datetime) -> bool:
    """Weekday (mon or monday), day of month, month and hour in UTC, where the batch names any."""
    now = now.astimezone(UTC)
    days = {d[:3] for d in _set(batch.get("days_of_week"))}
    tests = (("days_of_month", now.day), ("months", now.month), ("hours_utc", now.hour))
    return (not days or now.strftime("%a").lower() in days) and all(batch.get(k) in (None, []) or str(v) in _set(batch[k]) for k, v in tests)


def config_paths(names: list[str], root: str = ".") -> list[Path]:
    """YAML files from folders, paths, patterns or bare names below root."""
    out: dict[Path, None] = {}
    for n in names:
        here = Path(root) / n
        found = sorted(here.rglob("*.yaml")) if here.is_dir() else [here] if here.is_file() else sorted(map(Path, glob.glob(str(here), recursive=True))) or sorted(Path(root).rglob(f"{n}.yaml"))
        if not found:
            raise ConfigError(f"no plan {n!r} below {root}")
        out |= dict.fromkeys(p for p in found if p.name != "defaults.yaml")
    return list(out)


def load_entries(paths: list[Path], provider: YamlConfigProvider) -> tuple[list[Table], dict[str, str]]:
    """Plans, and what is wrong with those that can't be read."""
    good, bad = [], {}
    for p in paths:
        try:
            good.append(provider.load(p))
        except Exception as e:
            bad[str(p)] = str(e)
    return good, bad


def by_batch(tables: list[Table]) -> dict[int, list[Table]]:
    """Active plans by batch, in their order within it."""
    out: dict[int, list[Table]] = {}
    for t in tables:
        o = t.policies.orchestration
        if o.get("active", True):
            out.setdefault(int(o.get("batch", 1)), []).append(t)
    return {k: sorted(v, key=lambda t: (t.policies.orchestration.get("order", 0), t.name)) for k, v in sorted(out.items())}


@dataclass
class Outcome:
    name: str
    status: str
    error: str | None = None
    started_at: datetime | None = None
    finished_at: datetime | None = None


def run_jobs(jobs: dict[str, Callable[[], object]], after: dict[str, list[str]] | None = None, workers: int = 3, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> list[Outcome]:
    """Jobs in waves, each once those it comes after have succeeded; jobs after a failed or skipped one are skipped."""
    after, done = after or {}, {}

    def one(name: str) -> Outcome:
        began = now()
        try:
            jobs[name]()
            return Outcome(name, "SUCCESS", None, began, now())
        except Exception as e:
            return Outcome(name, "FAILED", str(e), began, now())

    with ThreadPoolExecutor(workers) as pool:
        while len(done) < len(jobs):
            for n in jobs:
                if n not in done and any(done[a].status != "SUCCESS" for a in after.get(n, []) if a in done):
                    done[n] = Outcome(n, "SKIPPED")
            ready = [n for n in jobs if n not in done and all(a in done or a not in jobs for a in after.get(n, []))]
            if not ready and len(done) < len(jobs):
                if any(n not in done for n in jobs) and not any(a in done for n in jobs if n not in done for a in after.get(n, [])):
                    raise ConfigError(f"jobs wait for each other: {sorted(set(jobs) - set(done))}")
                continue
            done |= {o.name: o for o in pool.map(one, ready)}
    return [done[n] for n in jobs]


def run_batches(tables: list[Table], run: Callable[[Table], object], exists: Callable[[str], bool], workers: int = 7) -> list[Outcome]:
    """Batches one after another; batch 0 only builds tables that are missing. All run; the caller looks for failures."""
    out = []
    for batch, items in by_batch(tables).items():
        todo = [t for t in items if batch or not exists(t.target)]
        out += run_jobs({t.name: (lambda t=t: run(t)) for t in todo}, workers=workers)
    return out


def run_log(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    return spark.createDataFrame([(o.name, o.status, o.error, o.started_at, o.finished_at) for o in outcomes], "name string, status string, error string, started_at timestamp, finished_at timestamp")


@dataclass(frozen=True)
class SchemaDiff:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    type_changes: dict[str, tuple[str, str]] = field(default_factory=dict)
    nullability_changes: dict[str, tuple[bool, bool]] = field(default_factory=dict)


def diff_table_schema(config: Table, held: T.StructType) -> SchemaDiff:
    """What the plan's columns would change in a table; types are compared as types."""
    plan = {c.name: c for c in config.columns if not c.temporary}
    old = {f.name: f for f in held.fields}
    both = [n for n in plan if n in old]
    types = {n: (old[n].dataType.simpleString(), plan[n].data_type.spark_type().simpleString()) for n in both if plan[n].data_type and plan[n].data_type.spark_type() != old[n].dataType}
    nulls = {n: (old[n].nullable, plan[n].nullable) for n in both if old[n].nullable != plan[n].nullable}
    return SchemaDiff([n for n in plan if n not in old], [n for n in old if n not in plan], types, nulls)


def ensure_schemas(spark: SparkSession, names: list[str]) -> None:
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{n}`")


def drop_schema(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS `{name}`" + (" CASCADE" if cascade else ""))


def drop_tables(spark: SparkSession, schema: str, prefix: str, dry_run: bool = True) -> list[str]:
    """Names of tables that begin with prefix; dropped unless dry_run."""
    names = [t.name for t in spark.catalog.listTables(schema) if t.name.startswith(prefix)]
    if not dry_run:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{n}`")
    return names


# --- governance -------------------------------------------------------------------


def manifest(spark: SparkSession, tables: list[Table]) -> DataFrame:
    """A row for each column of each plan, with what its extensions say of it."""
    rows = [(t.target, t.layer, c.name, c.data_type.to_spark_sql() if c.data_type else None, c.nullable, c.natural, c.extensions.get("classification"), c.extensions.get("glossary"), c.extensions.get("sensitivity")) for t in tables for c in t.columns]
    return spark.createDataFrame(rows, "table_name string, layer string, column_name string, data_type string, nullable boolean, natural_key boolean, classification string, glossary string, sensitivity string")


def lineage(spark: SparkSession, tables: list[Table]) -> DataFrame:
    """Edges from sources to tables."""
    return spark.createDataFrame([(s.table or s.path or "generated", t.target) for t in tables for s in t.sources], "source string, target string").distinct()


def glossary(catalogue: DataFrame) -> DataFrame:
    """Terms with the columns that use them and their classifications."""
    from pyspark.sql import functions as F

    return catalogue.filter("glossary is not null").groupBy("glossary").agg(F.array_sort(F.collect_set(F.concat_ws(".", "table_name", "column_name"))).alias("columns"), F.array_sort(F.collect_set("classification")).alias("classifications"))
