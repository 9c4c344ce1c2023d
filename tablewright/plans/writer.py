"""Writing: a store of table snapshots, the load modes upon it, and exact counts of what a write did.

A snapshot is a list of folders of Parquet files with one schema, held in a numbered
version file. A write makes new folders and then commits the next version by a rename that
fails where that number exists: readers see a whole version or the one before, a crash
loses nothing, and of two writers one finds out. Appending and overwriting try again on
top of the other's version; what was computed from a version that is no longer the last is
refused. Reads use the schema of the version, so that partition columns, which are names
of folders, come back in their own types. Each source is evaluated once a write.
A store over a transactional table format can take its place: anything with exists, read,
replace, append and staged.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.errors import WriterError
from tablewright.operators import merge
from tablewright.plans import registry
from tablewright.plans.config import Table

#: How often a write that found another one's version tries again.
TRIES = 20
#: Name of the partition that folders of rows are.
_FOLDER = "__part"


@dataclass(frozen=True)
class Part:
    """One folder of a version: its partition columns and number of rows."""

    folder: str
    partition_by: tuple[str, ...]
    rows: int


@dataclass(frozen=True)
class Version:
    number: int = 0
    schema: T.StructType = field(default_factory=T.StructType)
    parts: tuple[Part, ...] = ()

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)


class SnapshotStore:
    """Tables below a root that Spark's file systems can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, table: str, name: str = ""):
        return self._hadoop.Path(f"{self.root}/{table}" + (f"/{name}" if name else ""))

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, table: str) -> list[int]:
        fs, folder = self._fs(), self._path(table, "_versions")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, table: str, number: int | None = None) -> Version:
        """A version by number, by default the last; number 0 is that of a table that isn't there."""
        numbers = self._numbers(table)
        if not numbers:
            return Version()
        number = numbers[-1] if number is None else number
        text = "\n".join(r.value for r in self.spark.read.text(str(self._path(table, f"_versions/{number:012d}.json").toString())).collect())
        d = json.loads(text)
        return Version(number, T.StructType.fromJson(d["schema"]), tuple(Part(x["folder"], tuple(x["partition_by"]), x["rows"]) for x in d["parts"]))

    def exists(self, table: str) -> bool:
        return bool(self._numbers(table))

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        v = version or self.version(table)
        if not v.number:
            raise WriterError(table, "read", "no such table")
        by_scheme: dict[tuple[str, ...], list[str]] = {}
        for p in v.parts:
            by_scheme.setdefault(p.partition_by, []).append(f"{self.root}/{table}/{p.folder}")
        # folders of one layout are one scan, in which the folder is a partition too; partition values are read in the schema's types
        reader = self.spark.read.schema(T.StructType([*v.schema.fields, T.StructField(_FOLDER, T.StringType())])).option("basePath", f"{self.root}/{table}")
        frames = [reader.parquet(*paths).select(*[f"`{n}`" for n in v.schema.names]) for paths in by_scheme.values()]
        return functools.reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], v.schema)

    def commit(self, table: str, base: Version, schema: T.StructType, parts: tuple[Part, ...]) -> bool:
        """Make the version after base; False if there is one already."""
        fs, number = self._fs(), base.number + 1
        draft, final = self._path(table, f"_versions/draft-{uuid.uuid4().hex}"), self._path(table, f"_versions/{number:012d}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "parts": [asdict(p) for p in parts]}).encode()))
        out.close()
        files = self._hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            files.rename(draft, final, options)  # without an option to overwrite
            return True
        except Exception:
            if not fs.exists(final):
                raise
            fs.delete(draft, False)
            return False

    def written(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> Part:
        """A new folder with df's rows, which belongs to no version yet; its rows are counted by the write itself."""
        folder, seen = f"{_FOLDER}={uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*partition_by).parquet(f"{self.root}/{table}/{folder}")
        return Part(folder, tuple(partition_by), seen.get["n"])

    def replace(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), base: Version | None = None) -> int:
        """The table becomes df; with base, only if that is still its last version. The number of rows."""
        part = self.written(table, df, partition_by)
        self._commit(table, lambda v: (df.schema, (part,)), base)
        return part.rows

    def append(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Add a folder; its columns may differ, but not the type of one. The number of rows."""
        part = self.written(table, df, partition_by)
        self._commit(table, lambda v: (_joined(table, v.schema, df.schema), (*v.parts, part)))
        return part.rows

    def _commit(self, table: str, then: Callable[[Version], tuple[T.StructType, tuple[Part, ...]]], base: Version | None = None) -> None:
        for _ in range(TRIES if base is None else 1):
            held = base or self.version(table)
            if self.commit(table, held, *then(held)):
                return
        raise WriterError(table, "commit", "another write came first")

    def staged(self, table: str, df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        """df written aside and read back, so that it is evaluated once, and what removes it again."""
        folder = f"_staged/{uuid.uuid4().hex}"
        path = str(self._path(table, folder).toString())
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), lambda: self._fs().delete(self._path(table, folder), True)

    def vacuum(self, table: str, keep: int = 1) -> int:
        """Delete all but the last versions and the folders that only they have; how many folders. Not while others write or read older versions."""
        fs, numbers = self._fs(), self._numbers(table)
        used = {p.folder for n in numbers[-keep:] for p in self.version(table, n).parts}
        for n in numbers[:-keep]:
            fs.delete(self._path(table, f"_versions/{n:012d}.json"), False)
        names = [f.getPath().getName() for f in fs.listStatus(self._path(table))] if numbers else []
        old = [n for n in names if n.startswith(f"{_FOLDER}=") and n not in used]
        for n in old:
            fs.delete(self._path(table, n), True)
        return len(old)

    def drop(self, table: str) -> None:
        self._fs().delete(self._path(table), True)


def _joined(table: str, held: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both, nullable."""
    types = {f.name: f.dataType for f in held.fields}
    for f in new.fields:
        if types.setdefault(f.name, f.dataType) != f.dataType:
            raise WriterError(table, "append", f"column {f.name!r} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(n, t, True) for n, t in types.items()])


@dataclass
class WriteResult:
    target: str
    mode: str
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_deleted: int = 0
    rows_unchanged: int = 0
    rows_expired: int = 0
    created: bool = False
    detail: dict = field(default_factory=dict)

    @property
    def rows_written(self) -> int:
        return self.rows_inserted + self.rows_updated


class TableWriter:
    """Writes a plan's rows in its load mode."""

    def __init__(self, store: SnapshotStore, pre_write_hook: Callable | None = None, post_write_hook: Callable | None = None):
        self.store, self.pre, self.post = store, pre_write_hook, post_write_hook

    def write(self, spark: SparkSession, df: DataFrame, config: Table, context: registry.Context | None = None, pre_write_hook: Callable | None = None, post_write_hook: Callable | None = None) -> WriteResult:
        """Hooks are called as (spark, df, config, context) before and (spark, df, config, context, result or error) after, also when the write fails."""
        context = context or registry.Context()
        df = df.drop(*[c for c in config.temporary_columns if c in df.columns])
        pre, post = pre_write_hook or self.pre, post_write_hook or self.post
        if pre:
            pre(spark, df, config, context)
        outcome: WriteResult | Exception
        try:
            outcome = self._routed(df, config, context)
        except Exception as e:
            if post:
                post(spark, df, config, context, e)
            raise
        context.flush()
        if context.metrics is not None:
            context.metrics.write(outcome)
        if post:
            post(spark, df, config, context, outcome)
        return outcome

    def _routed(self, df: DataFrame, config: Table, context: registry.Context) -> WriteResult:
        p, target = config.policies, config.target
        by = p.partition_scheme
        if p.load_mode == "overwrite":
            return WriteResult(target, "overwrite", rows_inserted=self.store.replace(target, df, by))
        if p.load_mode == "append":
            return WriteResult(target, "append", rows_inserted=self.store.append(target, df, by))
        if p.load_mode == "merge":
            return self._merged(df, config, context)
        replaced = context.state.get("replace_by") or ([config.incremental.period_column] if config.incremental.period_column else list(by))
        if not replaced:
            raise WriterError(target, "replace_by_partition", "no step has named the periods to replace")
        if not self.store.exists(target):
            return WriteResult(target, "append", rows_inserted=self.store.append(target, df, by), created=True)
        return self._replaced(df, target, replaced, by)

    def _replaced(self, df: DataFrame, target: str, replaced: list[str], by: tuple[str, ...]) -> WriteResult:
        """The new rows are written once; what they replace is told from the folder they are in."""
        store, base = self.store, self.store.version(target)
        new = store.written(target, df, by)
        source = store.spark.read.schema(df.schema).parquet(f"{store.root}/{target}/{new.folder}")
        kept = store.written(target, merge.untouched(store.read(target, base), source, replaced), by)
        if not store.commit(target, base, _joined(target, base.schema, df.schema), (kept, new)):
            raise WriterError(target, "replace_by_partition", "another write came first")
        return WriteResult(target, "replace_by_partition", new.rows, 0, base.rows - kept.rows, kept.rows)

    def _merged(self, df: DataFrame, config: Table, context: registry.Context) -> WriteResult:
        p, target = config.policies, config.target
        scd, soft = p.scd, p.soft_delete
        spec = merge.MergeSpec(
            tuple(config.natural_keys), p.merge_strategy, p.hash_columns, p.milestone_columns, context.as_of, scd.get("start_column", "valid_from"), scd.get("end_column", "valid_to"), scd.get("current_column", "is_current"),
            soft.get("deleted_column", "is_deleted"), soft.get("missing_in_source", "flag"),
        )
        df, done = self.store.staged(target, df)
        try:
            merge.checked(df, spec, target)
            if not self.store.exists(target):
                if p.merge_strategy == "scd_type2":
                    df = df.withColumns({spec.start_column: F.lit(context.as_of).cast("timestamp"), spec.end_column: F.lit(None).cast("timestamp"), spec.current_column: F.lit(True)})
                return WriteResult(target, "merge", rows_inserted=self.store.append(target, df, p.partition_scheme), created=True)
            base, seen = self.store.version(target), Observation()
            kinds = ("insert", "update", "unchanged", "target_only", "expire", "delete")
            rows = merge.classified(self.store.read(target, base), df, spec).observe(seen, *[F.count(F.when(F.col("_class") == k, 1)).alias(k) for k in kinds])
            self.store.replace(target, rows.drop("_class"), p.partition_scheme, base)
            n = seen.get
            return WriteResult(target, "merge", n["insert"], n["update"], n["delete"], n["unchanged"] + n["target_only"], n["expire"])
        finally:
            done()
