"""File ingestion: match files to rules, read, stamp, append, log, reconcile."""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import cleaning
from tablewright.sources import readers

LOG = "run_id string, source string, folder string, file_name string, path string, period string, modified_on timestamp, loaded_on timestamp, target_table string, status string, row_count long, error string"
#: Statuses after which a file is read again.
AGAIN = ("FAILED", "DRYRUN")


def sanitized(names: list[str]) -> list[str]:
    """Column names in lower case with underscores, blanks by place, repeats numbered."""
    out: list[str] = []
    for i, n in enumerate(names):
        base = "".join(c if c.isascii() and c.isalnum() else "_" for c in n.lower()).strip("_") or f"col_{i}"
        name, k = base, 0
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def normalized(df: DataFrame, rules: str | None) -> DataFrame:
    """Rules prefix:target, comma-separated: the first column that begins with prefix is named target, later ones are dropped."""
    names = {c: c for c in df.columns}
    for rule in (rules or "").split(","):
        prefix, _, target = (x.strip() for x in rule.partition(":"))
        hits = [c for c in names if prefix and c.lower().startswith(prefix.lower())]
        for c in hits[1:]:
            del names[c]
        if hits:
            names[hits[0]] = target
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def new_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files that no run has loaded since they were modified."""
    done = log.filter(~F.col("status").isin(*AGAIN)).select("folder", "file_name", "modified_on").distinct()
    return files.join(done, ["folder", "file_name", "modified_on"], "left_anti")


def match_conditions(loose: bool = False) -> dict[str, object]:
    """The tests of a file (f) against a rule (c), by name."""
    same = cleaning.sanitize_name(F.col("f.folder")).eqNullSafe(cleaning.sanitize_name(F.col("c.folder_name")))
    period = cleaning.extract_period(F.col("f.file_name")).try_cast("long")
    pattern = F.lower(F.coalesce(F.nullif(F.trim("c.file_name_wildcard"), F.lit("")), F.lit("%")))
    return {
        "folder": (same | F.lower("f.folder").contains(F.lower("c.folder_name"))) if loose else same,
        "extension": F.lower("f.extension") == F.lower(F.ltrim(F.col("c.extension"), F.lit("."))),
        "wildcard": F.like(F.lower("f.file_name"), pattern),
        "period": F.coalesce(period.between(F.coalesce("c.time_range_min", F.lit(0)), F.coalesce("c.time_range_max", F.lit(999999))), F.col("c.time_range_min").isNull() & F.col("c.time_range_max").isNull()),
        "not_excluded": ~cleaning.excluded(F.col("f.file_name"), F.coalesce("c.exclude_file", F.lit(""))),
    }


def matched_files(files: DataFrame, rules: DataFrame) -> DataFrame:
    """files with the columns of each rule they fit, and their period. Rules are equi-joined by folder and extension; the rest filters."""
    f, c = files.alias("f"), rules.alias("c")
    on = functools.reduce(lambda a, b: a & b, match_conditions().values())
    rest = [F.col(f"c.{n}") for n in rules.columns if n not in files.columns]
    return f.join(c, on).select("f.*", cleaning.extract_period(F.col("f.file_name")).alias("period"), *rest).distinct()


def match_debug(files: DataFrame, rules: DataFrame) -> DataFrame:
    """Each file beside each rule of its extension with the outcome of every test."""
    return files.alias("f").join(rules.alias("c"), match_conditions()["extension"]).select("f.file_name", "c.folder_name", *[F.coalesce(v, F.lit(False)).alias(f"is_{k}") for k, v in match_conditions(True).items()])


def stamped(df: DataFrame, run_id: str, file: dict, at: datetime) -> DataFrame:
    """df as text with where, when and by which run it was read."""
    marks = {"_run_id": run_id, "_source": file.get("source"), "_source_file": file["file_name"], "_source_folder": file["folder"], "_source_modified": file.get("modified_on"), "_source_period": file.get("period"), "_loaded_at": at}
    return as_text(df).withColumns({k: F.lit(None if v is None else str(v)).cast("string") for k, v in marks.items()})


def process_files(spark: SparkSession, files: list[dict], append, run_id: str, at: datetime, dry_run: bool = False, bulk: bool = False, read=readers.read_file) -> DataFrame:
    """Read each file and hand it to append(target, df); the log of what came of each. bulk: one append a target, which fails as a whole."""
    log, held = [], {}
    for f in files:
        status, n, error = "SUCCESS", 0, None
        try:
            df = read(spark, f)
            df = normalized(df.toDF(*sanitized(df.columns)), f.get("column_normalize"))
            out = stamped(df, run_id, f, at)
            n = out.count()
            status = "EMPTY" if not n else "DRYRUN" if dry_run else status
            if status == "SUCCESS":
                if bulk:
                    held.setdefault(f["target_table"], []).append((len(log), out))
                else:
                    append(f["target_table"], out)
        except Exception as e:
            status, error = "FAILED", str(e)[:1000]
        log.append([run_id, f.get("source"), f["folder"], f["file_name"], f["path"], f.get("period"), f.get("modified_on"), at, f["target_table"], status, n, error])
    for target, parts in held.items():
        try:
            append(target, functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df for _, df in parts]))
        except Exception as e:
            for i, _ in parts:
                log[i][9], log[i][11] = "FAILED", str(e)[:1000]
    return spark.createDataFrame([tuple(r) for r in log], LOG)


def run_ingestion(spark: SparkSession, root: str, rules: DataFrame, log: DataFrame, append, run_id: str, at: datetime, **how) -> DataFrame:
    """List, leave out what is loaded, match, process; the log of the run."""
    files = matched_files(new_files(readers.list_files(spark, root), log), rules)
    return process_files(spark, [r.asDict() for r in files.orderBy("folder", "file_name").collect()], append, run_id, at, **how)


def run_ingestion_parallel(spark: SparkSession, roots: list[str], rules: DataFrame, log: DataFrame, append, run_id: str, at: datetime, workers: int = 4, **how) -> DataFrame:
    """run_ingestion() of several folders at a time."""
    with ThreadPoolExecutor(workers) as pool:
        logs = list(pool.map(lambda r: run_ingestion(spark, r, rules, log, append, run_id, at, **how), roots))
    return functools.reduce(DataFrame.unionByName, logs)


def reconciled(files: DataFrame, rules: DataFrame, log: DataFrame) -> DataFrame:
    """Each file with its state: of its latest log line, else PENDING if a rule fits it, else UNMATCHED."""
    fits = matched_files(files, rules).select("folder", "file_name", "modified_on").distinct().withColumn("fits", F.lit(True))
    last = log.groupBy("folder", "file_name", "modified_on").agg(F.max_by("status", F.struct("loaded_on", "run_id")).alias("status"))
    state = F.when(F.col("status") == "SUCCESS", "INGESTED").when(F.col("status").isNotNull(), F.col("status")).when(F.col("fits"), "PENDING").otherwise("UNMATCHED")
    return files.join(fits, ["folder", "file_name", "modified_on"], "left").join(last, ["folder", "file_name", "modified_on"], "left").select("folder", "file_name", "modified_on", state.alias("ingestion_status"))


def validated(spark: SparkSession, files: list[dict], read=readers.read_file) -> DataFrame:
    """Read each file without writing: OK, EMPTY or FAILED."""
    out = []
    for f in files:
        try:
            n = read(spark, f).count()
            out.append((f["folder"], f["file_name"], "OK" if n else "EMPTY", n, None))
        except Exception as e:
            out.append((f["folder"], f["file_name"], "FAILED", 0, str(e)[:1000]))
    return spark.createDataFrame(out, "folder string, file_name string, status string, row_count long, error string")


def summary(log: DataFrame) -> DataFrame:
    return log.groupBy("source", "status").agg(F.count("*").alias("files"), F.sum("row_count").alias("rows"), F.max("loaded_on").alias("last_loaded")).orderBy("source", "status")


def latest_failures(log: DataFrame, n: int = 10) -> DataFrame:
    return log.filter("status = 'FAILED'").orderBy(F.desc("loaded_on"), "folder", "file_name").limit(n)
