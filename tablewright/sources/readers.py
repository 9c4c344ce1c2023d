"""Reading: tables, paths, generated rows, and text files whose header may stand below title lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import ConfigError
from tablewright.plans.config import Source

#: The range of a date spine that names none.
DATE_START, DATE_END = date(2020, 1, 1), date(2030, 1, 1)


def generated(spark: SparkSession, spec: dict) -> DataFrame:
    """_generated_row_id from 0 for row_count rows, or date_value from date_start to date_end for a spine of dates."""
    if "row_count" in spec and "date_start" not in spec:
        return spark.range(int(spec["row_count"])).withColumnRenamed("id", "_generated_row_id")
    if spec.get("date_start") or spec.get("date_end") or spec.get("kind") == "dates":
        first, last = (F.lit(str(spec.get(k) or d)).cast("date") for k, d in (("date_start", DATE_START), ("date_end", DATE_END)))
        return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_value"))
    return spark.range(1).withColumnRenamed("id", "_generated_row_id")


def read(spark: SparkSession, source: Source) -> DataFrame:
    """The rows of a source; columns are projected if it names any, else Catalyst prunes them."""
    if source.generated is not None:
        df = generated(spark, source.generated)
    elif source.path:
        df = spark.read.format(source.format).options(**{k: str(v) for k, v in source.options.items()}).load(source.path)
    else:
        df = spark.table(source.table)
    return df.select(*source.columns) if source.columns else df


def load_sources(spark: SparkSession, sources: tuple[Source, ...]) -> dict[str, DataFrame]:
    """Sources by name and by alias."""
    out = {}
    for s in sources:
        df = read(spark, s)
        out |= {s.name: df} | ({s.alias: df} if s.alias else {})
    return out


CSV = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"'}


def _named(values: list[str | None]) -> list[str]:
    """Column names from header cells: blank ones by place, repeated ones numbered."""
    out: list[str] = []
    for i, v in enumerate(values):
        name = (v or "").strip() or f"_c{i}"
        base, n = name, 0
        while name in out:
            n += 1
            name = f"{base}_{n}"
        out.append(name)
    return out


def read_csv_file(spark: SparkSession, path: str, delimiter: str = ",", header_start: int = 1, header_marker: str | None = None, multi_line: bool = True) -> DataFrame:
    """One file, all columns text. The header is line header_start, or the first whose first cell begins with header_marker (in any case); lines without a sign don't count.

    Lines are told apart by ids that rise along the file, so that nothing is sorted or moved
    to one task; a file of multi_line records is read by one task, as Spark can't split it.
    """
    reader = spark.read.options(**CSV | {"sep": delimiter, "multiLine": str(multi_line).lower()})
    if header_start <= 1 and not header_marker:
        return reader.csv(path)
    # as many columns as any line has, or more where delimiters stand in quotes
    width = (spark.read.text(path).agg(F.max(F.size(F.split("value", f"\\Q{delimiter}\\E")))).first()[0] or 1)
    wide = ", ".join(f"c{i} string" for i in range(width))
    rows = reader.option("header", "false").schema(wide).csv(path).withColumn("__line", F.monotonically_increasing_id())
    if header_marker:
        head = rows.filter(F.lower(F.trim("c0")).startswith(header_marker.strip().lower())).take(1)
    else:
        head = rows.take(header_start)[header_start - 1 :]
    if not head:
        raise ConfigError(f"{path}: no header line")
    cells = [head[0][f"c{i}"] for i in range(width)]
    used = max((i + 1 for i, v in enumerate(cells) if v not in (None, "")), default=0)
    names = _named(cells[:used])
    body = rows.filter(F.col("__line") > head[0]["__line"]).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    if not body.take(1):
        raise ConfigError(f"{path}: no rows below the header")
    return body


def read_txt_file(spark: SparkSession, path: str, delimiter: str = "\t", **options: object) -> DataFrame:
    return read_csv_file(spark, path, delimiter, **options)  # type: ignore[arg-type]


def read_excel_file(spark: SparkSession, path: str, sheet_name: str | None = None, sheet_match: str = "exact", header_start: int = 1, header_marker: str | None = None) -> DataFrame:
    """One workbook's sheet, all columns text; needs pandas with a reader of workbooks (openpyxl)."""
    import io

    import pandas as pd

    raw = spark.read.format("binaryFile").load(path).select("content").first()[0]
    book = pd.read_excel(io.BytesIO(bytes(raw)), sheet_name=None, header=None, dtype=str)
    wanted = (sheet_name or "").strip().lower()
    match = {"exact": lambda n: n == wanted, "prefix": lambda n: n.startswith(wanted.rstrip("%")), "contains": lambda n: wanted.strip("%") in n, "first": lambda n: True}.get(sheet_match)
    if match is None:
        raise ConfigError(f"sheet match {sheet_match!r}")
    if not wanted:
        match = lambda n: True
    for name, cells in book.items():
        if not match(name.strip().lower()):
            continue
        at = header_start - 1
        if header_marker:
            hits = [i for i, v in enumerate(cells[0].fillna("")) if v.strip().lower().startswith(header_marker.strip().lower())]
            if not hits:
                continue
            at = hits[0]
        body = cells.iloc[at + 1 :].where(cells.notna(), None)
        if len(body):
            names = _named(cells.iloc[at].where(cells.iloc[at].notna(), None).tolist())
            return spark.createDataFrame(body.values.tolist(), ", ".join(f"`{n}` string" for n in names))
    raise ConfigError(f"{path}: no sheet {sheet_name!r} with rows")


def read_file(spark: SparkSession, rule: dict) -> DataFrame:
    """The reader for the file's extension, with the rule's header, delimiter and sheet."""
    kind = str(rule.get("extension") or rule["path"].rpartition(".")[2]).lower().lstrip(".")
    where = {"header_start": int(rule.get("header_start") or 1), "header_marker": rule.get("header_marker")}
    if kind == "csv":
        return read_csv_file(spark, rule["path"], rule.get("delimiter") or ",", **where)
    if kind == "txt":
        return read_txt_file(spark, rule["path"], rule.get("delimiter") or "\t", **where)
    if kind in ("xls", "xlsx"):
        return read_excel_file(spark, rule["path"], rule.get("sheet_name"), rule.get("sheet_match") or "exact", **where)
    raise ConfigError(f"no reader for {kind!r} files")


def list_files(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """folder, file_name, path, extension, modified_on of the files one folder below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    out = files.select(F.element_at(parts, -2).alias("folder"), name.alias("file_name"), "path", F.lower(F.element_at(F.split(name, r"\."), -1)).alias("extension"), F.col("modificationTime").alias("modified_on"))
    return out.filter(F.col("extension").isin([e.lower().lstrip(".") for e in extensions])) if extensions else out


def read_manual_csv(spark: SparkSession, path: str, schema: str | None = None, source: str = "manual", at: object = None) -> DataFrame:
    """A hand-kept CSV with a header and its types (inferred where no schema is given), with where it came from; columns of those names are replaced."""
    reader = spark.read.option("header", "true")
    df = (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)
    parts = F.split(F.lit(path), "/")
    marks = {"_source": F.lit(source), "_source_file": F.element_at(parts, -1), "_source_folder": F.try_element_at(parts, F.lit(-2)), "_source_modified": F.lit(at).cast("timestamp"), "_source_period": F.lit(None).cast("string")}
    return df.withColumns(marks)


def schema_names(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def table_names(spark: SparkSession, schema: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(schema)]


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in spark.table(table).schema.fields], "name string, type string, nullable boolean")
