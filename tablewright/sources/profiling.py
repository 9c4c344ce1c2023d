"""Looking at files before there are rules for them: header line, columns, period, rows, sheets."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.functions import cleaning

SCHEMA = "path string, sheet_names array<string>, column_names array<string>, row_count long, header_start long, error string"
#: The delimiters of text files by extension.
DELIMITERS = {"csv": ",", "txt": "\t"}


def header_start(rows: list[list | None]) -> int | None:
    """Number (from 1) of the first row that looks like a header: at least half of its cells that hold anything are text, or at least half of all its cells hold something."""
    for n, row in enumerate(rows, 1):
        held = [c for c in row or [] if c is not None and str(c).strip()]
        if held and (sum(isinstance(c, str) for c in held) >= max(1, len(held) // 2) or len(held) >= max(1, len(row or []) // 2)):
            return n
    return None


def _columns(rows: list[list], at: int | None) -> list[str]:
    """Names in the header row, by place where a cell is blank."""
    cells = rows[at - 1] if at else rows[0] if rows else []
    return [str(c).strip() if at and c is not None and str(c).strip() else f"col_{i}" for i, c in enumerate(cells)]


def _texts(spark: SparkSession, paths: list[str], delimiter: str, sample_rows: int) -> DataFrame:
    """One pass over text files: rows are counted, and only the first lines of each are gathered."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"), "value")
    n = lines.groupBy("path").agg(F.count("*").alias("row_count"))
    first = lines.withColumn("place", F.row_number().over(W.partitionBy("path").orderBy("line"))).filter(F.col("place") <= sample_rows)
    sample = first.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]).alias("sample"))

    @F.pandas_udf("column_names array<string>, header_start long")
    def seen(samples: pd.Series) -> pd.DataFrame:
        out = []
        for s in samples:
            rows = [list(r) for r in csv.reader([x or "" for x in s], delimiter=delimiter)]
            at = header_start(rows)
            out.append((_columns(rows, at), at))
        return pd.DataFrame(out, columns=["column_names", "header_start"])

    return n.join(sample, "path").withColumn("seen", seen("sample")).select("path", F.array().cast("array<string>").alias("sheet_names"), "seen.column_names", "row_count", "seen.header_start", F.lit(None).cast("string").alias("error"))


def _workbooks(spark: SparkSession, paths: list[str], sample_rows: int) -> DataFrame:
    """Workbooks, each in the task that reads it; what fails is told in error."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch.path, batch.content):
                try:
                    book = pd.ExcelFile(io.BytesIO(content))
                    names = [str(n) for n in book.sheet_names]
                    cells = book.parse(names[0], header=None)
                    rows = cells.head(sample_rows).where(cells.notna(), None).values.tolist()
                    at = header_start(rows)
                    out.append((path, names, _columns(rows, at), len(cells), at, None))
                except Exception as e:  # noqa: BLE001
                    out.append((path, [], [], None, None, str(e)[:1000]))
            yield pd.DataFrame(out, columns=["path", "sheet_names", "column_names", "row_count", "header_start", "error"]).astype({"row_count": "Int64", "header_start": "Int64"})

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(look, SCHEMA)


def profiled(spark: SparkSession, files: DataFrame, sample_rows: int = 20) -> DataFrame:
    """files (folder, file_name, path, extension, modified_on) with period, sheet_names, column_names, row_count (all lines), header_start and error.

    Column names are those of the header row itself; files of other extensions have nulls.
    """
    kinds: dict[str, list[str]] = {}
    for r in files.select("path", F.lower(F.ltrim("extension", F.lit("."))).alias("kind")).distinct().toLocalIterator():
        kinds.setdefault(r.kind, []).append(r.path)
    parts = [_texts(spark, kinds[k], d, sample_rows) for k, d in DELIMITERS.items() if k in kinds]
    if "xlsx" in kinds:
        parts.append(_workbooks(spark, kinds["xlsx"], sample_rows))
    out = spark.createDataFrame([], SCHEMA)
    for p in parts:
        out = out.unionByName(p)
    # one file has several spellings of its path: with a scheme or not, with signs escaped or not
    plain = lambda c: F.regexp_replace(F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c), r"^file:/+", "/")
    both = files.join(out.withColumnRenamed("path", "__path"), plain(F.col("path")) == plain(F.col("__path")), "left").drop("__path")
    return both.withColumn("period", cleaning.extract_period(F.col("file_name")))
