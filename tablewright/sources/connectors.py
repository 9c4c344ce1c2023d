"""Sources behind web services. A client is passed in: anything with the methods named here, so that tests need no network."""

from __future__ import annotations

from datetime import datetime
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.errors import ConfigError


class QueryClient(Protocol):
    """An object store that answers queries."""

    def query(self, text: str) -> list[dict]: ...
    def count(self, text: str) -> int: ...


class PageClient(Protocol):
    """A service of JSON pages."""

    def get(self, url: str) -> dict: ...


def where_later(column: str | None, after: datetime | None) -> str:
    return f" WHERE {column} > {after.strftime('%Y-%m-%dT%H:%M:%SZ')}" if column and after else ""


def object_rows(spark: SparkSession, client: QueryClient, name: str, columns: list[str], run_id: str, watermark_column: str | None = None, after: datetime | None = None) -> DataFrame:
    """All rows of an object later than after, as text, with run_id; an answer of another length than the count is an error."""
    where = where_later(watermark_column, after)
    expected = client.count(f"SELECT COUNT() FROM {name}{where}")
    rows = client.query(f"SELECT {', '.join(columns)} FROM {name}{where}")
    if len(rows) != expected:
        raise ConfigError(f"{name}: {len(rows)} rows of {expected}")
    data = [tuple(None if r.get(c) is None else str(r[c]) for c in columns) + (run_id,) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in [*columns, "run_id"]))


def pages(client: PageClient, url: str, max_pages: int | None = None) -> tuple[list[dict], str | None]:
    """Items of all pages from url on, and the link from which later changes are read."""
    items: list[dict] = []
    link: str | None = url
    delta = None
    n = 0
    while link and (max_pages is None or n < max_pages):
        page = client.get(link)
        inner = page.get("d", page)
        items += inner.get("value") or inner.get("results") or []
        link = page.get("@odata.nextLink") or inner.get("__next")
        delta = page.get("@odata.deltaLink") or delta
        n += 1
    return items, delta


def flattened(item: dict) -> dict[str, Any]:
    """An item's fields with its id, address and whether it was removed."""
    return {**(item.get("fields") or {}), "id": item.get("id"), "webUrl": item.get("webUrl"), "is_deleted": "@removed" in item}


def list_rows(spark: SparkSession, items: list[dict]) -> DataFrame:
    """Items as rows of text, with is_deleted as boolean."""
    rows = [flattened(i) for i in items]
    names = sorted({k for r in rows for k in r} - {"is_deleted", "id"})
    data = [(str(r["id"]), *(None if r.get(c) is None else str(r[c]) for c in names), r["is_deleted"]) for r in rows]
    return spark.createDataFrame(data, ", ".join(["id string", *(f"`{c}` string" for c in names), "is_deleted boolean"]))


def list_changes(spark: SparkSession, client: PageClient, url: str, delta_link: str | None = None, max_pages: int | None = None) -> tuple[DataFrame, str | None]:
    """All items of a list, or only what has changed since delta_link, and the next delta link."""
    items, delta = pages(client, delta_link or url, max_pages)
    return list_rows(spark, items), delta


def latest_cursor(cursors: DataFrame, by: list[str], value: str, at: str) -> DataFrame:
    """The newest value of each source."""
    return cursors.groupBy(*by).agg(F.max_by(value, at).alias(value))


def last_success(log: DataFrame, table: str):
    """The largest pulled timestamp among successful runs of a table."""
    return log.filter((F.col("source_table") == table) & (F.col("execution_status") == "SUCCESS")).agg(F.max("last_pulled_timestamp")).first()[0]


def object_map(tables: list[dict]) -> dict[str, dict]:
    """From table plans: what to pull of each object (columns, watermark)."""
    out: dict[str, dict] = {}
    for t in tables:
        for s in t.get("sources") or []:
            name = (s.get("extensions") or {}).get("object")
            if not name:
                continue
            entry = out.setdefault(name, {"table": s.get("table"), "columns": [], "watermark": None})
            for c in t.get("columns") or []:
                entry["columns"] += [i["column"] for i in c.get("inputs") or [] if i.get("source") in (s["name"], None) and i.get("column") and i["column"] not in entry["columns"]]
            entry["watermark"] = entry["watermark"] or (t.get("incremental") or {}).get("source_watermark_column")
    return out
