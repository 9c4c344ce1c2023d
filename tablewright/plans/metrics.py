"""What a run has done, gathered on the driver and appended to six tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "run_metrics": "run_id string, load_id string, table_name string, status string, started_at timestamp, finished_at timestamp, duration_seconds double, rows_read long, rows_written long, rows_rejected long, error string",
    "source_metrics": "run_id string, source string, rows long",
    "stage_metrics": "run_id string, stage string, rows long, seconds double",
    "quality_metrics": "run_id string, column_name string, issue_type string, action string, affected_rows long",
    "write_metrics": "run_id string, target string, mode string, rows_inserted long, rows_updated long, rows_deleted long, rows_unchanged long",
    "plugin_metrics": "run_id string, plugin string, kind string, seconds double",
}


@dataclass
class RunMetrics:
    run_id: str
    table_name: str
    load_id: str = ""
    status: str = "running"
    started_at: datetime | None = None
    finished_at: datetime | None = None
    duration_seconds: float = 0.0
    rows_read: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    error: str | None = None
    parts: dict[str, list[dict]] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), default=str)

    def get_summary_table(self) -> str:
        return "\n".join(f"{k:<16} {v}" for k, v in self.to_dict().items() if k != "parts")


def create_run_metrics(table_name: str, load_id: str = "", run_id: str | None = None) -> RunMetrics:
    return RunMetrics(run_id or uuid.uuid4().hex, table_name, load_id)


class MetricsCollector:
    """Records one run; a listener's error never stops it."""

    def __init__(self, metrics: RunMetrics, now: Callable[[], datetime] = datetime.now, listeners: list[Callable[[str, dict], None]] | None = None):
        self.metrics, self.now, self.listeners = metrics, now, listeners or []
        metrics.started_at = now()
        self._began = time.monotonic()

    def _put(self, kind: str, row: dict) -> None:
        self.metrics.parts.setdefault(kind, []).append(row)
        for f in self.listeners:
            try:
                f(kind, row)
            except Exception:  # noqa: BLE001, S110
                pass

    def source(self, name: str, rows: int) -> None:
        self.metrics.rows_read += rows
        self._put("source_metrics", {"source": name, "rows": rows})

    def stage(self, name: str, rows: int, seconds: float) -> None:
        self._put("stage_metrics", {"stage": name, "rows": rows, "seconds": seconds})

    def quality(self, column: str, issue: str, action: str, rows: int) -> None:
        if action == "rejected":
            self.metrics.rows_rejected += rows
        self._put("quality_metrics", {"column_name": column, "issue_type": issue, "action": action, "affected_rows": rows})

    def plugin(self, name: str, kind: str, seconds: float) -> None:
        self._put("plugin_metrics", {"plugin": name, "kind": kind, "seconds": seconds})

    def write(self, result) -> None:
        self.metrics.rows_written += result.rows_inserted + result.rows_updated
        self._put("write_metrics", {k: getattr(result, k) for k in ("target", "mode", "rows_inserted", "rows_updated", "rows_deleted", "rows_unchanged")})

    def _end(self, status: str, error: str | None = None) -> RunMetrics:
        m = self.metrics
        if m.finished_at is None:
            m.status, m.error, m.finished_at, m.duration_seconds = status, error, self.now(), time.monotonic() - self._began
        return m

    def complete(self) -> RunMetrics:
        return self._end("success")

    def fail(self, error: object) -> RunMetrics:
        return self._end("failed", str(error))


def frames(spark: SparkSession, metrics: RunMetrics) -> dict[str, DataFrame]:
    """The rows of the six tables, with partition_year, _month and _day."""
    day = metrics.started_at or datetime.now()
    rows = {"run_metrics": [metrics.to_dict()]} | {k: [{"run_id": metrics.run_id} | r for r in v] for k, v in metrics.parts.items()}
    out = {}
    for name, schema in SCHEMAS.items():
        names = [c.split()[0] for c in schema.split(", ")]
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows.get(name, [])], schema)
        out[name] = df.withColumns({f"partition_{k}": F.lit(getattr(day, k)) for k in ("year", "month", "day")})
    return out


def save(spark: SparkSession, metrics: RunMetrics, append: Callable[[str, DataFrame], None], tries: int = 3, wait: Callable[[float], None] = time.sleep) -> None:
    """Append them, again after 2, 4, ... seconds if another writer was in the way."""
    for name, df in frames(spark, metrics).items():
        for k in range(tries):
            try:
                append(name, df)
                break
            except Exception:
                if k == tries - 1:
                    raise
                wait(2.0 ** (k + 1))
