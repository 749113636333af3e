"""Audit, run and data-quality log rows.

``RunLogger`` is what a batch run writes.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from ledgerline.params import config_snapshot
from ledgerline.schemas import get_schema
from ledgerline.sources.layers import append

SEVERITIES = ("INFO", "WARN", "ERROR")


def audit_frame(spark: SparkSession, events: list[dict]) -> DataFrame:
    """Audit rows from event dicts; ``metadata`` becomes JSON text."""
    rows = []
    for e in events:
        if e.get("severity", "INFO") not in SEVERITIES:
            raise ValueError(f"unknown severity: {e['severity']}")
        meta = e.get("metadata")
        rows.append(
            (
                e["run_id"], e.get("event_type", "stage_event"), e.get("stage"),
                e.get("table_name"), e.get("rows_affected"), e.get("message"),
                e.get("severity", "INFO"), json.dumps(meta, sort_keys=True) if meta else None,
                e.get("recorded_at") or dt.datetime.now(dt.timezone.utc),
            )
        )
    return spark.createDataFrame(rows, get_schema("gold_audit_log"))


def config_snapshot_event(spark: SparkSession, run_id: str, recorded_at=None) -> DataFrame:
    """The parameters of a run as one audit row."""
    return audit_frame(
        spark,
        [
            {
                "run_id": run_id,
                "event_type": "pipeline_start",
                "message": "configuration",
                "metadata": json.loads(config_snapshot()),
                "recorded_at": recorded_at,
            }
        ],
    )


class RunLogger:
    """Collects the few events of one run and appends them to the log tables."""

    def __init__(self, spark: SparkSession, run_id: str, audit_path: str, run_log_path: str):
        self.spark, self.run_id = spark, run_id
        self.audit_path, self.run_log_path = audit_path, run_log_path
        self._events: list[dict] = []
        self._stages: list[tuple] = []

    def event(self, stage: str, message: str, severity: str = "INFO", **details) -> None:
        self._events.append(
            {"run_id": self.run_id, "stage": stage, "message": message, "severity": severity}
            | details
        )

    def stage(
        self, stage: str, status: str, started_at: dt.datetime, rows: int | None = None,
        rows_failed: int | None = None, error: str | None = None,
    ) -> None:
        ended = dt.datetime.now(dt.timezone.utc)
        self._stages.append(
            (
                self.run_id, stage, status, started_at, ended,
                (ended - started_at).total_seconds(), rows, rows_failed, error, config_snapshot(),
            )
        )

    def flush(self) -> None:
        if self._events:
            append(audit_frame(self.spark, self._events), self.audit_path)
        if self._stages:
            frame = self.spark.createDataFrame(self._stages, get_schema("bronze_pipeline_run_log"))
            append(frame, self.run_log_path)
        self._events, self._stages = [], []
