import datetime as dt
import json

import pytest

from ledgerline.operators import monitoring as mon
from ledgerline.sources import logs

T0 = dt.datetime(2024, 1, 30, 12)


def event(day, kind, message, severity="INFO", **more):
    return {"run_id": "run_1", "event_type": kind, "message": message, "severity": severity,
            "recorded_at": T0 - dt.timedelta(days=day)} | more


@pytest.fixture(scope="module")
def audit(spark):
    return logs.audit_frame(
        spark,
        [
            event(0, "pipeline_complete", "Pipeline SUCCESS in 12.5s"),
            event(0, "pipeline_complete", "Pipeline FAILED in 7.5s", "ERROR"),
            event(1, "stage_event", "odd rows", "WARN", metadata={"n": 3}),
            event(60, "pipeline_complete", "Pipeline SUCCESS in 10s"),
        ],
    )


def test_health_counts_by_day_within_the_window(audit):
    rows = mon.run_health(audit, dt.date(2024, 1, 31)).orderBy("run_date").collect()
    assert [(r.successes, r.failures) for r in rows] == [(0, 0), (1, 1)]


def test_mean_duration(audit):
    assert mon.mean_duration(audit).first()[0] == pytest.approx(10.0)


def test_recent_problems(audit):
    rows = mon.recent_problems(audit).collect()
    assert [r.message for r in rows] == ["Pipeline FAILED in 7.5s", "odd rows"]


def test_metadata_is_json_and_severity_is_checked(spark, audit):
    row = audit.filter("severity = 'WARN'").first()
    assert json.loads(row.metadata_json) == {"n": 3}
    with pytest.raises(ValueError):
        logs.audit_frame(spark, [event(0, "x", "y", "LOUD")])


def test_stage_summary_lists_stages_that_did_not_run(spark):
    log = spark.createDataFrame(
        [("r", "a", "failed", T0, 1.0, 5), ("r", "a", "success", T0 + dt.timedelta(1), 2.0, 6)],
        "run_id string, stage string, status string, started_at timestamp, duration_seconds double, rows_processed bigint",
    )
    rows = mon.stage_summary(log, ["a", "b"]).orderBy("stage_no").collect()
    assert [(r.stage, r.status, r.duration_seconds) for r in rows] == [("a", "success", 2.0), ("b", "not_run", None)]


def test_config_snapshot_can_be_read_back(spark):
    row = logs.config_snapshot_event(spark, "run_1", T0).first()
    assert json.loads(row.metadata_json)["model"]["default_wacc"] == 0.12
