import datetime as dt

import pytest

from ledgerline.operators import quality
from ledgerline.params import IngestionWindow
from ledgerline.plans import batch
from ledgerline.schemas import get_schema, nullable_copy
from ledgerline.sources import layers
from ledgerline.sources.tables import scan_layer

SOURCE = "/root/testdata/sf0.001"


def config(run_id, window=None):
    return batch.RunConfig(run_id, dt.date(2001, 1, 15), "region", window)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, batch.run(spark, SOURCE, root, config("run_20010115_000000"))


def test_all_stages_write_their_tables(spark, finished):
    root, rows = finished
    assert list(rows) == ["ingest_financials", "ingest_macro", "dq_validation", "silver_transforms",
                          "forecasting", "financial_statements", "export"]
    assert rows["ingest_macro"] == 80 and rows["forecasting"] == 5 * 36
    assert scan_layer(spark, root, "gold_scenarios").count() == 5 * 3 * 4
    assert scan_layer(spark, root, "gold_cash_flow").count() == 5 * 11
    assert scan_layer(spark, root, "gold_dcf").count() == 15
    assert scan_layer(spark, root, "silver_dq_log").count() == 48
    assert spark.read.option("header", True).csv(f"{root}/exports/gold_scenarios").count() == 60


def test_run_log_and_audit(spark, finished):
    root, _ = finished
    log = scan_layer(spark, root, "bronze_run_log").collect()
    assert {r.status for r in log} == {"success"} and len(log) == 7
    kinds = {r.event_type for r in scan_layer(spark, root, "gold_audit_log").collect()}
    assert {"pipeline_start", "pipeline_complete"} <= kinds


def test_second_run_keeps_the_first_snapshot(spark, finished):
    root, rows = finished
    again = batch.run(spark, SOURCE, root, config("run_20010116_000000"))
    assert again == rows
    path = f"{root}/bronze/company_financials"
    first = layers.read_snapshot(spark, path, "run_20010115_235959")
    assert first.count() == rows["ingest_financials"]
    assert {r._run_id for r in first.select("_run_id").distinct().collect()} == {"run_20010115_000000"}


def test_a_failing_gate_stops_the_run_and_is_logged(spark, tmp_path, monkeypatch):
    def refuse(*_):
        raise quality.GateAborted("too many")

    monkeypatch.setattr(batch.quality, "enforce_gate", refuse)
    with pytest.raises(quality.GateAborted):
        batch.run(spark, SOURCE, str(tmp_path), config("run_20010115_000000"))
    log = {r.stage: r for r in scan_layer(spark, str(tmp_path), "bronze_run_log").collect()}
    assert log["dq_validation"].status == "failed" and "too many" in log["dq_validation"].error_message
    assert "silver_transforms" not in log


def test_registered_columns_and_a_smaller_second_run(spark, tmp_path):
    root = str(tmp_path)
    run_id = "run_20010117_000000"
    batch.run(spark, SOURCE, root, config(run_id))
    for table, schema in (("silver_monthly", "silver_monthly_financials"), ("gold_scenarios", "gold_annual_forecast"),
                          ("silver_dq_log", "silver_data_quality_log")):
        found = dict(scan_layer(spark, root, table).dtypes)
        assert {f.name: f.dataType.simpleString() for f in nullable_copy(get_schema(schema))}.items() <= found.items()
    checks = scan_layer(spark, root, "silver_dq_log").count()
    parked = scan_layer(spark, root, "quarantine_financials").count()
    log = {r.stage: r for r in scan_layer(spark, root, "bronze_run_log").collect()}
    assert log["dq_validation"].rows_failed == parked
    # the same run again: logs are replaced; a smaller window: no year is left behind
    batch.run(spark, SOURCE, root, config(run_id, IngestionWindow(dt.date(1996, 1, 1), dt.date(1999, 12, 31))))
    assert scan_layer(spark, root, "silver_dq_log").count() == checks
    years = {r.year for r in scan_layer(spark, root, "silver_monthly").select("year").distinct().collect()}
    assert years == {1996, 1997, 1998, 1999}
    assert scan_layer(spark, root, "gold_monthly_forecast").agg({"date": "min"}).first()[0] == dt.date(2000, 1, 1)
