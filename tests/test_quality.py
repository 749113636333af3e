import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.params import QualityLimits
from ledgerline.schemas import get_schema, nullable_copy

AS_OF = dt.date(2021, 1, 1)


@pytest.fixture(scope="module")
def edges(spark):
    """One row per edge of the rules: revenue, cogs, gross profit, ebt, net income, churn."""
    d = dt.date
    rows = [
        ("exact", d(2020, 1, 1), 1000.0, 400.0, 600.0, 10.0, 7.0, 0.1),
        ("off_by_1_00", d(2020, 1, 1), 1000.0, 400.0, 601.0, 10.0, 7.0, 0.1),
        ("off_by_1_01", d(2020, 1, 1), 1000.0, 400.0, 601.01, 10.0, 7.0, 0.1),
        ("zero", d(2020, 1, 1), 0.0, 0.0, 0.0, 10.0, 7.0, 0.1),
        ("null_revenue", d(2020, 1, 1), None, 400.0, 600.0, 10.0, 7.0, 0.1),
        ("loss_after_tax", d(2020, 1, 1), 1000.0, 400.0, 600.0, 10.0, -7.0, 0.1),
        ("churn", d(2020, 1, 1), 1000.0, 400.0, 600.0, 10.0, 7.0, 1.2),
        ("exact", d(2020, 1, 1), 1000.0, 400.0, 600.0, 10.0, 7.0, 0.1),
    ]
    return spark.createDataFrame(
        rows,
        "company string, date date, revenue double, cogs double, gross_profit double, "
        "ebt double, net_income double, churn_rate double",
    )


def by_check(df):
    return {r.check_name: r for r in df.collect()}


def test_every_row_lands_on_exactly_one_side(edges):
    clean, parked = q.clean_rows(edges), q.quarantine(edges, "run_x")
    assert clean.count() + parked.count() == edges.count()
    reasons = {r.company: r._quarantine_reason for r in parked.collect()}
    assert reasons == {
        "off_by_1_01": "gross_profit_identity_failed",
        "zero": "revenue_non_positive",
        "null_revenue": "null_in_rule_input",
    }
    assert clean.columns == edges.columns


def test_silver_filter_is_stricter_than_the_gate(edges):
    assert "off_by_1_00" in {r.company for r in q.clean_rows(edges).collect()}
    assert "off_by_1_00" not in {r.company for r in q.silver_validate(edges).collect()}


def test_business_range_and_null_rules_in_one_aggregate(edges):
    rules = [
        *q.business_rules(edges), *q.range_rules(edges, q.FINANCIALS_RANGES),
        *q.hard_null_rules(edges, q.FINANCIALS_NOT_NULL),
    ]
    df = q.evaluate(edges, "t", rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    got = by_check(df)
    assert got["gross_profit_identity"].rows_failed == 1 and not got["gross_profit_identity"].passed
    assert got["net_income_sign_consistent"].rows_failed == 1
    assert got["range_churn_rate_0.0_1.0"].rows_failed == 1
    assert got["not_null_revenue"].rows_failed == 1 and got["not_null_cogs"].passed
    assert got["revenue_gt_cogs"].rows_failed == 1  # zero revenue, a null does not fail
    assert got["gross_margin_bounds"].rows_failed == 0
    assert "customers" not in {r.column_name for r in got.values()}  # absent column is skipped


def test_duplicates(edges):
    row = q.check_duplicates(edges, "t", ["date", "company"]).first()
    assert (row.rows_checked, row.rows_failed, row.passed) == (8, 1, False)
    top = q.duplicate_keys(edges, ["company"]).collect()
    assert [(r.company, r.n_rows) for r in top] == [("exact", 2)]


def test_checks_on_an_empty_table(edges):
    empty = edges.filter("false")
    got = by_check(q.evaluate(empty, "t", [q.freshness_rule(45, AS_OF), *q.business_rules(empty)]))
    assert got["data_freshness"].rows_failed == 1
    assert got["gross_profit_identity"].passed and got["gross_profit_identity"].rows_checked == 0
    assert q.check_duplicates(empty, "t", ["company"]).first().passed
    assert q.gate(empty).first().abort is False


def test_freshness(edges):
    assert by_check(q.evaluate(edges, "t", [q.freshness_rule(366, AS_OF)]))["data_freshness"].passed
    assert not by_check(q.evaluate(edges, "t", [q.freshness_rule(365, AS_OF)]))["data_freshness"].passed


def test_referential(spark, edges):
    macro = spark.createDataFrame([(dt.date(2020, 2, 1),)], "date date")
    row = q.check_referential(edges, macro).first()
    assert (row.rows_checked, row.rows_failed, row.passed) == (1, 1, False)


def test_schema_check_reports_missing_and_wrong_types(edges):
    schema = get_schema(q.FINANCIALS)
    got = by_check(q.check_schema(edges.withColumn("churn_rate", F.lit("x")), schema, "t"))
    assert got["schema_columns_present"].rows_failed == 22 - 8
    assert got["schema_types_compatible"].rows_failed == 1
    extra = by_check(q.check_schema(edges.withColumn("surprise", F.lit(1)), schema, "t"))["schema_columns_present"]
    assert "Extra columns: [" in extra.details and "surprise" in extra.details and extra.rows_failed == 22 - 8
    widened = edges.withColumn("revenue", F.lit(1))
    assert by_check(q.check_schema(widened, schema, "t"))["schema_types_compatible"].passed


def test_threshold_is_compared_before_rounding(spark):
    df = spark.range(1, 100_001).select(F.col("id").alias("x"))
    rule = q.Rule("r", "range", "x", F.count_if(F.col("x") <= 5001), 0.05)
    row = q.evaluate(df, "t", [rule]).first()
    assert row.failure_pct == 0.05 and not row.passed


def test_gate_aborts_above_ten_percent(edges):
    row = q.gate(edges).first()
    assert (row.rows_total, row.rows_clean, row.rows_quarantined, row.abort) == (8, 5, 3, True)
    with pytest.raises(q.GateAborted):
        q.enforce_gate(edges)
    assert q.enforce_gate(edges, QualityLimits(dq_fail_threshold=0.5)) == 5


def test_corrected_rows_come_back(edges):
    parked = q.quarantine(edges, "run_x").select(*edges.columns)
    corrected = parked.withColumn("gross_profit", F.col("revenue") - F.col("cogs"))
    clean, still_out = q.reingest(q.clean_rows(edges), corrected, "run_x")
    assert {r.company for r in still_out.collect()} == {"zero", "null_revenue"}
    assert clean.filter("company = 'off_by_1_01'").first().gross_profit == 600.0


def test_summary_counts_and_names(edges):
    got = {r.scope: r for r in q.summarize(q.evaluate(edges, "t", q.business_rules(edges))).collect()}
    assert got["overall"].summary == "1/4 checks passed"
    assert got["overall"].failed_checks.split(", ") == [
        "t.gross_profit_identity", "t.net_income_sign_consistent", "t.revenue_gt_cogs"
    ]


def test_log_has_the_registered_schema(edges, spark):
    log = q.stamp_log(q.evaluate(edges, "t", q.business_rules(edges)), "run_x")
    log.to(nullable_copy(get_schema("silver_data_quality_log"))).count()
    assert log.columns == get_schema("silver_data_quality_log").fieldNames()
    with pytest.raises(KeyError):
        get_schema("nope")
