"""Plans have to keep the shape that scales."""

import datetime as dt
import re

import pytest
from helpers import full_history
from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc, statements as st
from ledgerline.operators.regression_forecast import forecast_revenue_with_regressors
from ledgerline.params import IngestionWindow
from ledgerline.plans import queries as reg
from ledgerline.sources.financials import monthly_financials, order_totals


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", text)


def test_forecast_chain_shuffles_once_by_company(spark, sf_dir):
    bronze = monthly_financials(spark, sf_dir, "nation")
    before = len(exchanges(plan(bronze)))
    after = exchanges(plan(fc.gold_monthly(bronze, 36)))
    assert len(after) - before == 1 and "SinglePartition" not in after


def test_statements_share_one_shuffle(spark):
    from helpers import years_frame

    assert exchanges(plan(st.three_statements(years_frame(spark)))) == ["hashpartitioning"]


def test_history_to_scenario_statements_in_one_shuffle(spark, sf_dir):
    bronze = monthly_financials(spark, sf_dir, "nation")
    before = len(exchanges(plan(bronze)))
    wide = st.three_statements(fc.scenarios(fc.model_years(bronze, 36)))
    assert len(exchanges(plan(wide))) - before == 1


def test_a_valuation_grid_adds_no_shuffle(spark):
    from ledgerline.operators import valuation as va

    flows = spark.createDataFrame([("a", 2021, 1.0, 1.0)], "company string, year int, fcf double, net_income double")
    assert exchanges(plan(va.dcf_sensitivity(flows))) == ["hashpartitioning"]


def test_silver_reads_lines_once_and_moves_no_company_by_month(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reg.QUERIES["silver_monthly"].build(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "lineitem" not in text and "hashpartitioning(date" not in text and "BroadcastHashJoin" in text


def test_lines_are_reduced_before_the_join(spark, sf_dir):
    text = plan(order_totals(spark, sf_dir))
    assert "partial_sum" in text
    scan = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "l_shipdate" not in scan and "l_partkey" not in scan


def test_the_window_filter_reaches_the_scan(spark, sf_dir):
    text = plan(monthly_financials(spark, sf_dir, "nation", IngestionWindow(dt.date(1996, 1, 1), dt.date(1997, 12, 31))))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


@pytest.mark.parametrize(
    "name", ["silver_monthly", "gold_annual", "scenarios", "dcf_sensitivity", "shock_grid", "resample_month"]
)
def test_no_cross_join_and_no_single_partition_window(spark, sf_dir, name):
    text = plan(reg.QUERIES[name].run(spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text


@pytest.mark.parametrize("name", ["headline_kpis", "scenario_lines", "bi_measures", "combined_years", "margin_fallback"])
def test_history_and_forecast_read_the_lines_once(spark, sf_dir, name):
    rows = reg.QUERIES[name].build(spark, sf_dir)
    rows.collect()
    final = plan(rows).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet .*l_orderkey", final)) == 1


def test_the_regression_has_one_exchange_and_no_python_worker(spark):
    months = full_history(spark, 30).withColumns({c: F.lit(1.0) for c in ("inflation_rate", "interest_rate")})
    text = plan(forecast_revenue_with_regressors(months, 12))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_registry_is_complete():
    assert len(reg.QUERIES) >= 110
    assert [n for n, q in reg.QUERIES.items() if q.oracle() is None] == []
