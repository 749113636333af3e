import numpy as np
import pytest
from helpers import INCOME, years_frame
from pyspark.sql import functions as F

from ledgerline.operators import reporting, statements as st


def test_net_ppe_closed_form_equals_the_recurrence(spark):
    rng = np.random.default_rng(11)
    frames, want = [], {}
    for c in map(str, range(20)):
        n = int(rng.integers(2, 12))
        capex, depr = rng.uniform(-50, 50, n), rng.uniform(0, 120, n)
        x = [4 * capex[0]]
        for i in range(1, n):
            x.append(max(x[-1] + abs(capex[i]) - depr[i], 0))
        want[c] = x
        frames += [(c, 2000 + i, i > 0, float(capex[i]), float(depr[i])) for i in range(n)]
    df = spark.createDataFrame(
        frames, "company string, year int, is_forecast boolean, capex double, depreciation double"
    )
    got = {}
    for r in st.net_ppe(df).orderBy("company", "year").collect():
        got.setdefault(r.company, []).append(r.net_ppe)
    for c in want:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9)


@pytest.fixture(scope="module")
def sheets(spark):
    return st.three_statements(years_frame(spark)).orderBy("year").collect()


def test_income_ratios(sheets):
    assert [r.period_type for r in sheets] == ["Historical", "Historical", "Forecast (Base)"]
    assert sheets[0].gross_margin == pytest.approx(0.56) and sheets[0].revenue_growth is None
    assert sheets[1].revenue_growth == pytest.approx(712 / 640 - 1)
    assert all(abs(r.tax_rate - 0.28) < 0.01 for r in sheets)


def test_schedules(sheets):
    debt0 = sum(INCOME["interest_expense"][:2]) / 2 / 0.07 * 12
    kept = np.cumsum(INCOME["net_income"]) * 0.7
    for i, r in enumerate(sheets):
        assert r.long_term_debt == pytest.approx(debt0 * 0.95**i)
        assert r.retained_earnings == pytest.approx(kept[i])
        assert r.paid_in_capital == pytest.approx(0.3 * INCOME["revenue"][0])
    assert sheets[0].net_ppe == 4 * INCOME["capex"][0]
    assert sheets[2].net_ppe == pytest.approx(4 * INCOME["capex"][0] + sum(INCOME["capex"][1:]) - sum(INCOME["depreciation"][1:]))


def test_balance_sheet_identities(sheets):
    for r in sheets:
        assert r.bs_balance_check < 1e-3
        assert r.total_assets == pytest.approx(r.current_assets + r.net_ppe)
        assert r.current_assets == pytest.approx(r.cash + r.accounts_receivable + r.inventory)
        assert r.cash >= 0


def test_cash_flow_links(sheets):
    first, second = sheets[0], sheets[1]
    assert (first.cfo_d_ar, first.cfo_d_inv, first.cfo_d_ap, first.debt_change) == (0, 0, 0, 0)
    grown = {c: v[1] - v[0] for c, v in INCOME.items()}
    profit, written_off = INCOME["net_income"][1], INCOME["depreciation"][1]
    tied_up = grown["accounts_receivable"] + grown["inventory"] - grown["accounts_payable"]
    assert second.cfo == pytest.approx(profit + written_off - tied_up)
    assert second.cfi == pytest.approx(-INCOME["capex"][1])
    assert second.cff == pytest.approx(second.debt_change - 0.3 * profit)
    for r in sheets:
        assert r.net_cash_change == pytest.approx(r.cfo + r.cfi + r.cff)
        assert r.closing_cash == r.cash
    for r in sheets[1:]:  # the opening year never reconciles
        assert r.cf_reconciliation == pytest.approx(0, abs=1e-3)


def test_joined_statements_equal_the_wide_ones(spark, sheets):
    years = years_frame(spark)
    income, balance = st.income_statement(years), st.balance_sheet(years)
    joined = st.cash_flow_statement(income, balance).orderBy("year").collect()
    for c in ("cfo", "cfi", "cff", "net_cash_change", "closing_cash", "cf_reconciliation"):
        assert [r[c] for r in joined] == [r[c] for r in sheets]


def test_checks_pass_on_consistent_statements(spark):
    wide = st.three_statements(years_frame(spark))
    assert all(r.passed for r in st.three_statement_checks(wide).collect())
    failed = {r.check_name for r in st.statement_identities(wide).collect() if not r.passed}
    # the implied debt of the first years is larger than the assets it funds leave room for
    assert failed <= {"debt_below_assets"}


def test_a_floored_plug_shows_in_the_balance_check(spark):
    wide = st.three_statements(
        years_frame(spark, overrides={"accounts_receivable": [9e8, 9e8, 9e8]})
    )
    assert all(r.cash == 0 and r.bs_balance_check > 0 for r in wide.collect())
    got = {r.check_name: r.passed for r in st.three_statement_checks(wide).collect()}
    assert got["balance_sheet_balances"] is False and got["ebitda_consistency"] is True


def test_broken_ebitda_is_reported(spark):
    wide = st.three_statements(years_frame(spark, overrides={"ebitda": [1.0, 2.0, 3.0]}))
    got = {r.check_name: r.passed for r in st.three_statement_checks(wide).collect()}
    assert got["ebitda_consistency"] is False


def test_unknown_balances_stay_unknown(spark):
    years = years_frame(spark).withColumn(
        "accounts_receivable", F.when(F.col("year") != 2017, F.col("accounts_receivable"))
    )
    row = {r.year: r for r in st.balance_sheet(years).collect()}[2017]
    assert row.cash is None and row.total_assets is None


def test_reconciliation_separates_the_opening_year(spark):
    row = st.cash_reconciliation(st.three_statements(years_frame(spark))).first()
    assert row.opening_error > 0 and row.mean_error_after_opening < 1e-3
    assert row.mean_error == pytest.approx(row.opening_error / 3, abs=1e-3)


def test_scenario_series_repeat_history(spark):
    years = years_frame(spark)
    hist = years.filter("not is_forecast").drop("is_forecast")
    future = years.filter("is_forecast").drop("is_forecast")
    cases = future.withColumn("scenario", F.explode(F.array(F.lit("Base"), F.lit("Bull"))))
    both = st.combine_scenario_years(hist, cases, ("Base", "Bull"))
    income = st.income_statement(both).orderBy("scenario", "year").collect()
    assert len(income) == 6
    assert income[5].period_type == "Forecast (Bull)"
    assert income[5].revenue_growth == pytest.approx(INCOME["revenue"][2] / INCOME["revenue"][1] - 1)


def test_serving_variant(spark):
    years = years_frame(spark).withColumn("inventory", F.lit(None).cast("double"))
    rows = st.cash_flow_serving(years).orderBy("year").collect()
    assert rows[0].inventory == pytest.approx(0.08 * INCOME["revenue"][0]) and rows[0].net_ppe == 0.4 * INCOME["revenue"][0]
    assert rows[0].paid_in_capital == 0.25 * INCOME["revenue"][0]
    assert rows[1].cfi == -INCOME["capex"][1]
    assert rows[2].cumulative_cash == pytest.approx(sum(r.net_cash_change for r in rows))
    assert rows[0].long_term_debt == pytest.approx(sum(INCOME["interest_expense"]) / 3 / 0.07 * 12)


def test_report_layout(spark):
    wide = st.three_statements(years_frame(spark))
    rows = reporting.statement_report(wide, [2016, 2017, 2018]).collect()
    count = {s: sum(r.statement == s for r in rows) for s in ("income_statement", "balance_sheet", "cash_flow")}
    assert count == {"income_statement": 18, "balance_sheet": 16, "cash_flow": 19}
    by_line = {(r.statement, r.line_no): r for r in rows}
    assert by_line["income_statement", 1].y2017 == INCOME["revenue"][1]
    assert by_line["income_statement", 4].y2016 == 0.56
    assert by_line["balance_sheet", 1].y2016 is None and by_line["balance_sheet", 1].kind == "section"


def test_waterfall_and_bridge(spark):
    wide = st.three_statements(years_frame(spark))
    rows = reporting.cash_waterfall(wide).orderBy("step_no").collect()
    assert [r.label for r in rows] == ["CFO", "CFI", "CFF", "Net Change"]
    assert rows[1].bar_start == rows[0].bar_end and rows[3].amount == rows[2].bar_end
    assert {r.year for r in rows} == {2018}


def test_asset_shares_sum_to_one(spark):
    df = reporting.asset_composition(st.balance_sheet(years_frame(spark)))
    for r in df.groupBy("year").agg(F.sum("share").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_labels(spark):
    df = spark.createDataFrame(
        [(1_234_567.0, 0.1234), (12_345.0, None), (None, 0.5)], "x double, p double"
    )
    rows = reporting.with_labels(df, ["x"], ["p"]).collect()
    assert [r.x_label for r in rows] == ["R 1M", "R 12,345", "—"]
    assert [r.p_label for r in rows] == ["12.3%", "—", "50.0%"]


def test_a_year_with_actual_and_forecast_rows(spark):
    years = years_frame(spark, overrides={"year": [2016, 2017, 2017]})
    wide = st.three_statements(years)
    rows = wide.orderBy("year", "is_forecast").collect()
    assert len(rows) == 3 and rows[2].revenue_growth == pytest.approx(INCOME["revenue"][2] / INCOME["revenue"][1] - 1)
    joined = st.cash_flow_statement(st.income_statement(years), st.balance_sheet(years))
    assert joined.count() == 3
    first = {r.line_no: r for r in reporting.statement_report(wide, [2016, 2017]).filter(
        "statement = 'income_statement'").collect()}
    assert first[1].y2017 == INCOME["revenue"][2]


def test_an_unknown_balance_fails_its_checks(spark):
    wide = st.three_statements(years_frame(spark))
    unknown = wide.withColumn("bs_balance_check", F.lit(None).cast("double"))
    passed = {r.check_name: r.passed for r in st.three_statement_checks(unknown).collect()}
    assert passed == {"balance_sheet_balances": False, "net_income_to_retained_earnings": True,
                      "all_revenues_positive": True, "ebitda_consistency": True}
    one = wide.withColumn("cash", F.when(F.col("year") != 2017, F.col("cash")))
    passed = {r.check_name: r.passed for r in st.statement_identities(one).collect()}
    assert not passed["cash_not_negative"] and not passed["current_assets_add_up"]
    assert passed["equity_grows"] and passed["depreciation_agrees"]


def test_a_single_year_has_no_step_to_check(spark):
    wide = st.three_statements(years_frame(spark).filter("year = 2016"))
    assert all(r.passed for r in st.three_statement_checks(wide).collect() if r.check_name != "balance_sheet_balances")
    assert {r.passed for r in st.statement_identities(wide).collect() if r.check_name == "equity_grows"} == {True}


def test_the_report_prints_liabilities_plus_equity(spark):
    wide = st.three_statements(years_frame(spark)).withColumn("total_assets", F.lit(1.0))
    rows = reporting.statement_report(wide).filter("label = 'Total L + E'").collect()
    sheet = {r.year: r for r in st.balance_sheet(years_frame(spark)).collect()}
    assert rows[0].y2017 == pytest.approx(sheet[2017].total_liabilities + sheet[2017].total_equity, abs=1)


def test_no_year_is_left_out_of_a_report(spark):
    wide = st.three_statements(years_frame(spark))
    with pytest.raises(ValueError):
        reporting.statement_report(wide, [2016, 2017])
    assert "y2018" in reporting.statement_report(wide).columns
