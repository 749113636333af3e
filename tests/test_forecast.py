import datetime as dt

import numpy as np
import pytest
from helpers import full_history, months
from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc
from ledgerline.operators import regression_forecast as rf
from ledgerline.operators.regression_forecast import forecast_revenue_with_regressors

MADE_ON = dt.date(2023, 1, 1)


def test_trend_and_season_are_recovered(spark):
    season = [1.2, 0.8, 1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.0, 1.0, 1.0, 1.0]
    values = [100.0 * season[i % 12] for i in range(48)]
    rows = fc.forecast_revenue(months(spark, {"a": values}), 12).orderBy("date").collect()
    future = [r for r in rows if r.step > 0]
    assert len(future) == 12 and len(rows) == 60
    for r, s in zip(future, season):
        assert r.revenue_forecast == pytest.approx(100 * s, rel=0.02)
        assert r.revenue_lower <= r.revenue_forecast <= r.revenue_upper
        assert r.revenue_seasonal == pytest.approx(s - 1, abs=0.02)


def test_forecast_of_one_company_ignores_the_others(spark):
    alone = fc.gold_monthly(full_history(spark, 36), 12, MADE_ON).orderBy("date").collect()
    both = fc.gold_monthly(full_history(spark, 36, ("a", "b")), 12, MADE_ON)
    assert both.filter("company = 'a'").orderBy("date").collect() == alone


def test_costs_keep_constant_ratios_and_efficiency_ramps(spark):
    rows = fc.gold_monthly(full_history(spark, 36), 12, MADE_ON).orderBy("date").collect()
    first, last = rows[0], rows[-1]
    assert first.cogs / first.revenue == pytest.approx(0.4, rel=1e-4)
    assert last.cogs / last.revenue == pytest.approx(0.4 * 0.97, rel=1e-4)
    assert last.opex / last.revenue == pytest.approx(0.2 * 0.95, rel=1e-4)
    assert first.interest_expense == 5.0
    assert first.change_in_wc == 0.0 and first.capex < 0
    assert last.cumulative_cash == pytest.approx(sum(r.fcf for r in rows), abs=0.1)
    assert first.fcf == pytest.approx(first.cfo + first.capex, abs=0.02)


def test_one_month_horizon_has_no_ramp(spark):
    row = fc.gold_monthly(full_history(spark, 24), 1, MADE_ON).first()
    assert row.cogs / row.revenue == pytest.approx(0.4, rel=1e-4)


def test_ratio_band_holds_extrapolation(spark):
    history = full_history(spark, 24).withColumn(
        "cogs", F.col("revenue") * (0.2 + 0.02 * F.months_between("date", F.lit("2020-01-01")))
    )
    frame = fc.horizon(fc.ratio_trend(fc.forecast_revenue(history, 6)))
    mean = np.mean([0.2 + 0.02 * i for i in range(24)])
    for r in frame.collect():
        assert r.cogs_ratio_hat == pytest.approx(mean + 0.03)


def test_days_are_means_of_ratios_and_depreciation_a_ratio_of_means(spark):
    rows = [("a", dt.date(2020, 1, 1), 100.0, 10.0, 5.0), ("a", dt.date(2020, 2, 1), 300.0, 60.0, 30.0)]
    df = spark.createDataFrame(
        rows, "company string, date date, revenue double, accounts_receivable double, depreciation double"
    ).withColumns({c: F.lit(1.0) for c in ("cogs", "inventory", "accounts_payable", "capex", "interest_expense")})
    row = fc.history_ratios(df).first()
    assert row.dso_mean == pytest.approx(30 * (0.1 + 0.2) / 2)
    assert row.depr_ratio == pytest.approx(35 / 400)


def test_scenarios_scale_revenue_and_profit_only(spark):
    annual = fc.gold_annual(fc.gold_monthly(full_history(spark, 36), 12, MADE_ON))
    base = annual.first()
    rows = {r.scenario: r for r in fc.scenarios(annual).collect()}
    assert rows["Base"].revenue == base.revenue
    assert rows["Bull"].revenue == pytest.approx(base.revenue * 1.12)
    assert rows["Bear"].gross_profit == pytest.approx(base.revenue * 0.88 * (base.gross_margin - 0.025))
    assert rows["Bull"].fcf == pytest.approx(rows["Bull"].net_income * 0.85)
    assert rows["Bull"].cogs == base.cogs and rows["Bull"].ebitda_margin == base.ebitda_margin
    moved = {r.scenario: r for r in fc.scenarios(annual, adjust_margins=True).collect()}
    assert moved["Bull"].ebitda_margin == pytest.approx(base.ebitda_margin + 0.014)
    assert moved["Bull"].gross_profit == base.gross_profit


def test_one_pass_years_equal_the_two_tables(spark):
    from ledgerline.operators import kpis

    history = full_history(spark, 36, ("a", "b"))
    gold = fc.gold_annual(fc.gold_monthly(history, 12, MADE_ON))
    years = fc.model_years(history, 12).orderBy("company", "year")
    future = years.filter("is_forecast").select(*gold.columns).collect()
    assert future == gold.orderBy("company", "year").collect()
    past = years.filter("not is_forecast").select("company", "year", *kpis.PNL_COLUMNS, "inventory").collect()
    silver = kpis.monthly_kpis(history).withColumns({c: F.lit(1.0) for c in kpis.MACRO_COLUMNS})
    rolled = kpis.annual_rollup(silver).orderBy("company", "year")
    for a, b in zip(past, rolled.select("company", "year", *kpis.PNL_COLUMNS, "inventory").collect()):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_mape_is_zero_on_a_perfect_line(spark):
    row = fc.forecast_mape(months(spark, {"a": [50.0 + i for i in range(36)]})).first()
    assert row.mape < 0.02 and row.n_months == 12


def test_regressor_extension_carries_the_last_value(spark):
    df = months(spark, {"a": [1, None, 3]}, "inflation_rate").withColumn("interest_rate", F.lit(7.0))
    rows = fc.extend_regressors(df, periods=2).orderBy("date").collect()
    assert [r.inflation_rate for r in rows] == [1.0, 2.0, 3.0, 3.0, 3.0]


def test_forecast_vs_actual_keeps_both_sides(spark):
    f = months(spark, {"a": [10, 20]})
    a = months(spark, {"a": [..., 30, 40]})
    rows = fc.forecast_vs_actual(f, a).orderBy("date").collect()
    assert [(r.revenue_forecast, r.revenue_actual, r.variance) for r in rows] == [
        (10.0, None, None), (20.0, 30.0, 10.0), (None, 40.0, None)
    ]


def test_ridge_forecast_follows_the_series_and_is_deterministic(spark):
    history = full_history(spark, 60, ("a", "b")).withColumns(
        {"inflation_rate": F.month("date").cast("double"), "interest_rate": F.lit(7.0)}
    )
    df = forecast_revenue_with_regressors(history, 12)
    rows = df.orderBy("company", "date").collect()
    assert rows == df.orderBy("company", "date").collect()
    assert len(rows) == 2 * 72
    past = [r for r in rows if r.step == 0]
    error = np.mean([abs(r.revenue_forecast / r.revenue - 1) for r in past])
    assert error < 0.03
    assert all(r.revenue_lower < r.revenue_forecast < r.revenue_upper for r in rows)


def plain_regression(rows, periods):
    """Trend, then effects, by dense solves; rows are (revenue or None, inflation, interest) by month from 2020."""
    n = len(rows)
    y = np.array([np.nan if r[0] is None else r[0] for r in rows] + [np.nan] * periods)
    macro = np.array([r[1:] for r in rows] + [rows[-1][1:]] * periods, dtype=float)
    seen = ~np.isnan(y)
    scale = np.nanmax(np.abs(y)) or 1.0
    y = y / scale

    def weights(x, target, penalties):
        stacked = np.vstack([x[seen], np.diag(np.sqrt(penalties))])
        return np.linalg.lstsq(stacked, np.r_[target[seen], np.zeros(len(penalties))], rcond=None)[0]

    t = np.arange(n + periods) / max(n - 1, 1)
    x = np.column_stack([t**0, t, *[np.clip(t - k, 0, None) for k in rf.KNOTS]])
    trend = x @ weights(x, y, rf.TREND_PENALTIES)
    month = np.arange(n + periods) % 12
    waves = [f(2 * np.pi * k * month / 12) for k in range(1, rf.FOURIER_ORDER + 1) for f in (np.sin, np.cos)]
    spread = np.ptp(macro[seen], axis=0)
    units = np.where(spread > 0, macro[seen].std(axis=0), 1.0)
    effects = np.column_stack([*waves, (macro - macro[seen].mean(axis=0)) / units])
    w = weights(effects, y / trend - 1, rf.EFFECT_PENALTIES)
    fit = trend * (1 + effects @ w)
    sigma = np.std((y - fit)[seen], ddof=1)
    return np.column_stack(
        [fit, fit - rf.INTERVAL_Z * sigma, fit + rf.INTERVAL_Z * sigma, trend, effects[:, : len(waves)] @ w[: len(waves)] / scale]
    ) * scale


def test_regression_equals_dense_solves(spark):
    rng = np.random.default_rng(3)
    sizes = {"long": (90, 1e7), "short": (5, 300.0), "two": (2, 1.0), "gaps": (40, 2e4), "flat": (30, 50.0)}
    given = {}
    for name, (n, scale) in sizes.items():
        given[name] = [
            (scale * (2 + i / n + rng.normal() / 9), 2 + rng.normal(), 5.0 if name == "flat" else 5 + rng.normal()) for i in range(n)
        ]
    for i in (3, 4, 17):
        given["gaps"][i] = (None, *given["gaps"][i][1:])
    rows = [(c, dt.date(2020 + i // 12, i % 12 + 1, 1), *v) for c, vs in given.items() for i, v in enumerate(vs)]
    kinds = "company string, date date, revenue double, inflation_rate double, interest_rate double"
    found = forecast_revenue_with_regressors(spark.createDataFrame(rows, kinds), 12).orderBy("company", "date").collect()
    for c, vs in given.items():
        mine = [r for r in found if r.company == c]
        assert [r.step for r in mine] == [0] * len(vs) + list(range(1, 13))
        assert [r.revenue for r in mine] == [v[0] for v in vs] + [None] * 12
        np.testing.assert_allclose([tuple(r)[4:] for r in mine], plain_regression(vs, 12), rtol=1e-5, atol=1e-7)


def test_regression_of_odd_companies(spark):
    kinds = "company string, date date, revenue double, inflation_rate double, interest_rate double, given double, x string"
    first, later = dt.date(2020, 1, 1), dt.date(2020, 4, 1)
    rows = [("one", first, 5.0, 1.0, 1.0, 9.0, "a"), ("none", first, None, 1.0, 1.0, 9.0, "a"), ("none", later, None, None, None, 9.0, "a"),
            ("zero", first, 0.0, None, None, 9.0, "a"), ("zero", later, 0.0, None, None, 9.0, "a")]
    df = forecast_revenue_with_regressors(spark.createDataFrame(rows, kinds), 3)
    found = {c: [r for r in df.collect() if r.company == c] for c in ("one", "none", "zero")}
    assert [len(x) for x in found.values()] == [4, 7, 7]  # months between are filled, three follow
    assert all(r.revenue_forecast is None and r.revenue_seasonal is None for c in ("one", "none") for r in found[c])
    assert all(abs(r.revenue_forecast) < 1e-9 for r in found["zero"])
    assert forecast_revenue_with_regressors(spark.createDataFrame([], kinds), 3).count() == 0
