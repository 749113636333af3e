import pytest

from ledgerline.operators import reporting, valuation as va

FCF = [1_000_000.0, 1_200_000.0, 1_400_000.0]


def expected(fcf, w, g, net_debt=0.0):
    n = len(fcf)
    pv = sum(f / (1 + w) ** t for t, f in enumerate(fcf, 1))
    tv = fcf[-1] * (1 + g) / (w - g)
    ev = pv + tv / (1 + w) ** n
    return pv, tv, ev, ev - net_debt


@pytest.fixture(scope="module")
def flows(spark):
    rows = [("a", 2021 + i, f, None, f * 10, f * 2, 0.2, 0.1) for i, f in enumerate(FCF)]
    rows += [("b", 2021, None, 1000.0, 1e4, 2e3, 0.2, 0.1)]
    return spark.createDataFrame(
        rows[::-1],
        "company string, year int, fcf double, net_income double, revenue double, ebitda double, "
        "ebitda_margin double, net_margin double",
    )


def of(df, company="a"):
    return df.filter(f"company = '{company}'").first()


def test_dcf_matches_the_formula(flows):
    row = of(va.dcf(flows, net_debt=500_000.0, shares=2e6))
    pv, tv, ev, eq = expected(FCF, 0.12, 0.025, 500_000.0)
    assert row.pv_fcf == pytest.approx(pv) and row.terminal_value == pytest.approx(tv)
    assert row.enterprise_value == pytest.approx(ev) and row.equity_value == pytest.approx(eq)
    assert row.value_per_share == pytest.approx(eq / 2e6)
    assert row.pv_fcf_pct + row.pv_tv_pct == pytest.approx(1)
    assert 0.50 <= row.pv_tv_pct <= 0.95


def test_missing_fcf_falls_back_to_net_income(flows):
    assert of(va.dcf(flows), "b").enterprise_value == pytest.approx(expected([850.0], 0.12, 0.025)[2])


def test_monotonic_in_rates(flows):
    def ev(w, g):
        return of(va.dcf(flows, w, g)).enterprise_value

    assert ev(0.10, 0.025) > ev(0.15, 0.025) > 0
    assert ev(0.12, 0.035) > ev(0.12, 0.015)


def test_growth_at_or_above_the_discount_rate_is_undefined(flows):
    assert of(va.dcf(flows, 0.02, 0.02)).enterprise_value is None


def test_sensitivity_grid(flows):
    rows = va.dcf_sensitivity(flows).filter("company = 'a'").collect()
    assert len(rows) == 8 * 5
    cell = {(r.wacc_pct, r.growth_pct): r.equity_value_m for r in rows}
    assert cell[22, 5] == pytest.approx(expected(FCF, 0.22, 0.05)[2] / 1e6)
    low = va.dcf_sensitivity(flows, (2, 6, 2)).filter("company = 'a' and wacc_pct <= growth_pct")
    assert low.count() == 6 and low.filter("equity_value_m is not null").count() == 0


def test_schedule(flows):
    rows = va.dcf_schedule(flows).filter("company = 'a'").orderBy("year").collect()
    assert [r.t for r in rows] == [1, 2, 3]
    assert rows[2].discount_factor == pytest.approx(1.12**-3)
    assert sum(r.pv_fcf for r in rows) == pytest.approx(expected(FCF, 0.12, 0.025)[0])


def test_shocks(flows):
    rows = va.shock(flows.filter("company = 'a'"), [(0, 0), (0.1, -0.05)]).orderBy("year").collect()
    quiet = [r for r in rows if r.revenue_shock == 0]
    moved = [r for r in rows if r.revenue_shock > 0]
    assert [r.fcf for r in quiet] == FCF
    assert moved[0].revenue == pytest.approx(1.1e7)
    assert moved[0].ebitda == pytest.approx(1.1e7 * 0.15)
    assert moved[0].net_income == pytest.approx(1.1e7 * (0.1 - 0.03))
    assert moved[0].fcf == pytest.approx(moved[0].net_income * 0.85)


def test_a_stress_grid_values_every_shock(flows):
    df = va.dcf(va.shock(flows.filter("company = 'a'"), [(0, 0), (0.1, 0), (-0.1, 0)]))
    assert df.count() == 3


def test_bridge_ends_at_enterprise_value(flows):
    row = of(va.dcf(flows))
    rows = reporting.value_bridge(va.dcf(flows)).filter("company = 'a'").orderBy("step_no").collect()
    assert rows[-1].bar_end == pytest.approx(row.enterprise_value)
