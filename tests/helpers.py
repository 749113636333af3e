"""Small hand-made inputs."""

import datetime as dt

from ledgerline.operators.kpis import PNL_COLUMNS

D = dt.date


def month(i: int, start: int = 2020) -> dt.date:
    return D(start + i // 12, i % 12 + 1, 1)


def months(spark, values: dict[str, list], name: str = "revenue", start: int = 2020):
    """Rows (company, date, name); a value of ... leaves the month out."""
    rows = [
        (c, month(i, start), None if v is None else float(v))
        for c, vs in values.items()
        for i, v in enumerate(vs)
        if v is not ...
    ]
    return spark.createDataFrame(rows, f"company string, date date, {name} double")


def full_history(spark, n: int = 36, companies=("a",), scale: float = 1.0):
    """A smooth, seasonal history with every financial column."""
    rows = []
    for k, c in enumerate(companies):
        for i in range(n):
            rev = scale * (1000.0 + 10 * i) * (1 + 0.1 * ((i % 12) - 5.5) / 5.5) * (k + 1)
            rows.append(
                (c, month(i), rev, rev * 0.4, rev * 0.6, rev * 0.2, rev * 0.1, rev * 0.1, rev * 0.2,
                 rev * 0.03, rev * 0.17, 5.0, rev * 0.17 - 5, (rev * 0.17 - 5) * 0.28,
                 (rev * 0.17 - 5) * 0.72, rev * 0.5, rev * 0.2, rev * 0.1, rev * 0.05, 10, rev / 10, 0.02)
            )
    return spark.createDataFrame(
        rows,
        "company string, date date, " + ", ".join(f"{c} double" for c in PNL_COLUMNS)
        + ", accounts_receivable double, inventory double, accounts_payable double, capex double, "
        "customers bigint, avg_revenue_per_user double, churn_rate double",
    )


def _income(year: int, revenue: int, rates: dict[str, float], interest: int) -> dict[str, float]:
    """One year of lines from revenue: costs as shares of it, profits by calculation."""
    row = {"year": year, "revenue": revenue} | {c: round(revenue * r) for c, r in rates.items()}
    row["gross_profit"] = revenue - row["cogs"]
    row["ebitda"] = row["gross_profit"] - row["opex"] - row["rd_expense"] - row["sga_expense"]
    row["ebit"] = row["ebitda"] - row["depreciation"]
    row["interest_expense"] = interest
    row["ebt"] = row["ebit"] - interest
    row["tax_expense"] = round(0.28 * row["ebt"])
    row["net_income"] = row["ebt"] - row["tax_expense"]
    return row


_RATES = {
    "cogs": 0.44, "opex": 0.17, "rd_expense": 0.05, "sga_expense": 0.09, "depreciation": 0.035,
    "capex": 0.052, "accounts_receivable": 0.13, "inventory": 0.075, "accounts_payable": 0.055,
}
_YEARS = [_income(2016, 6_400_000, _RATES, 96_000), _income(2017, 7_120_000, _RATES, 91_000),
          _income(2018, 8_250_000, _RATES, 87_000)]
# Three consistent years, own figures.
INCOME = {c: [y[c] for y in _YEARS] for c in _YEARS[0]}


def years_frame(spark, company="a", n_hist=2, overrides=None):
    data = INCOME | (overrides or {})
    names = [c for c in data if c != "year"]
    rows = [
        (company, y, i >= n_hist, *[float(data[c][i]) for c in names])
        for i, y in enumerate(data["year"])
    ]
    return spark.createDataFrame(
        rows, "company string, year int, is_forecast boolean, " + ", ".join(f"{c} double" for c in names)
    )
