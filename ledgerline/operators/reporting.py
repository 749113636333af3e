"""Report layouts and the queries behind dashboards and BI measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    inline_rows, line_item_amount, literal, money_label, percent_label, ratio,
)
from ledgerline.params import SCENARIOS, ModelAssumptions

MODEL = ModelAssumptions()

# Report lines in print order as (label, column, kind). A section or
# blank line has no column; "total" marks subtotal rows, "pct" percentage rows.
INCOME_LINES = (
    ("Revenue", "revenue", "money"),
    ("Cost of Goods Sold", "cogs", "money"),
    ("Gross Profit", "gross_profit", "total"),
    ("Gross Margin %", "gross_margin", "pct"),
    ("", None, "blank"),
    ("Operating Expenses", "opex", "money"),
    ("R&D Expense", "rd_expense", "money"),
    ("SG&A Expense", "sga_expense", "money"),
    ("EBITDA", "ebitda", "total"),
    ("EBITDA Margin %", "ebitda_margin", "pct"),
    ("", None, "blank"),
    ("Depreciation & Amort", "depreciation", "money"),
    ("EBIT", "ebit", "total"),
    ("Interest Expense", "interest_expense", "money"),
    ("EBT", "ebt", "money"),
    ("Tax Expense", "tax_expense", "money"),
    ("Net Income", "net_income", "total"),
    ("Net Margin %", "net_margin", "pct"),
)
BALANCE_LINES = (
    ("ASSETS", None, "section"),
    ("Cash & Equivalents", "cash", "money"),
    ("Accounts Receivable", "accounts_receivable", "money"),
    ("Inventory", "inventory", "money"),
    ("Total Current Assets", "current_assets", "total"),
    ("Net PP&E", "net_ppe", "money"),
    ("Total Assets", "total_assets", "total"),
    ("", None, "blank"),
    ("LIABILITIES & EQUITY", None, "section"),
    ("Accounts Payable", "accounts_payable", "money"),
    ("Long-term Debt", "long_term_debt", "money"),
    ("Total Liabilities", "total_liabilities", "total"),
    ("Paid-in Capital", "paid_in_capital", "money"),
    ("Retained Earnings", "retained_earnings", "money"),
    ("Total Equity", "total_equity", "total"),
    ("Total L + E", "total_liabilities + total_equity", "total"),
)
CASH_FLOW_LINES = (
    ("OPERATING ACTIVITIES", None, "section"),
    ("Net Income", "cfo_net_income", "money"),
    ("Add: Depreciation & Amort", "cfo_dna", "money"),
    ("Change in Accounts Receivable", "cfo_d_ar", "money"),
    ("Change in Inventory", "cfo_d_inv", "money"),
    ("Change in Accounts Payable", "cfo_d_ap", "money"),
    ("Cash from Operations (CFO)", "cfo", "total"),
    ("", None, "blank"),
    ("INVESTING ACTIVITIES", None, "section"),
    ("Capital Expenditures", "cfi", "money"),
    ("Cash from Investing (CFI)", "cfi", "total"),
    ("", None, "blank"),
    ("FINANCING ACTIVITIES", None, "section"),
    ("Debt Issuance / (Repayment)", "debt_change", "money"),
    ("Dividends Paid", "dividends", "money"),
    ("Cash from Financing (CFF)", "cff", "total"),
    ("", None, "blank"),
    ("Net Change in Cash", "net_cash_change", "total"),
    ("Closing Cash Balance", "closing_cash", "total"),
)
STATEMENTS = (
    ("income_statement", INCOME_LINES),
    ("balance_sheet", BALANCE_LINES),
    ("cash_flow", CASH_FLOW_LINES),
)
# Scenario matrix rows as (label, column, kind).
SCENARIO_METRICS = (
    ("Revenue", "revenue", "money"),
    ("Gross Profit", "gross_profit", "money"),
    ("EBITDA", "ebitda", "money"),
    ("EBITDA Margin", "ebitda_margin", "pct"),
    ("Net Income", "net_income", "money"),
    ("Net Margin", "net_margin", "pct"),
    ("Free Cash Flow", "fcf", "money"),
)


def display_value(column: str | None, kind: str) -> str:
    """SQL for a printed cell: money to whole units, percentages to 4 places, null kept.

    Rounding to 6 places first drops binary noise, so that an exact half always
    rounds the same way.
    """
    if column is None:
        return "CAST(NULL AS DOUBLE)"
    return f"ROUND(ROUND({column}, 6), {4 if kind == 'pct' else 0})"


def statement_report(statements: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Printed layout: one row per company, statement and line, one column per year.

    Lines are exploded from each year's row and pivoted over the years of the data, found
    by one distinct (as many rows as years), or over a given list, which may not leave a
    year out.
    """
    years = _covering(statements, years)
    lines = inline_rows(
        [
            {
                "statement": literal(name),
                "line_no": literal(no),
                "label": literal(label),
                "kind": literal(kind),
                "value": display_value(column, kind),
            }
            for name, layout in STATEMENTS
            for no, (label, column, kind) in enumerate(layout, 1)
        ]
    )
    group = ["company"] + (["scenario"] if "scenario" in statements.columns else [])
    pivoted = (
        statements.select(*group, "year", "is_forecast", lines)
        .groupBy(*group, "statement", "line_no", "label", "kind")
        .pivot("year", years)
        # a year with an actual and a forecast row shows the later one
        .agg(F.max_by("value", "is_forecast"))
    )
    return pivoted.selectExpr(
        *group, "statement", "line_no", "label", "kind", *[f"`{y}` AS y{y}" for y in years]
    )


def _covering(rows: DataFrame, years: list[int] | None) -> list[int]:
    found = {r["year"] for r in rows.select("year").distinct().collect()} - {None}
    if years is None:
        return sorted(found)
    if missed := sorted(found - set(years)):
        raise ValueError(f"years without a column: {missed}")
    return years


def scenario_matrix(
    scenario_rows: DataFrame, years: list[int] | None = None, names: tuple[str, ...] = tuple(
        s.name for s in SCENARIOS
    )
) -> DataFrame:
    """Metrics by (scenario, year) columns; years are those of the data unless given."""
    years = _covering(scenario_rows, years)
    cells = inline_rows(
        [
            {"line_no": literal(no), "metric": literal(label), "value": display_value(column, kind)}
            for no, (label, column, kind) in enumerate(SCENARIO_METRICS, 1)
        ]
    )
    heads = [f"{s}_{y}" for s in names for y in years]
    return (
        scenario_rows.select("company", F.concat_ws("_", "scenario", "year").alias("_head"), cells)
        .groupBy("company", "line_no", "metric")
        .pivot("_head", heads)
        .agg(F.first("value"))
    )


def headline_kpis(historical: DataFrame, forecast: DataFrame) -> DataFrame:
    """Last historical year against the last forecast year of a scenario."""
    last_hist = historical.groupBy("company").agg(
        F.max_by("revenue", "year").alias("last_revenue"),
        F.max_by("net_income", "year").alias("_last_net_income"),
    )
    group = ["company"] + (["scenario"] if "scenario" in forecast.columns else [])
    last_fcast = forecast.groupBy(*group).agg(
        F.max_by("revenue", "year").alias("forecast_revenue"),
        F.max_by("net_income", "year").alias("_net_income"),
        F.max_by("gross_margin", "year").alias("forecast_gross_margin"),
        F.max_by("ebitda_margin", "year").alias("forecast_ebitda_margin"),
        F.max_by(
            F.coalesce(F.col("fcf"), F.col("net_income") * MODEL.fcf_conversion), "year"
        ).alias("forecast_fcf"),
    )
    return last_fcast.join(last_hist, "company").select(
        *group,
        "last_revenue",
        "forecast_revenue",
        ratio(F.col("forecast_revenue") - F.col("last_revenue"), "last_revenue").alias(
            "revenue_growth"
        ),
        ratio(F.col("_net_income") - F.col("_last_net_income"), "_last_net_income").alias(
            "net_income_growth"
        ),
        "forecast_gross_margin",
        "forecast_ebitda_margin",
        "forecast_fcf",
    )


def scenario_totals(scenario_rows: DataFrame) -> DataFrame:
    margin = F.coalesce(F.col("ebitda_margin"), ratio("ebitda", "revenue"))
    fcf = F.coalesce(F.col("fcf"), F.col("net_income") * MODEL.fcf_conversion)
    return scenario_rows.groupBy("company", "scenario").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("net_income").alias("total_net_income"),
        F.sum(fcf).alias("total_fcf"),
        F.avg(margin).alias("avg_ebitda_margin"),
    )


def margin_fallback(years: DataFrame) -> DataFrame:
    """Margin columns where the table has them, else computed from amounts."""
    out = years
    for name, numerator in (
        ("gross_margin", "gross_profit"),
        ("ebitda_margin", "ebitda"),
        ("net_margin", "net_income"),
    ):
        stored = [F.col(c) for c in (name, f"{name}_avg") if c in years.columns]
        out = out.withColumn(name, F.coalesce(*stored, ratio(numerator, "revenue")))
    return out


def margin_progression(years: DataFrame) -> DataFrame:
    """Three margins per year in percent, one row per margin."""
    points = F.array(
        *[
            F.struct(F.lit(label).alias("margin"), (F.col(c) * 100).alias("pct"))
            for label, c in (
                ("Gross Margin", "gross_margin"),
                ("EBITDA Margin", "ebitda_margin"),
                ("Net Margin", "net_margin"),
            )
        ]
    )
    return margin_fallback(years).select("company", "year", "period_type", F.inline(points))


def revenue_band(monthly: DataFrame) -> DataFrame:
    """Forecast revenue with its interval, one row per month and bound."""
    return monthly.select(
        "company", "date", "revenue", "revenue_lower", "revenue_upper"
    ).unpivot(
        ["company", "date"], ["revenue", "revenue_lower", "revenue_upper"], "series", "value"
    )


def _bridge(rows: DataFrame, group: list[str], parts: list[tuple[str, str]], total: str) -> DataFrame:
    """Waterfall rows: each part starts where the previous one ended, then the total."""
    structs, before = [], F.lit(0.0)
    for no, (label, c) in enumerate(parts, 1):
        after = before + F.col(c)
        structs.append((no, label, "relative", F.col(c), before, after))
        before = after
    structs.append((len(parts) + 1, total, "total", before, F.lit(0.0), before))
    cells = F.array(
        *[
            F.struct(
                F.lit(no).alias("step_no"),
                F.lit(label).alias("label"),
                F.lit(measure).alias("measure"),
                amount.alias("amount"),
                start.alias("bar_start"),
                end.alias("bar_end"),
            )
            for no, label, measure, amount, start, end in structs
        ]
    )
    return rows.select(*group, F.inline(cells))


def cash_waterfall(cash: DataFrame) -> DataFrame:
    """CFO, CFI, CFF and net change of each company's latest year."""
    group = ["company"] + (["scenario"] if "scenario" in cash.columns else [])
    period = F.struct("year", "is_forecast")
    latest = cash.groupBy(*group).agg(
        F.max("year").alias("year"),
        *[F.max_by(c, period).alias(c) for c in ("cfo", "cfi", "cff")],
    )
    return _bridge(
        latest, [*group, "year"], [("CFO", "cfo"), ("CFI", "cfi"), ("CFF", "cff")], "Net Change"
    )


def value_bridge(valuation: DataFrame) -> DataFrame:
    """Present value of cash flows plus terminal value up to enterprise value."""
    group = [c for c in ("company", "scenario", "shock") if c in valuation.columns]
    return _bridge(
        valuation,
        group,
        [("PV of FCFs", "pv_fcf"), ("PV of Terminal Value", "pv_terminal")],
        "Enterprise Value",
    )


def scenario_lines(historical: DataFrame, scenario_rows: DataFrame) -> DataFrame:
    """Yearly revenue as chart lines: one per scenario plus the history."""
    past = historical.select("company", F.lit("Historical").alias("series"), "year", "revenue")
    return scenario_rows.select(
        "company", F.col("scenario").alias("series"), "year", "revenue"
    ).unionByName(past)


def asset_composition(balance: DataFrame) -> DataFrame:
    """Assets of each year by class, with the share of the total (null if a class is unknown)."""
    classes = (
        ("Cash", "cash"), ("AR", "accounts_receivable"),
        ("Inventory", "inventory"), ("Net PP&E", "net_ppe"),
    )
    total = reduce(lambda x, y: x + y, [F.col(c) for _, c in classes])
    parts = F.array(
        *[
            F.struct(
                F.lit(label).alias("asset_class"),
                F.col(c).alias("amount"),
                ratio(F.col(c), total).alias("share"),
            )
            for label, c in classes
        ]
    )
    return balance.select("company", "year", F.inline(parts))


def customers_arpu(annual: DataFrame) -> DataFrame:
    return annual.select("company", "year", "customers_eoy", "arpu")


def with_labels(
    df: DataFrame, money: list[str], percent: list[str], cells: list[str] | None = None
) -> DataFrame:
    """Display text next to the numeric columns; ``cells`` get the wide statement form."""
    return df.withColumns(
        {
            **{f"{c}_label": money_label(c) for c in money},
            **{f"{c}_label": percent_label(c) for c in percent},
            **{f"{c}_cell": line_item_amount(c) for c in cells or []},
        }
    )


def bi_measures(historical: DataFrame, scenario_rows: DataFrame) -> DataFrame:
    """Card measures per company; a zero denominator gives null."""
    base = F.col("scenario") == "Base"

    def of_base(c: str) -> Column:
        return F.when(base, F.col(c))

    fcast = scenario_rows.groupBy("company").agg(
        F.max(of_base("revenue")).alias("latest_revenue"),
        ratio(F.sum(of_base("ebitda")), F.sum(of_base("revenue"))).alias("ebitda_margin_pct"),
        F.sum(of_base("fcf")).alias("fcf_base"),
    )
    hist = historical.groupBy("company").agg(F.max("revenue").alias("_hist"))
    return fcast.join(hist, "company", "left").select(
        "company",
        "latest_revenue",
        ratio(F.col("latest_revenue") - F.col("_hist"), "_hist").alias("revenue_growth_pct"),
        "ebitda_margin_pct",
        "fcf_base",
    )


def bi_model_join(historical: DataFrame, forecast: DataFrame, scenario_rows: DataFrame) -> DataFrame:
    """The BI relationships: forecast 1:1 to history and 1:n to scenarios, on company and year."""
    keys = ["company", "year"]
    hist = historical.select(*keys, F.col("revenue").alias("historical_revenue"))
    fcast = forecast.select(*keys, F.col("revenue").alias("forecast_revenue"))
    cases = scenario_rows.select(*keys, "scenario", F.col("revenue").alias("scenario_revenue"))
    return fcast.join(hist, keys, "left").join(cases, keys, "left")


def scenario_slice(scenario_rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Five metrics per scenario and year, optionally for chosen scenarios."""
    rows = scenario_rows if names is None else scenario_rows.filter(F.col("scenario").isin(names))
    return rows.groupBy("company", "scenario", "year").agg(
        *[F.sum(c).alias(c) for c in ("revenue", "ebitda", "net_income", "fcf")]
    )


