"""KPI enrichment of clean monthly financials and the annual roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import by_date, growth, ratio
from ledgerline.operators.timeseries import complete_months
from ledgerline.params import SCHEMA_VERSIONS, QualityLimits
from ledgerline.schemas import get_schema

MACRO_COLUMNS = ("inflation_rate", "interest_rate", "gdp_growth", "usd_zar", "unemployment")
# The income lines in statement order.
PNL_COLUMNS = (
    "revenue", "cogs", "gross_profit", "opex", "rd_expense", "sga_expense", "ebitda",
    "depreciation", "ebit", "interest_expense", "ebt", "tax_expense", "net_income",
)


def margins(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "gross_margin": ratio("gross_profit", "revenue"),
            "ebitda_margin": ratio("ebitda", "revenue"),
            "ebit_margin": ratio("ebit", "revenue"),
            "net_margin": ratio("net_income", "revenue"),
        }
    )


def cost_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "cogs_ratio": ratio("cogs", "revenue"),
            "opex_ratio": ratio("opex", "revenue"),
            "rd_ratio": ratio("rd_expense", "revenue"),
            "sga_ratio": ratio("sga_expense", "revenue"),
        }
    )


def working_capital(df: DataFrame) -> DataFrame:
    ar, inv, ap = (F.col(c) for c in ("accounts_receivable", "inventory", "accounts_payable"))
    return df.withColumns(
        {
            "working_capital": ar + inv - ap,
            "dso": ratio(ar, "revenue") * 30,
            "dio": ratio(inv, "cogs") * 30,
            "dpo": ratio(ap, "cogs") * 30,
        }
    ).withColumn("cash_conversion_cycle", F.col("dso") + F.col("dio") - F.col("dpo"))


def unit_economics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "revenue_per_customer": ratio("revenue", "customers"),
            "gross_profit_per_customer": ratio("gross_profit", "customers"),
        }
    )


def revenue_mom(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue_mom", growth("revenue", F.lag("revenue", 1).over(by_date())))


def yearly_growth(df: DataFrame) -> DataFrame:
    """Year-over-year revenue and net income: 12 rows back on a complete calendar."""
    return df.withColumns(
        {
            "revenue_yoy": growth("revenue", F.lag("revenue", 12).over(by_date())),
            "net_income_yoy": growth("net_income", F.lag("net_income", 12).over(by_date())),
        }
    )


def trailing_revenue(df: DataFrame) -> DataFrame:
    """Trailing-12-month revenue; shorter frames at the start are kept."""
    frame = by_date().rowsBetween(-11, Window.currentRow)
    return df.withColumn("revenue_ttm", F.sum("revenue").over(frame))


def join_macro(df: DataFrame, macro: DataFrame) -> DataFrame:
    """Left join on the month; months without macro data keep nulls.

    No hint here: ``financials_and_macro`` knows the size of macro, one row per calendar
    month, and marks it for broadcasting while it is small.
    """
    return df.join(macro.select("date", *MACRO_COLUMNS), "date", "left")


def macro_adjusted(df: DataFrame) -> DataFrame:
    interest = F.when(F.col("interest_expense") > 0, F.col("interest_expense")).otherwise(1.0)
    return df.withColumns(
        {
            "real_revenue_growth": F.col("revenue_yoy") - F.col("inflation_rate") / 100,
            "interest_coverage": F.col("ebit") / interest,
        }
    )


def date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"year": F.year("date"), "month": F.month("date"), "quarter": F.quarter("date")}
    )


def flag_anomalies(df: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Rows whose yearly revenue growth is implausible; no base year means no flag."""
    yoy = F.col("revenue_yoy")
    outside = (yoy < limits.min_revenue_growth_yoy) | (yoy > limits.max_revenue_growth_yoy)
    return df.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))


def monthly_kpis(df: DataFrame) -> DataFrame:
    """All KPI columns that need no macro data.

    Gaps in the calendar are filled first so that lags count months, and dropped
    again at the end. All windows share one sort by (company, date).
    """
    steps = (margins, cost_ratios, working_capital, unit_economics, revenue_mom, yearly_growth,
             trailing_revenue)
    out = complete_months(df)
    for step in steps:
        out = out.transform(step)
    return out.filter(~F.col("is_gap")).drop("is_gap")


def silver_monthly(clean: DataFrame, macro: DataFrame) -> DataFrame:
    """Enriched monthly table."""
    return (
        monthly_kpis(clean)
        .transform(join_macro, macro)
        .transform(macro_adjusted)
        .transform(date_parts)
        .transform(flag_anomalies)
    )


def to_silver_schema(silver: DataFrame, run_id: str, processed_at=None) -> DataFrame:
    """The registered silver columns, in order, with run metadata."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return silver.withColumns(
        {
            "_processed_at": stamp,
            "_run_id": F.lit(run_id),
            "_schema_version": F.lit(SCHEMA_VERSIONS["silver_monthly"]),
        }
    ).select(*get_schema("silver_monthly_financials").fieldNames())


def annual_rollup(silver: DataFrame) -> DataFrame:
    """One row per (year, company): totals, mean margins and year-end balances.

    Year-end values are those of the latest month of the year.
    """
    totals = [F.sum(c).alias(c) for c in (*PNL_COLUMNS, "capex")]
    means = [
        F.avg(c).alias(alias)
        for c, alias in (
            ("gross_margin", "gross_margin_avg"),
            ("ebitda_margin", "ebitda_margin_avg"),
            ("net_margin", "net_margin_avg"),
            ("revenue_per_customer", "arpu"),
            ("churn_rate", "churn_rate_avg"),
            ("inflation_rate", "inflation_rate_avg"),
            ("interest_rate", "interest_rate_avg"),
            ("gdp_growth", "gdp_growth_avg"),
        )
    ]
    closing = [
        F.max_by(c, "date").alias(alias)
        for c, alias in (
            ("accounts_receivable", "accounts_receivable"),
            ("inventory", "inventory"),
            ("accounts_payable", "accounts_payable"),
            ("working_capital", "working_capital"),
            ("customers", "customers_eoy"),
        )
    ]
    return silver.groupBy(F.year("date").alias("year"), "company").agg(*totals, *means, *closing)


def annual_summary(annual: DataFrame) -> DataFrame:
    return annual.select(
        "company", "year", "revenue", "gross_margin_avg", "ebitda_margin_avg",
        "net_margin_avg", "customers_eoy",
    ).orderBy("company", "year")


def pnl_cascade(df: DataFrame, tax_rate: float = 0.28) -> DataFrame:
    """Profit lines from revenue and cost drivers, down to net income."""
    return (
        df.withColumn("gross_profit", F.col("revenue") - F.col("cogs"))
        .withColumn(
            "ebitda",
            F.col("gross_profit") - F.col("opex") - F.col("rd_expense") - F.col("sga_expense"),
        )
        .withColumn("ebit", F.col("ebitda") - F.col("depreciation"))
        .withColumn("ebt", F.col("ebit") - F.col("interest_expense"))
        .withColumn(
            "tax_expense",
            F.when(F.col("ebt") > 0, F.col("ebt") * tax_rate).when(F.col("ebt") <= 0, 0.0),
        )
        .withColumn("net_income", F.col("ebt") - F.col("tax_expense"))
    )
