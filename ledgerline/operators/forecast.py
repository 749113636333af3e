"""Monthly forecasts: revenue, costs, working capital, cash flow, scenarios.

History and future live in one frame per company (``extend_months``), and the
fitted parameters are window aggregates over that frame. The whole chain from
history to forecast cash flow therefore shares one shuffle by company, and
scenario rows are exploded from each row rather than joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    by_company, by_date, by_year, clip, growth, negate, ratio, running,
)
from ledgerline.operators.kpis import PNL_COLUMNS, cost_ratios, margins, pnl_cascade
from ledgerline.operators.timeseries import complete_months, extend_months
from ledgerline.params import (
    SCENARIO_EBITDA_PASS_THROUGH, SCENARIO_NET_PASS_THROUGH, SCENARIOS, SCHEMA_VERSIONS,
    ModelAssumptions, Scenario,
)
from ledgerline.schemas import get_schema

MODEL = ModelAssumptions()
MARGIN_COLUMNS = ("gross_margin", "ebitda_margin", "net_margin")
CLOSING_COLUMNS = ("accounts_receivable", "inventory", "accounts_payable")


def _add_revenue_fit(df: DataFrame, observed: Column, model: ModelAssumptions) -> DataFrame:
    """Linear trend times a month-of-year index, with an interval from the residual spread.

    ``observed`` is the series the fit may see; rows where it is null take no part.
    """
    wc = by_company()
    season = by_company("_moy")
    trend = F.col("_intercept") + F.col("_slope") * F.col("t")
    fitted = F.col("revenue_trend") * F.col("_index")
    return (
        df.withColumns(
            {
                "t": (F.row_number().over(by_date()) - 1).cast("double"),
                "_moy": F.month("date"),
                "_y": observed,
            }
        )
        .withColumns(
            {
                "_slope": F.regr_slope("_y", "t").over(wc),
                "_intercept": F.regr_intercept("_y", "t").over(wc),
            }
        )
        .withColumn("revenue_trend", trend)
        .withColumn(
            "_index",
            F.coalesce(F.avg(ratio("_y", "revenue_trend")).over(season), F.lit(1.0)),
        )
        .withColumn("revenue_forecast", fitted)
        .withColumn("_sigma", F.stddev_samp(F.col("_y") - F.col("revenue_forecast")).over(wc))
        .withColumns(
            {
                "revenue_lower": F.col("revenue_forecast") - model.interval_z * F.col("_sigma"),
                "revenue_upper": F.col("revenue_forecast") + model.interval_z * F.col("_sigma"),
                "revenue_seasonal": F.col("_index") - 1.0,
            }
        )
        .drop("_moy", "_y", "_slope", "_intercept", "_index", "_sigma")
    )


def forecast_revenue(
    history: DataFrame,
    periods: int = 36,
    model: ModelAssumptions = MODEL,
    until: dt.date | None = None,
) -> DataFrame:
    """In-sample fit and ``periods`` future months, per company.

    ``history`` has one row per (company, month); missing months are filled in
    so that the trend counts calendar months. Other columns are kept on history
    rows. ``step`` is 0 for history and 1.. for the future. The future starts
    after each company's own last month, or after ``until`` for all of them.
    """
    frame = extend_months(complete_months(history, until=until).drop("is_gap"), periods)
    return _add_revenue_fit(frame, F.col("revenue"), model)


def horizon(fitted: DataFrame) -> DataFrame:
    """Only the months after each company's history."""
    return fitted.filter(F.col("step") > 0)


def extend_regressors(
    silver: DataFrame, columns: tuple[str, ...] = ("inflation_rate", "interest_rate"),
    periods: int = 36, until: dt.date | None = None,
) -> DataFrame:
    """Regressors over history and future: nulls take the mean, the future the last known value."""
    history = complete_months(silver.select("company", "date", *columns), until=until)
    frame = extend_months(history.drop("is_gap"), periods)
    return fill_regressors(frame, columns).select("company", "date", "step", *columns)


def fill_regressors(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Regressor values for every row of a frame that has ``step``."""
    wc = by_company()

    def filled(c: str) -> Column:
        last_known = F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).over(wc)
        past = F.coalesce(F.col(c), F.avg(c).over(wc))
        return F.when(F.col("step") == 0, past).otherwise(last_known)

    return frame.withColumns({c: filled(c) for c in columns})


def _ratio_forecast(name: str, model: ModelAssumptions) -> dict[str, Column]:
    """Trend of a cost ratio, held within a band around its mean."""
    wc = by_company()
    mean = F.avg(name).over(wc)
    line = F.regr_intercept(name, "t").over(wc) + F.regr_slope(name, "t").over(wc) * F.col("t")
    return {
        f"{name}_hat": clip(line, mean - model.ratio_band, mean + model.ratio_band)
    }


def ratio_trend(frame: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Projected cogs, opex, R&D and SG&A ratios on every row of a forecast frame."""
    out = cost_ratios(frame)
    for name in ("cogs_ratio", "opex_ratio", "rd_ratio", "sga_ratio"):
        out = out.withColumns(_ratio_forecast(name, model))
    return out


def efficiency_ramp(frame: DataFrame, periods: int, model: ModelAssumptions = MODEL) -> DataFrame:
    """Planned efficiency gains: the factor falls linearly from 1 over the horizon."""
    span = float(max(periods - 1, 1))
    done = (F.col("step") - 1).cast("double") / span
    return frame.withColumns(
        {
            "cogs_ratio_hat": F.col("cogs_ratio_hat") * (1.0 - model.cogs_efficiency * done),
            "opex_ratio_hat": F.col("opex_ratio_hat") * (1.0 - model.opex_efficiency * done),
        }
    )


def history_ratios(frame: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Per-company ratios carried into the forecast.

    Depreciation is a ratio of means; the working-capital days and the capex
    share are means of monthly ratios.
    """
    wc = by_company()
    days = float(model.days_per_month)

    def mean_ratio(num: str, den: str, factor: float = 1.0) -> Column:
        return F.avg(ratio(num, den) * factor).over(wc)

    return frame.withColumns(
        {
            "depr_ratio": ratio(F.avg("depreciation").over(wc), F.avg("revenue").over(wc)),
            "interest_mean": F.avg("interest_expense").over(wc),
            "dso_mean": mean_ratio("accounts_receivable", "revenue", days),
            "dio_mean": mean_ratio("inventory", "cogs", days),
            "dpo_mean": mean_ratio("accounts_payable", "cogs", days),
            "capex_ratio": mean_ratio("capex", "revenue"),
        }
    )


def project_pnl(frame: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Forecast income lines from projected revenue and ratios (future rows only).

    Money is rounded to 2 places and margins to 4 before anything else uses them.
    """
    rev = F.col("revenue_forecast")
    raw = frame.withColumns(
        {
            "revenue": rev,
            "cogs": rev * F.col("cogs_ratio_hat"),
            "opex": rev * F.col("opex_ratio_hat"),
            "rd_expense": rev * F.col("rd_ratio_hat"),
            "sga_expense": rev * F.col("sga_ratio_hat"),
            "depreciation": rev * F.col("depr_ratio"),
            "interest_expense": F.col("interest_mean"),
        }
    ).transform(pnl_cascade, model.corporate_tax_rate)
    return raw.withColumns(
        {
            "gross_margin": F.round(ratio("gross_profit", "revenue"), 4),
            "ebitda_margin": F.round(ratio("ebitda", "revenue"), 4),
            "net_margin": F.round(ratio("net_income", "revenue"), 4),
        }
    ).withColumns({c: F.round(c, 2) for c in PNL_COLUMNS})


def project_working_capital(frame: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Unrounded balances and capital spending from the rounded income lines."""
    daily_rev = F.col("revenue") / float(model.days_per_month)
    daily_cogs = F.col("cogs") / float(model.days_per_month)
    return frame.withColumns(
        {
            "accounts_receivable": daily_rev * F.col("dso_mean"),
            "inventory": daily_cogs * F.col("dio_mean"),
            "accounts_payable": daily_cogs * F.col("dpo_mean"),
            "capex": F.col("revenue") * F.col("capex_ratio"),
        }
    )


def project_cash_flow(frame: DataFrame) -> DataFrame:
    """Operating and free cash flow; capital spending and working-capital build are negative.

    Deltas and the running total start anew with the first future month.
    """
    spec = by_date("_future")
    wc = F.col("accounts_receivable") + F.col("inventory") - F.col("accounts_payable")
    build = F.col("_wc") - F.lag("_wc").over(spec)
    return (
        frame.withColumns({"_wc": wc, "_future": F.col("step") > 0})
        .withColumn("_build", F.coalesce(build, F.lit(0.0)))
        .withColumn("cfo", F.col("net_income") + F.col("depreciation") - F.col("_build"))
        .withColumn("fcf", F.col("cfo") - F.col("capex"))
        .withColumn("cumulative_cash", F.sum("fcf").over(running(spec)))
        .withColumns(
            {
                "depreciation_addback": F.col("depreciation"),
                "change_in_wc": F.round(negate("_build"), 2),
                "capex": F.round(negate("capex"), 2),
                **{
                    c: F.round(c, 2)
                    for c in ("cfo", "fcf", "cumulative_cash", *CLOSING_COLUMNS)
                },
            }
        )
        .drop("_wc", "_build", "_future")
    )


def forecast_frame(
    history: DataFrame,
    periods: int = 36,
    model: ModelAssumptions = MODEL,
    until: dt.date | None = None,
) -> DataFrame:
    """History and future rows with every fitted parameter attached."""
    return (
        forecast_revenue(history, periods, model, until)
        .transform(ratio_trend, model)
        .transform(history_ratios, model)
        .transform(efficiency_ramp, periods, model)
    )


def gold_monthly(
    history: DataFrame,
    periods: int = 36,
    forecast_date: dt.date | None = None,
    model: ModelAssumptions = MODEL,
    until: dt.date | None = None,
) -> DataFrame:
    """The monthly forecast table."""
    made_on = F.current_date() if forecast_date is None else F.lit(forecast_date)
    return (
        forecast_frame(history, periods, model, until)
        .transform(horizon)
        .transform(project_pnl, model)
        .transform(project_working_capital, model)
        .transform(project_cash_flow)
        .select(
            "company", "date", *PNL_COLUMNS, *MARGIN_COLUMNS,
            "depreciation_addback", "change_in_wc", "cfo", "capex", "fcf", "cumulative_cash",
            *CLOSING_COLUMNS, "revenue_lower", "revenue_upper", "revenue_trend",
            F.lit(True).alias("is_forecast"), made_on.alias("forecast_date"),
        )
    )


def gold_annual(monthly: DataFrame) -> DataFrame:
    """Forecast per (year, company): sums, mean margins, year-end balances."""
    return monthly.groupBy(F.year("date").alias("year"), "company").agg(
        *[F.sum(c).alias(c) for c in (*PNL_COLUMNS, "cfo", "capex", "fcf")],
        *[F.avg(c).alias(c) for c in MARGIN_COLUMNS],
        *[F.max_by(c, "date").alias(c) for c in CLOSING_COLUMNS],
        F.bool_and("is_forecast").alias("is_forecast"),
    )


MODEL_AMOUNTS = (*PNL_COLUMNS, "capex", *CLOSING_COLUMNS, *MARGIN_COLUMNS)


def model_years(
    history: DataFrame,
    periods: int = 36,
    model: ModelAssumptions = MODEL,
    until: dt.date | None = None,
    means: tuple[str, ...] = (),
) -> DataFrame:
    """Historical and forecast years in one frame, from one pass over the months.

    The same rows as the annual roll-up next to the annual forecast, for the
    columns the statements need. History and future stay in the partitions of the
    single shuffle by company, which the yearly sums and the statement windows
    reuse; nothing is computed twice or joined. ``means`` are further columns of the
    history whose monthly mean is wanted; forecast years have null there.
    """
    past = margins(history)
    actual = F.struct(*[F.col(c) for c in (*MODEL_AMOUNTS, *means)])
    projected = (
        forecast_frame(past.withColumn("_actual", actual), periods, model, until)
        .transform(project_pnl, model)
        .transform(project_working_capital, model)
        .transform(project_cash_flow)
    )
    future = F.col("step") > 0
    months = projected.filter(future | F.col("_actual.revenue").isNotNull()).select(
        "company",
        "date",
        future.alias("is_forecast"),
        *[F.when(future, F.col(c)).otherwise(F.col(f"_actual.{c}")).alias(c) for c in MODEL_AMOUNTS],
        *[F.when(future, F.col(c)).alias(c) for c in ("cfo", "fcf")],
        *[F.when(~future, F.col(f"_actual.{c}")).alias(c) for c in means],
    )
    return months.groupBy(F.year("date").alias("year"), "company", "is_forecast").agg(
        *[F.sum(c).alias(c) for c in (*PNL_COLUMNS, "cfo", "capex", "fcf")],
        *[F.avg(c).alias(c) for c in (*MARGIN_COLUMNS, *means)],
        *[F.max_by(c, "date").alias(c) for c in CLOSING_COLUMNS],
    )


def explode_scenarios(df: DataFrame, scenarios: tuple[Scenario, ...] = SCENARIOS) -> DataFrame:
    """Each row once per scenario, with the scenario's two adjustments."""
    table = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("scenario"),
                F.lit(s.revenue_adj).alias("_revenue_adj"),
                F.lit(s.margin_adj).alias("_margin_adj"),
            )
            for s in scenarios
        ]
    )
    return df.select("*", F.inline(table))


def scenarios(
    annual: DataFrame,
    cases: tuple[Scenario, ...] = SCENARIOS,
    adjust_margins: bool = False,
    model: ModelAssumptions = MODEL,
) -> DataFrame:
    """Annual forecast per scenario; historical rows are repeated unchanged.

    Revenue and profit move; cost lines and margins stay at the base case. With
    ``adjust_margins`` the EBITDA and net margin columns move too and gross
    profit stays, which is the serving variant.
    """
    m = F.col("_margin_adj")
    revenue = F.col("revenue") * F.col("_revenue_adj")
    em = F.col("ebitda_margin") + m * SCENARIO_EBITDA_PASS_THROUGH
    nm = F.col("net_margin") + m * SCENARIO_NET_PASS_THROUGH
    moved = {
        "revenue": revenue,
        "ebitda": revenue * em,
        "net_income": revenue * nm,
        "fcf": revenue * nm * model.fcf_conversion,
    }
    if adjust_margins:
        moved |= {"ebitda_margin": em, "net_margin": nm}
    else:
        moved["gross_profit"] = revenue * (F.col("gross_margin") + m)
    return (
        explode_scenarios(annual, cases)
        .withColumns(
            {c: F.when(F.col("is_forecast"), x).otherwise(F.col(c)) for c, x in moved.items()}
        )
        .drop("_revenue_adj", "_margin_adj")
    )


def to_gold_schema(
    scenario_rows: DataFrame, historical: DataFrame, run_id: str, forecast_date: dt.date,
    forecast_model: str = "trend_x_month_index",
) -> DataFrame:
    """The registered gold columns of the scenario table, with yearly growth.

    Growth of the first forecast year compares with the last historical year.
    """
    last = historical.groupBy("company").agg(F.max_by("revenue", "year").alias("_last_revenue"))
    previous = F.coalesce(
        F.lag("revenue").over(by_year("scenario")), F.col("_last_revenue")
    )
    return (
        scenario_rows.join(last, "company", "left")
        .withColumns(
            {
                "revenue_growth_yoy": growth("revenue", previous),
                "forecast_model": F.lit(forecast_model),
                "_forecast_date": F.lit(forecast_date),
                "_run_id": F.lit(run_id),
                "_schema_version": F.lit(SCHEMA_VERSIONS["gold_forecast"]),
            }
        )
        .select(*get_schema("gold_annual_forecast").fieldNames())
    )


def forecast_mape(
    history: DataFrame,
    holdout: int = 12,
    model: ModelAssumptions = MODEL,
    until: dt.date | None = None,
) -> DataFrame:
    """Mean absolute percentage error of the last ``holdout`` months, fitted without them."""
    frame = complete_months(history.select("company", "date", "revenue"), until=until).drop("is_gap")
    split = F.add_months(F.max("date").over(by_company()), -holdout)
    error = F.abs(ratio(F.col("revenue") - F.col("revenue_forecast"), "revenue"))
    return (
        _add_revenue_fit(
            frame.withColumn("_split", split),
            F.when(F.col("date") <= F.col("_split"), F.col("revenue")),
            model,
        )
        .filter(F.col("date") > F.col("_split"))
        .groupBy("company")
        .agg(F.avg(error).alias("mape"), F.count("revenue").alias("n_months"))
    )


def forecast_vs_actual(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Forecast next to actuals for every (company, month) that either side has."""
    f = forecast.select("company", "date", F.col("revenue").alias("revenue_forecast"))
    a = actual.select("company", "date", F.col("revenue").alias("revenue_actual"))
    gap = F.col("revenue_actual") - F.col("revenue_forecast")
    return f.join(a, ["company", "date"], "full").withColumns(
        {"variance": gap, "variance_pct": ratio(gap, "revenue_actual")}
    )
