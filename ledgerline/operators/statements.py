"""Three linked statements from yearly history and forecast.

Input is one frame of years per company (``combine_years``), optionally with a
``scenario`` key. Recurrences over years are closed forms on running windows,
so all three statements share one shuffle by company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    by_company, by_period, fall, floor_at_zero, growth, negate, ratio, rise, running,
)
from ledgerline.operators.kpis import PNL_COLUMNS
from ledgerline.params import SCENARIOS, ModelAssumptions, QualityLimits, ServingAssumptions

MODEL = ModelAssumptions()
SERVING = ServingAssumptions()
BALANCE_INPUTS = ("capex", "accounts_receivable", "inventory", "accounts_payable")
YEAR_COLUMNS = ("year", "company", "is_forecast", *PNL_COLUMNS, *BALANCE_INPUTS)


def _keys(df: DataFrame) -> tuple[str, ...]:
    return ("scenario",) if "scenario" in df.columns else ()


def combine_years(historical: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and forecast as one yearly series; columns one side lacks are null."""
    hist = historical.withColumn("is_forecast", F.lit(False))
    fcast = forecast.withColumn("is_forecast", F.lit(True))
    return hist.unionByName(fcast, allowMissingColumns=True).withColumn(
        "period_type", F.when(F.col("is_forecast"), "Forecast").otherwise("Historical")
    )


def combine_scenario_years(
    historical: DataFrame, scenario_rows: DataFrame, names: tuple[str, ...] = tuple(
        s.name for s in SCENARIOS
    )
) -> DataFrame:
    """The yearly series once per scenario; history is repeated for each."""
    repeated = historical.select(
        "*", F.explode(F.array(*[F.lit(n) for n in names])).alias("scenario")
    )
    return combine_years(repeated, scenario_rows)


def with_income_ratios(years: DataFrame, scenario: str = "Base") -> DataFrame:
    """Period label, margins, effective tax rate and growth over the joined series."""
    label = F.col("scenario") if "scenario" in years.columns else F.lit(scenario)
    spec = by_period(*_keys(years))
    return years.withColumns(
        {
            "period_type": F.when(
                F.col("is_forecast"), F.concat(F.lit("Forecast ("), label, F.lit(")"))
            ).otherwise("Historical"),
            "gross_margin": ratio("gross_profit", "revenue"),
            "ebitda_margin": ratio("ebitda", "revenue"),
            "ebit_margin": ratio("ebit", "revenue"),
            "net_margin": ratio("net_income", "revenue"),
            "tax_rate": ratio("tax_expense", "ebt"),
            "revenue_growth": growth("revenue", F.lag("revenue").over(spec)),
        }
    )


def income_statement(years: DataFrame, scenario: str = "Base") -> DataFrame:
    """Income lines of every year with their ratios."""
    return years.select(
        "company", *_keys(years), "year", "is_forecast", *PNL_COLUMNS
    ).transform(with_income_ratios, scenario)


def _first_history(value: str, keys: tuple[str, ...]) -> Column:
    """Value of the first historical year of the series."""
    year = F.when(~F.col("is_forecast"), F.col("year"))
    return F.min_by(value, year).over(by_company(*keys))


def _accumulate_floored(opening: Column, flow: Column, keys: tuple[str, ...]) -> tuple[dict, dict, Column]:
    """``x0 = opening; x_i = max(x_{i-1} + flow_i, 0)`` without a loop over years.

    With S the running sum of opening and flows, ``x_i = S_i - min(0, S_1..S_i)``:
    the running minimum is what the floor has absorbed so far.
    """
    spec = running(by_period(*keys))
    first = F.col("_i") == 0
    sums = {"_s": F.sum(F.when(first, opening).otherwise(flow)).over(spec)}
    lows = {"_low": F.min(F.when(~first, F.col("_s"))).over(spec)}
    return sums, lows, F.col("_s") - F.least(F.lit(0.0), F.col("_low"))


def net_ppe(
    years: DataFrame, opening: Column | None = None, model: ModelAssumptions = MODEL
) -> DataFrame:
    """Net fixed assets: opening balance plus spending less depreciation, never below zero."""
    keys = _keys(years)
    start = opening
    if start is None:
        start = F.col("_capex0") * model.opening_ppe_capex_multiple
    flow = F.abs("capex") - F.col("depreciation")
    sums, lows, balance = _accumulate_floored(start, flow, keys)
    return (
        years.withColumns(
            {
                "_i": F.row_number().over(by_period(*keys)) - 1,
                "_capex0": _first_history("capex", keys),
            }
        )
        .withColumns(sums)
        .withColumns(lows)
        .withColumn("net_ppe", balance)
        .drop("_i", "_capex0", "_s", "_low")
    )


def debt_schedule(
    years: DataFrame, model: ModelAssumptions = MODEL, all_years: bool = False
) -> DataFrame:
    """Debt implied by mean interest, repaid by a fixed share a year."""
    keys = _keys(years)
    interest = F.col("interest_expense")
    if not all_years:
        interest = F.when(~F.col("is_forecast"), interest)
    opening = (
        F.avg(interest).over(by_company(*keys))
        / model.implied_interest_rate
        * model.periods_per_year
    )
    age = F.row_number().over(by_period(*keys)) - 1
    return years.withColumn("long_term_debt", opening * F.pow(F.lit(model.debt_decay), age))


def retained_earnings(years: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    kept = F.col("net_income") * model.retention_ratio
    return years.withColumn(
        "retained_earnings", F.sum(kept).over(running(by_period(*_keys(years))))
    )


def equity_and_liabilities(
    years: DataFrame, model: ModelAssumptions = MODEL, paid_in_share: float | None = None
) -> DataFrame:
    share = model.paid_in_revenue_share if paid_in_share is None else paid_in_share
    return (
        years.withColumn("paid_in_capital", _first_history("revenue", _keys(years)) * share)
        .withColumn("total_equity", F.col("retained_earnings") + F.col("paid_in_capital"))
        .withColumn("total_liabilities", F.col("accounts_payable") + F.col("long_term_debt"))
    )


def cash_plug(years: DataFrame) -> DataFrame:
    """Cash balances the sheet, floored at zero; the floor shows up in the balance check."""
    funding = F.col("total_liabilities") + F.col("total_equity")
    other = F.col("accounts_receivable") + F.col("inventory") + F.col("net_ppe")
    return (
        years.withColumn("cash", floor_at_zero(funding - other))
        .withColumn(
            "current_assets",
            F.col("cash") + F.col("accounts_receivable") + F.col("inventory"),
        )
        .withColumn("total_assets", F.col("current_assets") + F.col("net_ppe"))
        .withColumn("bs_balance_check", F.abs(F.col("total_assets") - funding))
    )


def balance_sheet(years: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    return (
        net_ppe(years, model=model)
        .transform(debt_schedule, model)
        .transform(retained_earnings, model)
        .transform(equity_and_liabilities, model)
        .transform(cash_plug)
    )


def cash_flow(combined: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Indirect cash flow over rows that hold both income and balance columns."""
    spec = by_period(*_keys(combined))
    return (
        combined.withColumns(
            {
                "cfo_net_income": F.col("net_income"),
                "cfo_dna": F.col("depreciation"),
                "cfo_d_ar": fall("accounts_receivable", spec),
                "cfo_d_inv": fall("inventory", spec),
                "cfo_d_ap": rise("accounts_payable", spec),
                "capex_outflow": rise("net_ppe", spec) + F.col("depreciation"),
                "debt_change": rise("long_term_debt", spec),
                "dividends": negate(F.col("net_income") * model.dividend_payout_ratio),
                "cash_change": rise("cash", spec),
            }
        )
        .withColumns(
            {
                "cfo": F.col("cfo_net_income") + F.col("cfo_dna") + F.col("cfo_d_ar")
                + F.col("cfo_d_inv") + F.col("cfo_d_ap"),
                "cfi": negate("capex_outflow"),
                "cff": F.col("debt_change") + F.col("dividends"),
            }
        )
        .withColumn("net_cash_change", F.col("cfo") + F.col("cfi") + F.col("cff"))
        .withColumn("closing_cash", F.col("cash"))
        .withColumn(
            "cf_reconciliation", F.abs(F.col("net_cash_change") - F.col("cash_change"))
        )
    )


CASH_FLOW_BALANCES = (
    "cash", "accounts_receivable", "inventory", "accounts_payable", "long_term_debt", "net_ppe",
)


def cash_flow_statement(
    income: DataFrame, balance: DataFrame, model: ModelAssumptions = MODEL
) -> DataFrame:
    """Cash flow from two stored statements: income left-joined with balance columns."""
    keys = ["company", *_keys(income), "year", "is_forecast"]
    joined = income.join(balance.select(*keys, *CASH_FLOW_BALANCES), keys, "left")
    return cash_flow(joined, model)


def three_statements(years: DataFrame, model: ModelAssumptions = MODEL) -> DataFrame:
    """Income, balance and cash-flow columns side by side, one row per year.

    Equal to ``cash_flow_statement`` over separately built statements, without
    the join: every column derives from the same row and its year window.
    """
    wide = years.select(*_keys(years), *YEAR_COLUMNS).transform(with_income_ratios)
    return cash_flow(balance_sheet(wide, model), model)


def balance_sheet_serving(
    years: DataFrame, model: ModelAssumptions = MODEL, serving: ServingAssumptions = SERVING
) -> DataFrame:
    """Balance sheet of the serving layer: revenue-based fallbacks and opening balances.

    Opening values come from the first year of the series and mean interest from
    all years.
    """
    keys = _keys(years)
    first_revenue = F.first("revenue").over(
        by_period(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rev = F.col("revenue")

    def fallback(c: str, rate: float) -> Column:
        return F.coalesce(F.col(c), rev * rate)

    filled = years.withColumns(
        {
            "accounts_receivable": fallback("accounts_receivable", serving.receivables_rate),
            "inventory": fallback("inventory", serving.inventory_rate),
            "accounts_payable": fallback("accounts_payable", serving.payables_rate),
            "capex": fallback("capex", serving.capex_rate),
            "depreciation": F.abs(fallback("depreciation", serving.depreciation_rate)),
            "_revenue0": first_revenue,
        }
    )
    return (
        net_ppe(filled, F.col("_revenue0") * serving.opening_ppe_revenue_share, model)
        .transform(debt_schedule, model, True)
        .transform(retained_earnings, model)
        .withColumn("paid_in_capital", F.col("_revenue0") * serving.paid_in_revenue_share)
        .withColumn("total_equity", F.col("retained_earnings") + F.col("paid_in_capital"))
        .withColumn("total_liabilities", F.col("accounts_payable") + F.col("long_term_debt"))
        .transform(cash_plug)
        .drop("_revenue0")
    )


def cash_flow_serving(
    years: DataFrame, model: ModelAssumptions = MODEL, serving: ServingAssumptions = SERVING
) -> DataFrame:
    """Cash flow of the serving layer: investing is capital spending, cash accumulates from zero."""
    spec = by_period(*_keys(years))
    return (
        balance_sheet_serving(years, model, serving)
        .withColumns(
            {
                "cfo": F.col("net_income") + F.col("depreciation")
                + fall("accounts_receivable", spec)
                + fall("inventory", spec)
                + rise("accounts_payable", spec),
                "cfi": negate(F.abs("capex")),
                "debt_change": rise("long_term_debt", spec),
                "dividends": negate(F.col("net_income") * model.dividend_payout_ratio),
            }
        )
        .withColumn("cff", F.col("dividends") + F.col("debt_change"))
        .withColumn("net_cash_change", F.col("cfo") + F.col("cfi") + F.col("cff"))
        .withColumn("cumulative_cash", F.sum("net_cash_change").over(running(spec)))
    )


def _check_rows(agg: DataFrame, group: list[str], checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """One long row per check from one aggregate row per group."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            F.coalesce(worst.cast("double"), F.lit(0.0)).alias("worst"),
        )
        for name, passed, worst in checks
    ]
    return agg.select(*group, F.inline(F.array(*rows)))


def _holds(test: Column) -> Column:
    """Whether a test holds in every row; an unknown outcome does not."""
    return F.bool_and(F.coalesce(test, F.lit(False)))


def three_statement_checks(
    statements: DataFrame, model: ModelAssumptions = MODEL, limits: QualityLimits = QualityLimits()
) -> DataFrame:
    """The four linkage checks per company (and scenario), with the worst deviation.

    A year in which a check is unknown fails it; only the first year, which has no
    predecessor, takes no part in the check of retained earnings.
    """
    group = ["company", *_keys(statements)]
    spec = by_period(*_keys(statements))
    moved = F.col("retained_earnings") - F.lag("retained_earnings").over(spec)
    operating = F.col("gross_profit") - F.col("opex") - F.col("rd_expense") - F.col("sga_expense")
    agg = (
        statements.withColumns(
            {
                "_re_gap": F.abs(moved - F.col("net_income") * model.retention_ratio),
                "_ebitda_gap": F.abs(F.col("ebitda") - operating),
                "_first": F.row_number().over(spec) == 1,
            }
        )
        .groupBy(*group)
        .agg(
            F.max("bs_balance_check").alias("bs"),
            F.max("_re_gap").alias("re"),
            F.min("revenue").alias("rev"),
            F.max("_ebitda_gap").alias("eb"),
            _holds(F.col("bs_balance_check") < limits.bs_tolerance).alias("bs_ok"),
            _holds(F.col("_first") | (F.col("_re_gap") < limits.linkage_tolerance)).alias("re_ok"),
            _holds(F.col("revenue") > 0).alias("rev_ok"),
            _holds(F.col("_ebitda_gap") < limits.linkage_tolerance).alias("eb_ok"),
        )
    )
    return _check_rows(
        agg,
        group,
        [
            ("balance_sheet_balances", F.col("bs_ok"), F.col("bs")),
            ("net_income_to_retained_earnings", F.col("re_ok"), F.col("re")),
            ("all_revenues_positive", F.col("rev_ok"), F.col("rev")),
            ("ebitda_consistency", F.col("eb_ok"), F.col("eb")),
        ],
    )


def statement_identities(
    statements: DataFrame, tolerance: float = QualityLimits().bs_tolerance
) -> DataFrame:
    """Further identities every consistent set of statements holds, per company.

    As above, an unknown year fails; the first year takes no part in the growth of equity.
    """
    group = ["company", *_keys(statements)]
    spec = by_period(*_keys(statements))
    c = F.col
    gaps = {
        "assets_are_current_plus_fixed": F.abs(
            c("total_assets") - (c("current_assets") + c("net_ppe"))
        ),
        "current_assets_add_up": F.abs(
            c("current_assets") - (c("cash") + c("accounts_receivable") + c("inventory"))
        ),
        "net_change_adds_up": F.abs(
            c("net_cash_change") - (c("cfo") + c("cfi") + c("cff"))
        ),
        "closing_cash_on_balance_sheet": F.abs(c("closing_cash") - c("cash")),
        "depreciation_agrees": F.abs(c("depreciation") - c("cfo_dna")),
    }
    signs = {
        "cash_not_negative": (F.min("cash"), c("cash") >= 0),
        "equity_grows": (F.min("_equity_step"), c("_first") | (c("_equity_step") > 0)),
        "debt_below_assets": (
            F.max(c("long_term_debt") - c("total_assets")), c("long_term_debt") < c("total_assets")
        ),
        "operating_cash_positive": (F.min("cfo"), c("cfo") > 0),
        "investing_cash_negative": (F.max("cfi"), c("cfi") < 0),
    }
    agg = (
        statements.withColumns(
            {
                "_equity_step": c("total_equity") - F.lag("total_equity").over(spec),
                "_first": F.row_number().over(spec) == 1,
            }
        )
        .groupBy(*group)
        .agg(
            *[F.max(g).alias(name) for name, g in gaps.items()],
            *[value.alias(name) for name, (value, _) in signs.items()],
            *[_holds(g < tolerance).alias(f"{name}_ok") for name, g in gaps.items()],
            *[_holds(test).alias(f"{name}_ok") for name, (_, test) in signs.items()],
        )
    )
    return _check_rows(
        agg,
        group,
        [(n, c(f"{n}_ok"), c(n)) for n in (*gaps, *signs)],
    )


def cash_reconciliation(statements: DataFrame) -> DataFrame:
    """Mean and largest reconciliation error; the opening year is reported apart."""
    group = ["company", *_keys(statements)]
    opening = F.row_number().over(by_period(*_keys(statements))) == 1
    gap = F.col("cf_reconciliation")
    return (
        statements.withColumn("_opening", opening)
        .groupBy(*group)
        .agg(
            F.avg(gap).alias("mean_error"),
            F.max(gap).alias("max_error"),
            F.max(F.when(F.col("_opening"), gap)).alias("opening_error"),
            F.avg(F.when(~F.col("_opening"), gap)).alias("mean_error_after_opening"),
        )
    )
