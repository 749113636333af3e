"""Discounted cash flow, sensitivity grids and shocks.

Parameters are rows exploded from literal arrays, never joined. The only shuffle
is by company and scenario: it numbers the forecast years, and the sums per grid
cell are computed within the same partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import by_year, ratio
from ledgerline.params import SHOCK_NET_PASS_THROUGH, ModelAssumptions

MODEL = ModelAssumptions()


def _keys(df: DataFrame) -> list[str]:
    return ["company"] + [c for c in ("scenario", "shock") if c in df.columns]


def free_cash_flow(model: ModelAssumptions = MODEL) -> Column:
    """Free cash flow, or the usual share of net income where it is missing."""
    return F.coalesce(F.col("fcf"), F.col("net_income") * model.fcf_conversion)


def yearly_flows(df: DataFrame) -> DataFrame:
    """Free cash flow per key and year, with the year's position ``t`` from 1."""
    keys = _keys(df)
    return df.select(*keys, "year", free_cash_flow().alias("fcf")).withColumn(
        "t", F.row_number().over(by_year(*keys[1:]))
    )


def value_flows(flows: DataFrame, wacc: Column, growth: Column, net_debt: float) -> DataFrame:
    """Enterprise and equity value per key; null where growth reaches the discount rate.

    ``wacc`` and ``growth`` may be constants or columns of ``flows``: every column
    besides year, t and fcf is part of the key.
    """
    keys = [c for c in flows.columns if c not in ("year", "t", "fcf")]
    w, g = F.col("_wacc"), F.col("_growth")
    return (
        flows.withColumns({"_wacc": wacc, "_growth": growth})
        .groupBy(*keys, "_wacc", "_growth")
        .agg(
            F.sum(F.col("fcf") / F.pow(1.0 + w, "t")).alias("pv_fcf"),
            F.max_by("fcf", "year").alias("_last"),
            F.count("*").alias("_n"),
        )
        .withColumn("pv_fcf", F.when(w > g, F.col("pv_fcf")))
        .withColumn(
            "terminal_value", F.when(w > g, F.col("_last") * (1.0 + g) / (w - g))
        )
        .withColumn("pv_terminal", F.col("terminal_value") / F.pow(1.0 + w, "_n"))
        .withColumn("enterprise_value", F.col("pv_fcf") + F.col("pv_terminal"))
        .withColumns(
            {
                "equity_value": F.col("enterprise_value") - F.lit(net_debt),
                "pv_fcf_pct": ratio("pv_fcf", "enterprise_value"),
                "pv_tv_pct": ratio("pv_terminal", "enterprise_value"),
            }
        )
        .drop("_wacc", "_growth", "_last", "_n")
    )


def dcf(
    df: DataFrame,
    wacc: float = MODEL.default_wacc,
    growth: float = MODEL.default_terminal_growth,
    net_debt: float = 0.0,
    shares: float = 1_000_000.0,
) -> DataFrame:
    """Valuation per company (and scenario, shock), with value per share."""
    valued = value_flows(yearly_flows(df), F.lit(wacc), F.lit(growth), net_debt)
    return valued.withColumn("value_per_share", ratio("equity_value", F.lit(shares)))


def dcf_schedule(df: DataFrame, wacc: float = MODEL.default_wacc) -> DataFrame:
    """Discount factor and present value of each forecast year."""
    return (
        yearly_flows(df)
        .withColumn("discount_factor", 1.0 / F.pow(F.lit(1.0 + wacc), F.col("t")))
        .withColumn("pv_fcf", F.col("fcf") * F.col("discount_factor"))
    )


def dcf_sensitivity(
    df: DataFrame,
    wacc_pct: tuple[int, int, int] = (8, 22, 2),
    growth_pct: tuple[int, int, int] = (1, 5, 1),
    net_debt: float = 0.0,
) -> DataFrame:
    """Equity value in millions over a grid of discount and growth rates.

    Both axes are integer percentages (first, last, step), which keeps the end
    point exact.
    """
    grid = (
        yearly_flows(df)
        .select("*", F.explode(F.sequence(*map(F.lit, wacc_pct))).alias("wacc_pct"))
        .select("*", F.explode(F.sequence(*map(F.lit, growth_pct))).alias("growth_pct"))
    )
    w, g = F.col("wacc_pct") / 100.0, F.col("growth_pct") / 100.0
    return value_flows(grid, w, g, net_debt).select(
        *_keys(df), "wacc_pct", "growth_pct",
        (F.col("equity_value") / 1e6).alias("equity_value_m"),
    )


def shock(
    df: DataFrame, shocks: list[tuple[float, float]], model: ModelAssumptions = MODEL
) -> DataFrame:
    """Revenue and margin shocks, one output row per input row and shock pair.

    The (0, 0) shock leaves the row as it is. Margins missing as columns are
    taken from the unshocked row.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(float(r)).alias("revenue_shock"), F.lit(float(s)).alias("margin_shock"))
            for r, s in shocks
        ]
    )
    rows = df.select("*", F.inline(pairs))
    em = F.coalesce(F.col("ebitda_margin"), ratio("ebitda", "revenue"))
    nm = F.coalesce(F.col("net_margin"), ratio("net_income", "revenue"))
    r, s = F.col("revenue_shock"), F.col("margin_shock")
    quiet = (r == 0) & (s == 0)
    revenue = F.col("revenue") * (1.0 + r)
    net = revenue * (nm + s * SHOCK_NET_PASS_THROUGH)

    def moved(name: str, value: Column) -> Column:
        return F.when(quiet, F.col(name)).otherwise(value)

    return rows.withColumns(
        {
            "revenue": moved("revenue", revenue),
            "ebitda": moved("ebitda", revenue * (em + s)),
            "net_income": moved("net_income", net),
            "fcf": moved("fcf", net * model.fcf_conversion),
            "shock": F.format_string("%+.3f/%+.3f", r, s),
        }
    )
