"""Monthly company financials and macro indicators derived from transactions.

Order lines are reduced to one row per order before any join: the partial
aggregate runs on the map side, so neither a hot order nor a hot customer or
company ever moves more than one partial row per task and key. The same holds
for the later steps (customer-month, then company-month).

Amounts are exact. A product of cents and percentages is an integer, summed as
two BIGINT limbs: each limb has room for 10^12 rows of the largest amount, and
BIGINT sums stay in place in the aggregation buffer where wide DECIMAL sums
allocate per row. The limbs become DECIMAL only in the last projection, so
results do not depend on the order of addition.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.changes import apply_delta
from ledgerline.params import IngestionWindow
from ledgerline.sources.layers import materialize
from ledgerline.sources.tables import star_table

LIMB = 1_000_000
# Sums of net line amounts in 1/10^4 currency units, and weighted ones in 1/10^6.
NET_SUMS = ("rev", "rev_kept", "rev_open", "rev_pending")
WEIGHTED_SUMS = ("rev_tax", "rev_disc")
# Sums that the macro series are made of.
MACRO_SUMS = ("disc", "tax", "qty", "cents_hi", "cents_lo")

# Macro tables up to this many months are broadcast.
BROADCAST_MONTHS = 20_000

# What counts as a company: the columns its name is built from.
COMPANY_GRAINS = {
    "region": ("r_name",),
    "nation": ("n_name",),
    "nation_segment": ("n_name", "c_mktsegment"),
}


def _hundredths(column: str) -> str:
    """A stored two-place double as an exact integer (``round`` would go through BigDecimal)."""
    return f"FLOOR({column} * 100 + 0.5D)"


def _limbs(name: str, amount: str) -> list[str]:
    """An integer amount as a high and a low part that add up separately."""
    return [f"({amount}) DIV {LIMB} AS {name}_hi", f"({amount}) % {LIMB} AS {name}_lo"]


def _limb_names(*names: str) -> list[str]:
    return [f"{n}_{part}" for n in names for part in ("hi", "lo")]


def _joined(name: str, places: int) -> str:
    """Both limbs as one DECIMAL with the given number of places."""
    whole = f"CAST({name}_hi AS DECIMAL(20,0)) * {LIMB} + {name}_lo"
    return f"CAST(({whole}) * {Decimal(1).scaleb(-places):f} AS DECIMAL({20 + places},{places}))"


def _sums(names) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def order_totals(spark: SparkSession, root: str, only: DataFrame | None = None) -> DataFrame:
    """One row per order: the line sums every monthly measure is a combination of.

    ``only`` has the keys (``o_orderkey``) of the orders whose lines are wanted.
    """
    source = star_table(spark, root, "lineitem")
    if only is not None:
        source = source.join(only.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    net = f"{_hundredths('l_extendedprice')} * (100 - {_hundredths('l_discount')})"
    lines = (
        source.selectExpr(
            "l_orderkey",
            "l_returnflag = 'N' AS kept",
            "l_linestatus = 'O' AS open",
            "l_returnflag = 'R' AS returned",
            f"{net} AS rev",
            f"{_hundredths('l_discount')} AS disc",
            f"{_hundredths('l_tax')} AS tax",
            f"{_hundredths('l_quantity')} AS qty",
            f"{_hundredths('l_extendedprice')} AS cents",
        )
        .selectExpr(
            "l_orderkey",
            "disc",
            "tax",
            "qty",
            *_limbs("cents", "cents"),
            *_limbs("rev", "rev"),
            *_limbs("rev_tax", "rev * tax"),
            *_limbs("rev_disc", "rev * disc"),
            *_limbs("rev_kept", "IF(kept, rev, 0)"),
            *_limbs("rev_open", "IF(open, rev, 0)"),
            "1 AS n_lines",
            "IF(returned, 1, 0) AS n_returned",
        )
    )
    return lines.groupBy("l_orderkey").agg(
        *_sums(_limb_names("rev", "rev_tax", "rev_disc", "rev_kept", "rev_open")),
        *_sums(["n_lines", "n_returned", *MACRO_SUMS]),
    )


def monthly_financials(
    spark: SparkSession,
    root: str,
    company: str = "nation",
    window: IngestionWindow | None = None,
) -> DataFrame:
    """Bronze financials, one row per (company, month of the order date).

    ``company`` picks the grain (see ``COMPANY_GRAINS``). Without ``window`` the
    whole order history is used.
    """
    return _company_lines(company_sums(spark, root, company, window))


def financials_and_macro(
    spark: SparkSession,
    root: str,
    company: str = "nation",
    window: IngestionWindow | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both bronze tables from one pass over the order lines.

    The sums per company and month, far fewer rows than orders, are stored once. So is the
    macro table, one row per calendar month; it is broadcast if it has no more than
    ``BROADCAST_MONTHS``, so that joins on the month move no company.
    """
    sums = materialize(company_sums(spark, root, company, window))
    macro = materialize(_macro_lines(sums))
    small = macro.limit(BROADCAST_MONTHS + 1).count() <= BROADCAST_MONTHS
    return _company_lines(sums), F.broadcast(macro) if small else macro


def company_sums(
    spark: SparkSession, root: str, company: str, window: IngestionWindow | None = None
) -> DataFrame:
    """Exact sums per company and month; orders of unknown customers have company null."""
    per_customer = customer_months(order_totals(spark, root), _orders(spark, root, window))
    return company_months(spark, root, per_customer, company)


#: Sums of an order that are kept per customer, company and month.
MEASURES = _limb_names(*NET_SUMS, *WEIGHTED_SUMS) + ["n_lines", "n_returned", "n_orders", *MACRO_SUMS]


def customer_months(totals: DataFrame, orders: DataFrame, weight: str = "1") -> DataFrame:
    """Exact sums per customer and month from ``order_totals``; the finest grain that is kept.

    ``weight`` is what an order counts, by an expression: -1 takes it off.
    """
    pending = "o_orderstatus = 'P'"
    sums = [F.sum(m if weight == "1" else F.expr(f"{m} * ({weight})")).alias(m) for m in MEASURES]
    return (
        totals.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "*",
            f"IF({pending}, rev_hi, 0) AS rev_pending_hi",
            f"IF({pending}, rev_lo, 0) AS rev_pending_lo",
            "1 AS n_orders",
        )
        .groupBy("o_custkey", "date")
        .agg(*sums)
    )


def company_months(spark: SparkSession, root: str, per_customer: DataFrame, company: str) -> DataFrame:
    """``customer_months`` summed per company."""
    name = F.concat_ws(" / ", *COMPANY_GRAINS[company])
    owners = (
        star_table(spark, root, "customer")
        .join(star_table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star_table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", name.alias("company"))
    )
    return (
        per_customer.join(owners, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy("company", "date")
        # one input row per customer and month, so the row count is the distinct count
        .agg(*_sums(MEASURES), F.count("*").alias("customers"))
    )


def updated_financials(
    spark: SparkSession, root: str, stored: DataFrame, changes: DataFrame, company: str
) -> tuple[DataFrame, DataFrame]:
    """Customer-months brought up to date by changed orders, and the company lines of them.

    ``stored`` are the ``customer_months`` of the old snapshot; ``changes`` is a stored
    ``signed_difference`` of (o_orderkey, o_custkey, o_orderstatus, date). Of the order lines
    only those of changed orders are summed.
    """
    delta = customer_months(order_totals(spark, root, changes), changes, "sign")
    now = apply_delta(stored, delta, ["o_custkey", "date"], "n_orders")
    return now, _company_lines(company_months(spark, root, now, company))


def hierarchy_totals(spark: SparkSession, root: str, sets: list[tuple[str, ...]], columns: tuple[str, ...]) -> DataFrame:
    """Revenue and orders for each of the grouping ``sets`` over region, nation, segment, year, quarter, month.

    One scan of the order lines: they are customer-months before they are copied to the sets.
    ``level`` tells which of ``columns`` a row is summed over (bits, the first column highest).
    """
    owners = (
        star_table(spark, root, "customer")
        .join(star_table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star_table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"))
    )
    months = customer_months(order_totals(spark, root), _orders(spark, root, None))
    finest = (
        months.join(owners, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("region", "nation", "segment", "date")
        .agg(*_sums(["rev_hi", "rev_lo", "n_orders"]))
        .selectExpr("*", "year(date) AS year", "quarter(date) AS quarter", "month(date) AS month")
    )
    totals = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    summed = totals.agg(F.grouping_id().cast("bigint").alias("level"), *_sums(["rev_hi", "rev_lo", "n_orders"]))
    return summed.selectExpr(*columns, "level", f"CAST({_joined('rev', 4)} AS DOUBLE) AS revenue", "n_orders")


def _orders(spark: SparkSession, root: str, window: IngestionWindow | None) -> DataFrame:
    orders = star_table(spark, root, "orders")
    if window is not None:
        # on the stored column, so that the scan can skip row groups
        orders = orders.filter(
            (F.col("o_orderdate") >= F.lit(window.start).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.date_add(F.lit(window.end), 1).cast("timestamp_ntz"))
        )
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("date")
    )


# Statement lines as DECIMAL combinations of the exact sums (fixed values).
_LINES = {
    "revenue": "rev",
    "cogs": "rev * 0.38 + rev_tax",
    "opex": "rev * 0.18 + rev_disc",
    "rd_expense": "rev * 0.06 + rev_tax",
    "sga_expense": "rev * 0.10 + rev_tax * 0.5",
    "depreciation": "rev * 0.03 + rev_disc * 0.2",
    "accounts_receivable": "rev_pending * 0.4",
    "inventory": "rev_kept * 0.19",
    "accounts_payable": "rev_open * 0.084",
    "capex": "rev * 0.04 + rev_disc * 0.3",
}
# Profit lines in dependency order.
_CASCADE = {
    "gross_profit": "revenue - cogs",
    "ebitda": "gross_profit - opex - rd_expense - sga_expense",
    "ebit": "ebitda - depreciation",
    "ebt": "ebit - interest_expense",
    "tax_expense": "ROUND(GREATEST(ebt * 0.28, 0), 2)",
    "net_income": "ebt - tax_expense",
}
_AMOUNTS = (
    "revenue", "cogs", "gross_profit", "opex", "rd_expense", "sga_expense", "ebitda",
    "depreciation", "ebit", "interest_expense", "ebt", "tax_expense", "net_income",
    "accounts_receivable", "inventory", "accounts_payable", "capex",
)


def _company_lines(sums: DataFrame) -> DataFrame:
    """The statement lines from the company-month sums, rounded as DECIMAL, then DOUBLE."""
    counts = ["date", "company", "customers", "n_lines", "n_returned"]
    exact = sums.filter("company IS NOT NULL").selectExpr(
        *counts,
        "n_orders",
        *[f"{_joined(n, 4)} AS {n}" for n in NET_SUMS],
        *[f"{_joined(n, 6)} AS {n}" for n in WEIGHTED_SUMS],
    )
    # a later expression of the same list may use an earlier name
    return exact.selectExpr(
        *counts,
        *[f"CAST(ROUND({x}, 2) AS DECIMAL(22,2)) AS {name}" for name, x in _LINES.items()],
        "CAST(n_orders AS DECIMAL(18,0)) * 100 AS interest_expense",
        *[f"{x} AS {name}" for name, x in _CASCADE.items()],
    ).selectExpr(
        "date",
        "company",
        *[f"CAST({a} AS DOUBLE) AS {a}" for a in _AMOUNTS],
        "customers",
        "CAST(revenue AS DOUBLE) / customers AS avg_revenue_per_user",
        f"{_half_up('n_returned * 1200', 'n_lines')} / 10000D AS churn_rate",
    )


def _half_up(num: str, den: str) -> str:
    """Integer division of non-negative integers, rounded half up."""
    return f"((2 * ({num}) + {den}) DIV (2 * {den}))"


def monthly_macro(
    spark: SparkSession, root: str, window: IngestionWindow | None = None
) -> DataFrame:
    """Bronze macro indicators, one row per month of the order date."""
    orders = _orders(spark, root, window)
    joined = order_totals(spark, root).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _macro_lines(joined)


def _macro_lines(sums: DataFrame) -> DataFrame:
    """The macro series from sums of any finer grain that has a date."""
    months = sums.groupBy("date").agg(*_sums(MACRO_SUMS), F.sum("n_lines").alias("n"))
    fx = f"CAST({_joined('cents', 2)} AS DOUBLE) / n / 3000.0D"
    return months.selectExpr(
        "date",
        f"{_half_up('disc * 100', 'n')} / 100D AS inflation_rate",
        f"{_half_up('tax * 175', 'n')} / 100D AS interest_rate",
        f"{_half_up('tax * 45', 'n')} / 100D AS gdp_growth",
        f"FLOOR({fx} * 100 + 0.5D) / 100D AS usd_zar",
        f"{_half_up('qty * 125', 'n * 100')} / 100D AS unemployment",
    )
