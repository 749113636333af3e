"""Independent SQL for every query, as composable common table expressions.

The SQL is written from the definitions, not from the DataFrame plans: it works
on order lines directly, joins where the plans use windows and vice versa.
"""

from __future__ import annotations

# name -> (body, names it reads)
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, body: str, *reads: str) -> None:
    _CTES[name] = (body, reads)


def with_ctes(sql: str, *reads: str, instead: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """``sql`` preceded by the named expressions and everything they read.

    ``instead`` gives other bodies, and what these read, for some of the names.
    """
    known = _CTES | (instead or {})
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in known[name][1]:
            visit(dep)
        order.append(name)

    for name in reads:
        visit(name)
    if not order:
        return sql
    head = ",\n".join(f"{n} AS ({known[n][0]})" for n in order)
    return f"WITH {head}\n{sql}"


# The month of the last order, and the one after it: where history ends and forecasts begin.
END = "SELECT CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) FROM orders"
MADE_ON = "SELECT CAST(date_trunc('month', MAX(o_orderdate)) + INTERVAL 1 MONTH AS DATE) FROM orders"
PNL = (
    "revenue", "cogs", "gross_profit", "opex", "rd_expense", "sga_expense", "ebitda",
    "depreciation", "ebit", "interest_expense", "ebt", "tax_expense", "net_income",
)
AMOUNTS = PNL + ("accounts_receivable", "inventory", "accounts_payable", "capex")


def _financials(name: str, company: str, orders: str = "orders") -> None:
    _cte(
        f"{name}_lines",
        f"""
SELECT {company} AS company, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  o_orderkey, o_custkey, o_orderstatus, l_returnflag, l_linestatus,
  CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t,
  CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
FROM lineitem JOIN {orders} ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    )
    _cte(
        f"{name}_sums",
        f"""
SELECT company, date, ROUND(SUM(rev), 2) AS revenue,
  ROUND(SUM(rev * (0.38 + t)), 2) AS cogs, ROUND(SUM(rev * (0.18 + d)), 2) AS opex,
  ROUND(SUM(rev * (0.06 + t)), 2) AS rd_expense,
  ROUND(SUM(rev * (0.10 + 0.5 * t)), 2) AS sga_expense,
  ROUND(SUM(rev * (0.03 + 0.2 * d)), 2) AS depreciation,
  CAST(100 * COUNT(DISTINCT o_orderkey) AS DECIMAL(18,2)) AS interest_expense,
  ROUND(SUM(CASE WHEN o_orderstatus = 'P' THEN rev * 0.4 ELSE 0 END), 2) AS accounts_receivable,
  ROUND(SUM(CASE WHEN l_returnflag = 'N' THEN rev * 0.19 ELSE 0 END), 2) AS inventory,
  ROUND(SUM(CASE WHEN l_linestatus = 'O' THEN rev * 0.084 ELSE 0 END), 2) AS accounts_payable,
  ROUND(SUM(rev * (0.04 + 0.3 * d)), 2) AS capex,
  COUNT(DISTINCT o_custkey) AS customers, COUNT(*) AS n_lines,
  COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned
FROM {name}_lines GROUP BY company, date""",
        f"{name}_lines",
    )
    _cte(
        f"{name}_profit",
        f"""
SELECT *, ebt - ROUND(GREATEST(0.28 * ebt, 0), 2) AS net_income,
  ROUND(GREATEST(0.28 * ebt, 0), 2) AS tax_expense
FROM (SELECT *, revenue - cogs AS gross_profit,
    revenue - cogs - opex - rd_expense - sga_expense AS ebitda,
    revenue - cogs - opex - rd_expense - sga_expense - depreciation AS ebit,
    revenue - cogs - opex - rd_expense - sga_expense - depreciation - interest_expense AS ebt
  FROM {name}_sums) s""",
        f"{name}_sums",
    )
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in AMOUNTS)
    _cte(
        name,
        f"""
SELECT company, date, {casts}, customers,
  CAST(revenue AS DOUBLE) / customers AS avg_revenue_per_user,
  CAST((2400 * n_returned + n_lines) // (2 * n_lines) AS DOUBLE) / 10000 AS churn_rate
FROM {name}_profit""",
        f"{name}_profit",
    )
    _full(f"{name}_full", name)


def _full(name: str, source: str, last: str = "MAX(date)") -> None:
    """Calendar-complete rows of a (company, date) table, up to each or a common last month."""
    _cte(
        f"{name}_grid",
        f"""
SELECT company, CAST(UNNEST(generate_series(first_date, last_date, INTERVAL 1 MONTH)) AS DATE) AS date
FROM (SELECT company, MIN(date) AS first_date, {last} AS last_date
  FROM {source} GROUP BY company) span""",
        source,
    )
    _cte(
        name,
        f"""
SELECT g.company, g.date, s.* EXCLUDE (company, date), s.company IS NULL AS is_gap
FROM {name}_grid g LEFT JOIN {source} s ON g.company = s.company AND g.date = s.date""",
        f"{name}_grid",
        source,
    )


_financials("fin", "n_name")
_financials("fin_later", "n_name", "(SELECT * FROM orders WHERE o_orderkey % 19 <> 7) orders")
_financials("seg", "n_name || ' / ' || c_mktsegment")
_cte(
    "macro",
    """
SELECT date, CAST((2 * 100 * disc + n) // (2 * n) AS DOUBLE) / 100 AS inflation_rate,
  CAST((2 * 175 * tax + n) // (2 * n) AS DOUBLE) / 100 AS interest_rate,
  CAST((2 * 45 * tax + n) // (2 * n) AS DOUBLE) / 100 AS gdp_growth,
  FLOOR(CAST(price AS DOUBLE) / n / 3000.0 * 100 + 0.5) / 100 AS usd_zar,
  CAST((2 * 125 * qty + 100 * n) // (2 * 100 * n) AS DOUBLE) / 100 AS unemployment
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, COUNT(*) AS n,
    SUM(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT)) AS disc,
    SUM(CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS BIGINT)) AS tax,
    SUM(CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS BIGINT)) AS qty,
    SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) s""",
)
# booked gross profit: the nearest multiple of 2.20, found without decimal division
_cte(
    "reported",
    """
SELECT * EXCLUDE (is_gap) REPLACE (
  CAST(CAST((2 * CAST(gross_profit * 100 AS BIGINT) + 220) // 440 AS DECIMAL(22,0)) * 2.20 AS DOUBLE)
    AS gross_profit)
FROM (SELECT * REPLACE (CAST(gross_profit AS DECIMAL(22,2)) AS gross_profit) FROM seg_full) s""",
    "seg_full",
)

# ---------------------------------------------------------------- KPIs
_cte(
    "kpi",
    """
SELECT * FROM (SELECT *,
  gross_profit / NULLIF(revenue, 0) AS gross_margin, ebitda / NULLIF(revenue, 0) AS ebitda_margin,
  ebit / NULLIF(revenue, 0) AS ebit_margin, net_income / NULLIF(revenue, 0) AS net_margin,
  cogs / NULLIF(revenue, 0) AS cogs_ratio, opex / NULLIF(revenue, 0) AS opex_ratio,
  rd_expense / NULLIF(revenue, 0) AS rd_ratio, sga_expense / NULLIF(revenue, 0) AS sga_ratio,
  accounts_receivable + inventory - accounts_payable AS working_capital,
  accounts_receivable / NULLIF(revenue, 0) * 30 AS dso, inventory / NULLIF(cogs, 0) * 30 AS dio,
  accounts_payable / NULLIF(cogs, 0) * 30 AS dpo,
  accounts_receivable / NULLIF(revenue, 0) * 30 + inventory / NULLIF(cogs, 0) * 30
    - accounts_payable / NULLIF(cogs, 0) * 30 AS cash_conversion_cycle,
  revenue / NULLIF(customers, 0) AS revenue_per_customer,
  gross_profit / NULLIF(customers, 0) AS gross_profit_per_customer,
  (revenue - LAG(revenue) OVER w) / NULLIF(LAG(revenue) OVER w, 0) AS revenue_mom,
  (revenue - LAG(revenue, 12) OVER w) / NULLIF(LAG(revenue, 12) OVER w, 0) AS revenue_yoy,
  (net_income - LAG(net_income, 12) OVER w) / NULLIF(LAG(net_income, 12) OVER w, 0) AS net_income_yoy,
  SUM(revenue) OVER (PARTITION BY company ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS revenue_ttm
  FROM fin_full WINDOW w AS (PARTITION BY company ORDER BY date)) k WHERE NOT is_gap""",
    "fin_full",
)
_cte(
    "silver",
    """
SELECT k.*, inflation_rate, interest_rate, gdp_growth, usd_zar, unemployment,
  revenue_yoy - inflation_rate / 100 AS real_revenue_growth,
  ebit / (CASE WHEN interest_expense > 0 THEN interest_expense ELSE 1 END) AS interest_coverage,
  CAST(EXTRACT(year FROM k.date) AS INTEGER) AS year,
  CAST(EXTRACT(month FROM k.date) AS INTEGER) AS month,
  CAST(EXTRACT(quarter FROM k.date) AS INTEGER) AS quarter,
  COALESCE(revenue_yoy < -0.8 OR revenue_yoy > 2.0, FALSE) AS is_anomaly
FROM kpi k LEFT JOIN macro m ON k.date = m.date""",
    "kpi",
    "macro",
)
_cte(
    "annual",
    "SELECT company, year, "
    + ", ".join(f"SUM({c}) AS {c}" for c in PNL + ("capex",))
    + """, AVG(gross_margin) AS gross_margin_avg, AVG(ebitda_margin) AS ebitda_margin_avg,
  AVG(net_margin) AS net_margin_avg, AVG(revenue_per_customer) AS arpu,
  AVG(churn_rate) AS churn_rate_avg, AVG(inflation_rate) AS inflation_rate_avg,
  AVG(interest_rate) AS interest_rate_avg, AVG(gdp_growth) AS gdp_growth_avg, """
    + ", ".join(
        f"arg_max_null({c}, date) AS {a}"
        for c, a in (
            ("accounts_receivable", "accounts_receivable"), ("inventory", "inventory"),
            ("accounts_payable", "accounts_payable"), ("working_capital", "working_capital"),
            ("customers", "customers_eoy"),
        )
    )
    + " FROM silver GROUP BY company, year",
    "silver",
)
_cte("hist", "SELECT * FROM annual", "annual")

# ---------------------------------------------------------------- forecasts
_cte("past", "SELECT * FROM fin", "fin")
_full("past_full", "past", f"GREATEST(({END}), MAX(date))")
_cte(
    "series",
    """
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY company ORDER BY date) - 1 AS DOUBLE) AS t,
  EXTRACT(month FROM date) AS moy FROM past_full""",
    "past_full",
)
_cte(
    "fit",
    """
SELECT company, REGR_SLOPE(revenue, t) AS b, REGR_INTERCEPT(revenue, t) AS a,
  MAX(date) AS last_date, COUNT(*) AS n FROM series GROUP BY company""",
    "series",
)
_cte(
    "season",
    """
SELECT s.company, moy, AVG(revenue / NULLIF(a + b * t, 0)) AS idx
FROM series s JOIN fit f ON s.company = f.company GROUP BY s.company, moy""",
    "series",
    "fit",
)
_cte(
    "spread",
    """
SELECT s.company, STDDEV_SAMP(revenue - (a + b * t) * COALESCE(idx, 1.0)) AS sigma
FROM series s JOIN fit f ON s.company = f.company
  JOIN season z ON s.company = z.company AND s.moy = z.moy GROUP BY s.company""",
    "series",
    "fit",
    "season",
)
_cte(
    "slots",
    """
SELECT company, date, t, moy, 0 AS step, revenue FROM series
UNION ALL
SELECT company, CAST(last_date + to_months(CAST(k AS INTEGER)) AS DATE),
  CAST(n - 1 + k AS DOUBLE), EXTRACT(month FROM last_date + to_months(CAST(k AS INTEGER))),
  CAST(k AS INTEGER), NULL
FROM fit CROSS JOIN generate_series(1, 36) g(k)""",
    "series",
    "fit",
)
_cte(
    "fitted",
    """
SELECT s.company, s.date, s.t, s.step, s.revenue, a + b * s.t AS revenue_trend,
  (a + b * s.t) * COALESCE(idx, 1.0) AS revenue_forecast,
  (a + b * s.t) * COALESCE(idx, 1.0) - 1.2816 * sigma AS revenue_lower,
  (a + b * s.t) * COALESCE(idx, 1.0) + 1.2816 * sigma AS revenue_upper,
  COALESCE(idx, 1.0) - 1.0 AS revenue_seasonal
FROM slots s JOIN fit f ON s.company = f.company JOIN spread p ON s.company = p.company
  LEFT JOIN season z ON s.company = z.company AND s.moy = z.moy""",
    "slots",
    "fit",
    "spread",
    "season",
)
_cte(
    "regressors",
    """
SELECT s.company, s.date, s.step,
  CASE WHEN s.step = 0 THEN COALESCE(m.inflation_rate, a.i) ELSE l.inflation_rate END AS inflation_rate,
  CASE WHEN s.step = 0 THEN COALESCE(m.interest_rate, a.r) ELSE l.interest_rate END AS interest_rate
FROM slots s JOIN fit f ON s.company = f.company
  JOIN (SELECT company, AVG(inflation_rate) AS i, AVG(interest_rate) AS r, MAX(p.date) AS known
    FROM past p JOIN macro m ON p.date = m.date GROUP BY company) a ON s.company = a.company
  LEFT JOIN past p ON s.company = p.company AND s.date = p.date
  LEFT JOIN macro m ON p.date = m.date LEFT JOIN macro l ON l.date = a.known""",
    "slots",
    "fit",
    "macro",
    "past",
)
_cte(
    "reg_units",
    """
SELECT s.company, MAX(ABS(revenue)) AS scale,
  AVG(inflation_rate) AS i_mean, AVG(interest_rate) AS r_mean,
  CASE WHEN MAX(inflation_rate) > MIN(inflation_rate) THEN STDDEV_POP(inflation_rate) ELSE 1 END AS i_spread,
  CASE WHEN MAX(interest_rate) > MIN(interest_rate) THEN STDDEV_POP(interest_rate) ELSE 1 END AS r_spread
FROM slots s JOIN regressors g ON s.company = g.company AND s.date = g.date
WHERE s.step = 0 AND revenue IS NOT NULL GROUP BY s.company""",
    "slots",
    "regressors",
)
_cte(
    "reg_rows",
    """
SELECT company, date, step, revenue, scale, y, e,
  list_concat([1::DOUBLE, t], list_transform(range(1, 13), lambda k: GREATEST(t - 0.8::DOUBLE * k / 12, 0))) AS x
FROM (SELECT s.company, s.date, s.step, revenue, scale, revenue / scale AS y, t / GREATEST(n - 1, 1) AS t,
    list_concat(
      flatten(list_transform(range(1, 5), lambda k: [SIN(2 * PI() * k * (moy - 1) / 12), COS(2 * PI() * k * (moy - 1) / 12)])),
      [(inflation_rate - i_mean) / i_spread, (interest_rate - r_mean) / r_spread]) AS e
  FROM slots s JOIN fit f ON s.company = f.company JOIN reg_units u ON s.company = u.company
    JOIN regressors g ON s.company = g.company AND s.date = g.date) q""",
    "slots",
    "fit",
    "reg_units",
    "regressors",
)


def _ridge(name: str, rows: str, row: str, n: int, penalty: str) -> None:
    """Weights ``w`` per company: normal equations summed cell by cell, then eliminated (Gauss, Jordan).

    ``row`` has ``n`` values and the target; ``penalty`` is SQL of the column number ``i``.
    """
    _cte(
        name,
        f"""
WITH RECURSIVE cells AS (
  SELECT company, i, j, SUM(v[i] * v[j]) + CASE WHEN i = j THEN {penalty} ELSE 0 END AS c
  FROM (SELECT company, {row} AS v FROM {rows} WHERE y IS NOT NULL) r
    CROSS JOIN range(1, {n + 1}) a(i) CROSS JOIN range(1, {n + 2}) b(j) GROUP BY company, i, j),
steps AS (
  SELECT company, 0 AS k, LIST(line ORDER BY i) AS m
  FROM (SELECT company, i, LIST(c ORDER BY j) AS line FROM cells GROUP BY company, i) lines GROUP BY company
  UNION ALL
  SELECT company, k + 1, list_transform(m, lambda r, i: CASE
    WHEN i = k + 1 THEN list_transform(r, lambda v: v / r[k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
  FROM steps WHERE k < {n})
SELECT company, list_transform(m, lambda r: r[{n + 1}]) AS w FROM steps WHERE k = {n}""",
        rows,
    )


_ridge("reg_line", "reg_rows", "list_append(x, y)", 14, "CASE WHEN i <= 2 THEN 1e-9 ELSE 1 / 0.15::DOUBLE END")
_cte(
    "reg_trends",
    """
SELECT r.*, list_dot_product(x, w) AS trend,
  y / CASE WHEN ABS(list_dot_product(x, w)) > 1e-9 THEN list_dot_product(x, w) ELSE 1e-9 END - 1 AS off
FROM reg_rows r JOIN reg_line l ON r.company = l.company""",
    "reg_rows",
    "reg_line",
)
_ridge("reg_effects", "reg_trends", "list_append(e, off)", 10, "0.01::DOUBLE")
_cte(
    "reg_fitted",
    """
SELECT company, date, step, f * scale AS revenue_forecast, trend * scale AS revenue_trend, revenue_seasonal,
  (f - 1.2816::DOUBLE * sigma) * scale AS revenue_lower, (f + 1.2816::DOUBLE * sigma) * scale AS revenue_upper
FROM (SELECT *, STDDEV_SAMP(y - f) OVER (PARTITION BY company) AS sigma
  FROM (SELECT r.*, trend * (1 + list_dot_product(e, w)) AS f, list_dot_product(e[1:8], w[1:8]) AS revenue_seasonal
    FROM reg_trends r JOIN reg_effects u ON r.company = u.company) a) b""",
    "reg_trends",
    "reg_effects",
)
_RATIOS = {
    "cogs_ratio": "cogs", "opex_ratio": "opex", "rd_ratio": "rd_expense", "sga_ratio": "sga_expense",
}
_cte(
    "ratio_fit",
    "SELECT company, "
    + ", ".join(
        f"AVG({n} / NULLIF(revenue, 0)) AS {r}_m, "
        f"REGR_SLOPE({n} / NULLIF(revenue, 0), t) AS {r}_b, "
        f"REGR_INTERCEPT({n} / NULLIF(revenue, 0), t) AS {r}_a"
        for r, n in _RATIOS.items()
    )
    + """, AVG(depreciation) / NULLIF(AVG(revenue), 0) AS depr_ratio,
  AVG(interest_expense) AS interest_mean,
  AVG(accounts_receivable / NULLIF(revenue, 0) * 30) AS dso_mean,
  AVG(inventory / NULLIF(cogs, 0) * 30) AS dio_mean,
  AVG(accounts_payable / NULLIF(cogs, 0) * 30) AS dpo_mean,
  AVG(capex / NULLIF(revenue, 0)) AS capex_ratio
FROM series GROUP BY company""",
    "series",
)


def _held(r: str) -> str:
    line = f"{r}_a + {r}_b * t"
    return (
        f"CASE WHEN {line} < {r}_m - 0.03 THEN {r}_m - 0.03 "
        f"WHEN {line} > {r}_m + 0.03 THEN {r}_m + 0.03 ELSE {line} END AS {r}_raw"
    )


_cte(
    "ratios",
    "SELECT f.*, "
    + ", ".join(_held(r) for r in _RATIOS)
    + ", depr_ratio, interest_mean, dso_mean, dio_mean, dpo_mean, capex_ratio"
    + " FROM fitted f JOIN ratio_fit r ON f.company = r.company",
    "fitted",
    "ratio_fit",
)
_cte(
    "ramped",
    """
SELECT *, cogs_ratio_raw * (CAST(1 AS DOUBLE) - CAST(0.03 AS DOUBLE) * (CAST(step - 1 AS DOUBLE) / 35)) AS cogs_ratio_hat,
  opex_ratio_raw * (CAST(1 AS DOUBLE) - CAST(0.05 AS DOUBLE) * (CAST(step - 1 AS DOUBLE) / 35)) AS opex_ratio_hat
FROM ratios WHERE step > 0""",
    "ratios",
)
_cte(
    "pnl_lines",
    """
SELECT company, date, step, dso_mean, dio_mean, dpo_mean, capex_ratio,
  revenue_lower, revenue_upper, revenue_trend, revenue_forecast AS rev,
  revenue_forecast * cogs_ratio_hat AS c, revenue_forecast * opex_ratio_hat AS o,
  revenue_forecast * rd_ratio_raw AS r, revenue_forecast * sga_ratio_raw AS s,
  revenue_forecast * depr_ratio AS dep, interest_mean AS i FROM ramped""",
    "ramped",
)
_cte(
    "pnl",
    """
SELECT company, date, step, dso_mean, dio_mean, dpo_mean, capex_ratio,
  revenue_lower, revenue_upper, revenue_trend,
  ROUND(rev, 2) AS revenue, ROUND(c, 2) AS cogs, ROUND(rev - c, 2) AS gross_profit,
  ROUND(o, 2) AS opex, ROUND(r, 2) AS rd_expense, ROUND(s, 2) AS sga_expense,
  ROUND(eb, 2) AS ebitda, ROUND(dep, 2) AS depreciation, ROUND(eb - dep, 2) AS ebit,
  ROUND(i, 2) AS interest_expense, ROUND(eb - dep - i, 2) AS ebt, ROUND(tax, 2) AS tax_expense,
  ROUND(eb - dep - i - tax, 2) AS net_income,
  ROUND((rev - c) / NULLIF(rev, 0), 4) AS gross_margin, ROUND(eb / NULLIF(rev, 0), 4) AS ebitda_margin,
  ROUND((eb - dep - i - tax) / NULLIF(rev, 0), 4) AS net_margin
FROM (SELECT *, CASE WHEN eb - dep - i > 0 THEN (eb - dep - i) * 0.28 ELSE 0 END AS tax
  FROM (SELECT *, rev - c - o - r - s AS eb FROM pnl_lines) x) y""",
    "pnl_lines",
)
_cte(
    "wc",
    """
SELECT *, revenue / 30 * dso_mean AS ar, cogs / 30 * dio_mean AS inv, cogs / 30 * dpo_mean AS ap,
  revenue * capex_ratio AS cx FROM pnl""",
    "pnl",
)
_cte(
    "cash",
    """
SELECT *, net_income + depreciation - build AS cfo_raw, net_income + depreciation - build - cx AS fcf_raw
FROM (SELECT *, COALESCE((ar + inv - ap) - LAG(ar + inv - ap)
    OVER (PARTITION BY company ORDER BY date), 0) AS build FROM wc) w""",
    "wc",
)
_cte(
    "gold_m",
    """
SELECT company, date, revenue, cogs, gross_profit, opex, rd_expense, sga_expense, ebitda,
  depreciation, ebit, interest_expense, ebt, tax_expense, net_income, gross_margin,
  ebitda_margin, net_margin, depreciation AS depreciation_addback, ROUND(-build, 2) AS change_in_wc,
  ROUND(cfo_raw, 2) AS cfo, ROUND(-cx, 2) AS capex, ROUND(fcf_raw, 2) AS fcf,
  ROUND(SUM(fcf_raw) OVER (PARTITION BY company ORDER BY date), 2) AS cumulative_cash,
  ROUND(ar, 2) AS accounts_receivable, ROUND(inv, 2) AS inventory, ROUND(ap, 2) AS accounts_payable,
  revenue_lower, revenue_upper, revenue_trend, TRUE AS is_forecast, forecast_date
FROM cash CROSS JOIN (""" + MADE_ON + """) f(forecast_date)""",
    "cash",
)
_cte(
    "gold_a",
    "SELECT company, CAST(EXTRACT(year FROM date) AS INTEGER) AS year, "
    + ", ".join(f"SUM({c}) AS {c}" for c in PNL + ("cfo", "capex", "fcf"))
    + ", "
    + ", ".join(f"AVG({c}) AS {c}" for c in ("gross_margin", "ebitda_margin", "net_margin"))
    + ", "
    + ", ".join(
        f"arg_max_null({c}, date) AS {c}"
        for c in ("accounts_receivable", "inventory", "accounts_payable")
    )
    + ", TRUE AS is_forecast FROM gold_m GROUP BY 1, 2",
    "gold_m",
)
_cte(
    "cases",
    "SELECT * FROM (VALUES ('Base', 1.00, 0.000), ('Bull', 1.12, 0.020), ('Bear', 0.88, -0.025)) v(scenario, ra, ma)",
)
_cte(
    "scen",
    """
SELECT company, year, scenario, revenue * CAST(ra AS DOUBLE) AS revenue, cogs,
  revenue * CAST(ra AS DOUBLE) * (gross_margin + CAST(ma AS DOUBLE)) AS gross_profit,
  opex, rd_expense, sga_expense,
  revenue * CAST(ra AS DOUBLE) * (ebitda_margin + CAST(ma AS DOUBLE) * 0.7) AS ebitda,
  depreciation, ebit, interest_expense, ebt, tax_expense,
  revenue * CAST(ra AS DOUBLE) * (net_margin + CAST(ma AS DOUBLE) * 0.5) AS net_income,
  cfo, capex, revenue * CAST(ra AS DOUBLE) * (net_margin + CAST(ma AS DOUBLE) * 0.5) * 0.85 AS fcf,
  gross_margin, ebitda_margin, net_margin, accounts_receivable, inventory, accounts_payable
FROM gold_a CROSS JOIN cases""",
    "gold_a",
    "cases",
)

# ---------------------------------------------------------------- statements
_KEEP = ", ".join(AMOUNTS)
_cte(
    "years",
    f"""
SELECT company, 'Base' AS scenario, year, FALSE AS is_forecast, {_KEEP} FROM hist
UNION ALL SELECT company, 'Base', year, TRUE, {_KEEP} FROM gold_a""",
    "hist",
    "gold_a",
)
_cte(
    "scen_years",
    f"""
SELECT company, scenario, year, FALSE AS is_forecast, {_KEEP} FROM hist CROSS JOIN cases
UNION ALL SELECT company, scenario, year, TRUE, {_KEEP} FROM scen""",
    "hist",
    "cases",
    "scen",
)


def _statements(name: str, source: str) -> None:
    w = "(PARTITION BY company, scenario ORDER BY year, is_forecast)"
    _cte(
        f"{name}_income",
        f"""
SELECT *, CASE WHEN is_forecast THEN 'Forecast (' || scenario || ')' ELSE 'Historical' END AS period_type,
  gross_profit / NULLIF(revenue, 0) AS gross_margin, ebitda / NULLIF(revenue, 0) AS ebitda_margin,
  ebit / NULLIF(revenue, 0) AS ebit_margin, net_income / NULLIF(revenue, 0) AS net_margin,
  tax_expense / NULLIF(ebt, 0) AS tax_rate,
  (revenue - LAG(revenue) OVER {w}) / NULLIF(LAG(revenue) OVER {w}, 0) AS revenue_growth,
  ROW_NUMBER() OVER {w} - 1 AS i
FROM {source}""",
        source,
    )
    # the floored recurrence as an explicit walk over the years
    _cte(
        f"{name}_opening",
        f"""
SELECT company, scenario, arg_min_null(capex, year) AS capex0, arg_min_null(revenue, year) AS rev0,
  AVG(interest_expense) AS interest0
FROM {source} WHERE NOT is_forecast GROUP BY company, scenario""",
        source,
    )
    _cte(
        f"{name}_ppe",
        f"""
SELECT s.company, s.scenario, s.i,
  list_reduce(
    list_prepend(4 * o.capex0,
      list(COALESCE(ABS(p.capex) - p.depreciation, 0) ORDER BY p.i) FILTER (p.i BETWEEN 1 AND s.i)),
    lambda x, y: GREATEST(x + y, 0)) AS net_ppe
FROM {name}_income s JOIN {name}_opening o ON s.company = o.company AND s.scenario = o.scenario
  JOIN {name}_income p ON s.company = p.company AND s.scenario = p.scenario
GROUP BY s.company, s.scenario, s.i, o.capex0""",
        f"{name}_income",
        f"{name}_opening",
    )
    _cte(
        f"{name}_balance",
        f"""
SELECT *, ABS(total_assets - (total_liabilities + total_equity)) AS bs_balance_check
FROM (SELECT *, cash + accounts_receivable + inventory AS current_assets,
    cash + accounts_receivable + inventory + net_ppe AS total_assets
  FROM (SELECT *, CASE WHEN total_liabilities + total_equity - (accounts_receivable + inventory + net_ppe) < 0
      THEN 0 ELSE total_liabilities + total_equity - (accounts_receivable + inventory + net_ppe) END AS cash
    FROM (SELECT s.*, net_ppe, interest0 / 0.07 * 12 * POW(0.95, s.i) AS long_term_debt,
        accounts_payable + interest0 / 0.07 * 12 * POW(0.95, s.i) AS total_liabilities,
        SUM(0.7 * net_income) OVER (PARTITION BY s.company, s.scenario ORDER BY s.year, s.is_forecast) AS retained_earnings,
        0.3 * rev0 AS paid_in_capital,
        SUM(0.7 * net_income) OVER (PARTITION BY s.company, s.scenario ORDER BY s.year, s.is_forecast) + 0.3 * rev0 AS total_equity
      FROM {name}_income s JOIN {name}_opening o ON s.company = o.company AND s.scenario = o.scenario
        JOIN {name}_ppe p ON s.company = p.company AND s.scenario = p.scenario AND s.i = p.i) a) b) c""",
        f"{name}_income",
        f"{name}_opening",
        f"{name}_ppe",
    )
    _cte(
        name,
        f"""
SELECT *, ABS(net_cash_change - cash_change) AS cf_reconciliation, cash AS closing_cash
FROM (SELECT *, cfo + cfi + cff AS net_cash_change
  FROM (SELECT *, net_income + depreciation + cfo_d_ar + cfo_d_inv + cfo_d_ap AS cfo,
      -capex_outflow AS cfi, debt_change + dividends AS cff
    FROM (SELECT *, net_income AS cfo_net_income, depreciation AS cfo_dna,
        COALESCE(LAG(accounts_receivable) OVER {w} - accounts_receivable, 0) AS cfo_d_ar,
        COALESCE(LAG(inventory) OVER {w} - inventory, 0) AS cfo_d_inv,
        COALESCE(accounts_payable - LAG(accounts_payable) OVER {w}, 0) AS cfo_d_ap,
        COALESCE(net_ppe - LAG(net_ppe) OVER {w}, 0) + depreciation AS capex_outflow,
        COALESCE(long_term_debt - LAG(long_term_debt) OVER {w}, 0) AS debt_change,
        -0.3 * net_income AS dividends,
        COALESCE(cash - LAG(cash) OVER {w}, 0) AS cash_change
      FROM {name}_balance) a) b) c""",
        f"{name}_balance",
    )


_statements("stm", "years")
_statements("sstm", "scen_years")
_cte(
    "final_year",
    """
SELECT * FROM stm QUALIFY ROW_NUMBER() OVER (PARTITION BY company ORDER BY year DESC, is_forecast DESC) = 1""",
    "stm",
)
_cte(
    "checked",
    """
SELECT *, total_equity - LAG(total_equity) OVER w AS eq_step,
  ABS(retained_earnings - LAG(retained_earnings) OVER w - 0.7 * net_income) AS re_gap,
  ABS(ebitda - (gross_profit - opex - rd_expense - sga_expense)) AS eb_gap
FROM sstm WINDOW w AS (PARTITION BY company, scenario ORDER BY year, is_forecast)""",
    "sstm",
)

# serving variants of the balance sheet and cash flow
_cte(
    "serving_rows",
    """
SELECT *, COALESCE(accounts_receivable, 0.12 * revenue) AS ar, COALESCE(inventory, 0.08 * revenue) AS inv,
  COALESCE(accounts_payable, 0.06 * revenue) AS ap, ABS(COALESCE(capex, 0.05 * revenue)) AS cx,
  ABS(COALESCE(depreciation, 0.04 * revenue)) AS dep,
  ROW_NUMBER() OVER (PARTITION BY company ORDER BY year, is_forecast) - 1 AS i FROM years""",
    "years",
)
_cte(
    "serving_opening",
    """
SELECT company, arg_min_null(revenue, year) AS rev0, AVG(interest_expense) AS interest0
FROM years GROUP BY company""",
    "years",
)
_cte(
    "serving_ppe",
    """
SELECT s.company, s.i, list_reduce(
    list_prepend(0.4 * o.rev0, list(p.cx - p.dep ORDER BY p.i) FILTER (p.i BETWEEN 1 AND s.i)),
    lambda x, y: GREATEST(x + y, 0)) AS net_ppe
FROM serving_rows s JOIN serving_opening o ON s.company = o.company
  JOIN serving_rows p ON s.company = p.company GROUP BY s.company, s.i, o.rev0""",
    "serving_rows",
    "serving_opening",
)
_cte(
    "serving",
    """
SELECT *, cash + ar + inv AS current_assets, cash + ar + inv + net_ppe AS total_assets,
  ABS(cash + ar + inv + net_ppe - total_liabilities - total_equity) AS bs_balance_check
FROM (SELECT *, CASE WHEN total_equity + total_liabilities - (ar + inv + net_ppe) < 0 THEN 0
    ELSE total_equity + total_liabilities - (ar + inv + net_ppe) END AS cash
  FROM (SELECT *, retained_earnings + paid_in_capital AS total_equity, ap + long_term_debt AS total_liabilities
    FROM (SELECT s.*, net_ppe, interest0 / 0.07 * 12 * POW(0.95, s.i) AS long_term_debt, 0.25 * rev0 AS paid_in_capital,
        SUM(0.7 * net_income) OVER (PARTITION BY s.company ORDER BY s.year, s.is_forecast) AS retained_earnings
      FROM serving_rows s JOIN serving_opening o ON s.company = o.company
        JOIN serving_ppe p ON s.company = p.company AND s.i = p.i) a) b) c""",
    "serving_rows",
    "serving_opening",
    "serving_ppe",
)
_cte(
    "serving_cash",
    """
SELECT *, SUM(net_cash_change) OVER (PARTITION BY company ORDER BY year, is_forecast) AS cumulative_cash
FROM (SELECT *, cfo + cfi + cff AS net_cash_change
  FROM (SELECT *, debt_change + dividends AS cff
    FROM (SELECT *, net_income + dep + COALESCE(LAG(ar) OVER w - ar, 0) + COALESCE(LAG(inv) OVER w - inv, 0)
          + COALESCE(ap - LAG(ap) OVER w, 0) AS cfo,
        -cx AS cfi, -0.3 * net_income AS dividends,
        COALESCE(long_term_debt - LAG(long_term_debt) OVER w, 0) AS debt_change
      FROM serving WINDOW w AS (PARTITION BY company ORDER BY year, is_forecast)) a) b) c""",
    "serving",
)

# forecast error on the last 12 months
_cte(
    "cut",
    """
SELECT s.*, s.date <= f.last_date - INTERVAL 12 MONTH AS seen
FROM series s JOIN fit f ON s.company = f.company""",
    "series",
    "fit",
)
_cte(
    "tfit",
    """
SELECT company, REGR_SLOPE(revenue, t) AS b, REGR_INTERCEPT(revenue, t) AS a
FROM cut WHERE seen GROUP BY company""",
    "cut",
)
_cte(
    "mape",
    """
SELECT s.company, AVG(ABS((revenue - (a + b * t) * COALESCE(idx, 1)) / NULLIF(revenue, 0))) AS mape,
  COUNT(revenue) AS n_months
FROM cut s JOIN tfit f ON s.company = f.company
  LEFT JOIN (SELECT c.company, moy, AVG(revenue / NULLIF(a + b * t, 0)) AS idx
    FROM cut c JOIN tfit g ON c.company = g.company WHERE seen GROUP BY c.company, moy) z
    ON s.company = z.company AND s.moy = z.moy
WHERE NOT seen GROUP BY s.company""",
    "cut",
    "tfit",
)

# ---------------------------------------------------------------- logs
_cte(
    "ev",
    "SELECT *, CASE WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events",
)
_cte(
    "audit",
    """
SELECT 'run_' || user_id AS run_id,
  CASE WHEN event_type = 'purchase' THEN 'pipeline_complete' ELSE 'stage_event' END AS event_type,
  event_type AS stage, 'events' AS table_name, CAST(1 AS BIGINT) AS rows_affected,
  'Pipeline ' || status || ' in ' || format('{:.2f}', value) || 's' AS message,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS severity,
  '{"event_id":' || event_id || ',"status":"' || status || '"}' AS metadata_json, ts AS recorded_at
FROM ev""",
    "ev",
)
_cte(
    "dqlog",
    """
SELECT 'run_' || strftime(day, '%Y%m%d') AS run_id, check_name, n AS rows_checked, failed AS rows_failed,
  ROUND(failed / n, 4) AS failure_pct, threshold, failed / n <= threshold AS passed,
  CAST(day AS TIMESTAMP) AS checked_at
FROM (SELECT CAST(ts AS DATE) AS day, 'gross_profit_identity' AS check_name, COUNT(*) AS n,
    COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS failed, 0.2 AS threshold FROM ev GROUP BY 1
  UNION ALL SELECT CAST(ts AS DATE), 'range_value_0_90', COUNT(*),
    COUNT(CASE WHEN value > 90 THEN 1 END), 0.01 FROM ev GROUP BY 1
  UNION ALL SELECT CAST(ts AS DATE), 'status_ok', COUNT(*),
    COUNT(CASE WHEN status = 'FAILED' THEN 1 END), 0.2 FROM ev GROUP BY 1) d""",
    "ev",
)
