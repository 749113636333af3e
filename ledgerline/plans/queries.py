"""One query per operator, each with its output columns and its SQL counterpart.

``columns`` lists the output; ``name:4`` rounds a double to 4 places on both
sides, since sums of doubles may differ in the last bits between engines. Exact
halves are common here (half a cent), so both sides first move a value away from
zero by a thousandth of the last place: last-bit noise then cannot split them.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc
from ledgerline.operators import kpis, monitoring, quality, reporting, statements, timeseries, valuation
from ledgerline.operators.regression_forecast import forecast_revenue_with_regressors
from ledgerline.plans.oracle import AMOUNTS, MADE_ON, PNL, with_ctes
from ledgerline.schemas import FINANCIAL_COLUMNS_DDL, get_schema, nullable_copy
from ledgerline.sources import layers, logs, tables
from ledgerline.plans import fixtures
from ledgerline.sources.financials import financials_and_macro, monthly_financials, monthly_macro

PERIODS = 36
AS_OF = dt.date(2001, 9, 1)
STAMP = "2001-09-01 00:00:00"
TODAY = dt.date(2024, 1, 31)
RUN_ID = "run_20010901_000000"

Build = Callable[[SparkSession, str], DataFrame]


@dataclasses.dataclass(frozen=True)
class Query:
    build: Build
    columns: str
    sql: str | None = None
    reads: tuple[str, ...] = ()
    #: Other bodies for some of the SQL's named expressions.
    instead: dict[str, tuple[str, tuple[str, ...]]] | None = None

    def _fields(self) -> list[tuple[str, int | None]]:
        parts = [c.split(":") for c in self.columns.split()]
        return [(p[0], int(p[1]) if len(p) > 1 else None) for p in parts]

    def run(self, spark: SparkSession, root: str) -> DataFrame:
        def shown(name: str, places: int | None):
            if places is None:
                return F.col(name)
            x = F.round(F.col(name) + F.signum(name) * 10.0 ** -(places + 3), places)
            return F.when(x == 0, F.lit(0.0)).otherwise(x).alias(name)

        return self.build(spark, root).select(*[shown(*f) for f in self._fields()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None

        def shown(name: str, places: int | None) -> str:
            if places is None:
                return name
            nudge = f"CAST(1e-{places + 3} AS DOUBLE)"
            x = f"ROUND(CAST({name} AS DOUBLE) + SIGN({name}) * {nudge}, {places})"
            return f"CASE WHEN {x} = 0 THEN CAST(0 AS DOUBLE) ELSE {x} END AS {name}"

        fields = ", ".join(shown(*f) for f in self._fields())
        return with_ctes(f"SELECT {fields} FROM ({self.sql}) result", *self.reads, instead=self.instead)


QUERIES: dict[str, Query] = {}


def _register(name: str, columns: str, sql: str | None = None, reads: str = "", instead: dict | None = None):
    def wrap(build: Build) -> Build:
        QUERIES[name] = Query(build, columns, sql, tuple(reads.split()), instead)
        return build

    return wrap


def _cols(names, places: int) -> str:
    return " ".join(f"{n}:{places}" for n in names)


# Inputs shared by the queries below.


def _fin(spark, root):
    return monthly_financials(spark, root, "nation")


def _silver(spark, root):
    months, macro = financials_and_macro(spark, root, "nation")
    return kpis.silver_monthly(quality.silver_validate(quality.clean_rows(months)), macro)


def _end(spark, root) -> dt.date:
    """The month that history ends in: that of the last order; one value from one column."""
    last = tables.star_table(spark, root, "orders").agg(F.trunc(F.max("o_orderdate"), "month"))
    return last.first()[0] or AS_OF


def _made_on(end: dt.date) -> dt.date:
    """The first forecast month."""
    return (end + dt.timedelta(days=31)).replace(day=1)


def _gold_monthly(spark, root):
    end = _end(spark, root)
    return fc.gold_monthly(_fin(spark, root), PERIODS, _made_on(end), until=end)


def _layers(spark, root):
    """History, yearly forecast and scenarios: parts of one plan, which shares its shuffles."""
    years = _model_years(spark, root)
    gold = years.filter("is_forecast")
    return years.filter("NOT is_forecast"), gold, fc.scenarios(gold)


def _years(spark, root):
    """All years in one pass; a margin of history is a mean of months and has a name of its own."""
    history = kpis.unit_economics(_fin(spark, root))
    years = fc.model_years(history, PERIODS, until=_end(spark, root), means=("revenue_per_customer",))
    future, names = F.col("is_forecast"), ("gross_margin", "ebitda_margin", "net_margin")
    return years.withColumnRenamed("revenue_per_customer", "arpu").withColumns(
        {f"{c}_avg": F.when(~future, F.col(c)) for c in names}
        | {c: F.when(future, F.col(c)) for c in names}
        | {"period_type": F.when(future, "Forecast").otherwise("Historical")}
    )


def _model_years(spark, root):
    return fc.model_years(_fin(spark, root), PERIODS, until=_end(spark, root))


def _statements(spark, root):
    return statements.three_statements(_model_years(spark, root))


def _scenario_statements(spark, root):
    return statements.three_statements(fc.scenarios(_model_years(spark, root)))


def _gold_annual(spark, root):
    return fc.gold_annual(_gold_monthly(spark, root))


def _scenarios(spark, root):
    return fc.scenarios(_gold_annual(spark, root))


# ------------------------------------------------------------ sources and sinks

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp"


@_register(
    "scan_layer", "o_orderkey o_custkey o_orderstatus o_orderdate",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
)
def _(spark, root):
    from pyspark.sql import types as T

    return tables.scan_layer(spark, root, "orders.parquet", T.StructType.fromDDL(ORDER_SCHEMA))


@_register(
    "csv_roundtrip", "c_custkey c_name c_acctbal c_mktsegment",
    "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def _(spark, root):
    path = layers.scratch_path(spark, "customer_csv")
    layers.export_csv(
        tables.star_table(spark, root, "customer").select(
            "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
        ),
        path,
    )
    return tables.read_csv(spark, path)


@_register(
    "provenance_tag",
    "date inflation_rate interest_rate gdp_growth usd_zar unemployment "
    "_ingested_at _run_id _source _schema_version",
    f"""SELECT *, TIMESTAMP '{STAMP}' AS _ingested_at, '{RUN_ID}' AS _run_id,
      'orders' AS _source, 'v1.2' AS _schema_version FROM macro""",
    "macro",
)
def _(spark, root):
    return tables.tag_provenance(monthly_macro(spark, root), RUN_ID, "orders", "v1.2", STAMP)


def _daily_counts(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias("n_rows"))


@_register(
    "priority_merge", "date n_rows _source",
    """SELECT date, n_rows, _source FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY rank) AS rn FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n_rows, 'orders' AS _source, 1 AS rank
          FROM orders GROUP BY 1
        UNION ALL SELECT CAST(l_shipdate AS DATE), COUNT(*), 'shipments', 2 FROM lineitem GROUP BY 1
        UNION ALL SELECT CAST(ts AS DATE), COUNT(*), 'events', 3 FROM events GROUP BY 1) u) r
      WHERE rn = 1""",
)
def _(spark, root):
    return tables.priority_merge(
        [
            ("orders", _daily_counts(tables.star_table(spark, root, "orders"), "o_orderdate")),
            ("shipments", _daily_counts(tables.star_table(spark, root, "lineitem"), "l_shipdate")),
            ("events", _daily_counts(tables.star_table(spark, root, "events"), "ts")),
        ],
        ["date"],
    )


def _customers(spark, root):
    return tables.star_table(spark, root, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )


def _suppliers(spark, root):
    return tables.star_table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )


_CUSTOMERS_SQL = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
_SUPPLIERS_SQL = "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier"


@_register("write_overwrite", "id name balance", _CUSTOMERS_SQL)
def _(spark, root):
    path = layers.scratch_path(spark, "accounts")
    layers.overwrite(_suppliers(spark, root), path)
    layers.overwrite(_customers(spark, root), path)
    return spark.read.parquet(path)


@_register("write_append", "id name balance", f"{_CUSTOMERS_SQL} UNION ALL {_SUPPLIERS_SQL}")
def _(spark, root):
    path = layers.scratch_path(spark, "accounts")
    layers.append(_customers(spark, root), path)
    layers.append(_suppliers(spark, root), path)
    return spark.read.parquet(path)


def _order_years(spark, root):
    return tables.star_table(spark, root, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )


_ORDER_YEARS_SQL = (
    "SELECT o_orderkey, o_totalprice, CAST(EXTRACT(year FROM o_orderdate) AS INTEGER) AS year FROM orders"
)


@_register(
    "write_partitioned", "o_orderkey o_totalprice:2 year",
    f"""SELECT o_orderkey, CASE WHEN year >= 2000 THEN o_totalprice * 2 ELSE o_totalprice END
      AS o_totalprice, year FROM ({_ORDER_YEARS_SQL}) o""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "orders")
    rows = _order_years(spark, root)
    layers.write_partitioned(rows, path, ("year",))
    revised = rows.filter("year >= 2000").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    layers.write_partitioned(revised, path, ("year",))
    return spark.read.parquet(path)


@_register(
    "incremental_partitions", "o_orderkey o_totalprice:2 year",
    f"""SELECT o_orderkey, CASE WHEN year > 1998 THEN o_totalprice * 2 ELSE o_totalprice END
      AS o_totalprice, year FROM ({_ORDER_YEARS_SQL}) o""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "orders")
    rows = _order_years(spark, root)
    layers.write_incremental(spark, rows.filter("year <= 1998"), path, ("year",))
    later = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    layers.write_incremental(spark, later, path, ("year",))
    return spark.read.parquet(path)


@_register(
    "schema_enforce", " ".join(f.split()[0] for f in FINANCIAL_COLUMNS_DDL.split(", ")) + " _run_id",
    f"SELECT *, '{RUN_ID}' AS _run_id FROM fin", "fin",
)
def _(spark, root):
    tagged = tables.tag_provenance(_fin(spark, root), RUN_ID, "orders", "v1.2", STAMP)
    return layers.enforce_schema(tagged, get_schema("bronze_company_financials"))


@_register(
    "upsert_merge", "id name balance:2",
    """SELECT c_custkey AS id, c_name AS name,
      CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1000 ELSE c_acctbal END AS balance FROM customer
      UNION ALL SELECT -s_suppkey - 1, s_name, s_acctbal FROM supplier""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "accounts")
    layers.upsert_snapshot(spark, path, _customers(spark, root), ["id"], "run_1")
    changed = (
        tables.star_table(spark, root, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            (F.col("c_acctbal") + 1000).alias("balance"),
        )
    )
    added = _suppliers(spark, root).withColumn("id", -F.col("id") - 1)
    layers.upsert_snapshot(spark, path, changed.unionByName(added), ["id"], "run_2")
    try:  # sorts between the two as text, but is no later run
        layers.upsert_snapshot(spark, path, added.limit(1), ["id"], "run_10")
    except layers.StaleRun:
        return layers.read_snapshot(spark, path)
    raise AssertionError("a run that sorts before the newest one was accepted")


@_register(
    "snapshot_as_of", "o_custkey _run_id o_orderkey",
    """SELECT o_custkey, run AS _run_id, o_orderkey FROM (
      SELECT o_custkey, o_orderkey, strftime(o_orderdate, 'run_%Y%m%d') AS run,
        ROW_NUMBER() OVER (PARTITION BY o_custkey
          ORDER BY strftime(o_orderdate, 'run_%Y%m%d') DESC, o_orderkey DESC) AS rn
      FROM orders WHERE strftime(o_orderdate, 'run_%Y%m%d') <= 'run_20000101') s WHERE rn = 1""",
)
def _(spark, root):
    orders = tables.star_table(spark, root, "orders").select(
        "o_custkey", "o_orderkey",
        F.concat(F.lit("run_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("_run_id"),
    )
    return layers.as_of(orders, ["o_custkey"], "run_20000101")


@_register(
    "write_counts", "table_name rows_written",
    """SELECT 'customer' AS table_name, COUNT(*) AS rows_written FROM customer
      UNION ALL SELECT 'orders', COUNT(*) FROM orders
      UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem""",
)
def _(spark, root):
    written = [
        (t, layers.overwrite(tables.star_table(spark, root, t), layers.scratch_path(spark, t)))
        for t in ("customer", "orders", "lineitem")
    ]
    return spark.createDataFrame(written, "table_name string, rows_written bigint")


_PROFILE_NULLS = {
    "seg_full": (*AMOUNTS, "customers", "avg_revenue_per_user", "churn_rate"),
    "macro": ("inflation_rate", "interest_rate", "gdp_growth", "usd_zar", "unemployment"),
}


def _profile_sql(table: str, source: str) -> str:
    nulls = " + ".join(f"COUNT(*) - COUNT({c})" for c in _PROFILE_NULLS[source])
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS n_rows, {len(_PROFILE_NULLS[source])} + "
        f"{2 if source == 'seg_full' else 1} AS n_columns, {nulls} AS n_nulls, "
        f"MIN(date) AS min_date, MAX(date) AS max_date FROM {source}"
    )


@_register(
    "ingest_profile", "table_name n_rows n_columns n_nulls min_date max_date",
    _profile_sql("company_financials", "seg_full") + " UNION ALL "
    + _profile_sql("macro_indicators", "macro"),
    "seg_full macro",
)
def _(spark, root):
    return layers.ingest_profile(
        fixtures.reported_financials(spark, root), "company_financials"
    ).unionByName(layers.ingest_profile(monthly_macro(spark, root), "macro_indicators"))


# ------------------------------------------------------------ time series


def _segments(spark, root):
    return monthly_financials(spark, root, "nation_segment")


@_register("month_calendar", "company date is_gap", "SELECT company, date, is_gap FROM seg_full", "seg_full")
def _(spark, root):
    return timeseries.complete_months(_segments(spark, root)).select("company", "date", "is_gap")


@_register(
    "resample_month", "nation segment date o_totalprice:6",
    """SELECT g.nation, g.segment, g.date, m.o_totalprice FROM (
        SELECT nation, segment, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS date FROM (
          SELECT n_name AS nation, c_mktsegment AS segment, MIN(date_trunc('month', o_orderdate)) AS lo,
            MAX(date_trunc('month', o_orderdate)) AS hi
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          GROUP BY 1, 2) s) g
      LEFT JOIN (SELECT n_name AS nation, c_mktsegment AS segment,
          CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / COUNT(*) AS o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3) m
      ON g.nation = m.nation AND g.segment = m.segment AND g.date = m.date""",
)
def _(spark, root):
    orders = tables.star_table(spark, root, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    owners = (
        tables.star_table(spark, root, "customer")
        .join(tables.star_table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"))
    )
    joined = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"))
    return timeseries.resample_month(joined, ("nation", "segment"), "o_orderdate", "o_totalprice", scale=2)


@_register(
    "interpolate_linear", "company date revenue:4",
    """SELECT company, date, revenue FROM (
      SELECT a.company, CAST(make_date(a.year, 1, 1) + to_months(CAST(k AS INTEGER)) AS DATE) AS date,
        a.revenue + (b.revenue - a.revenue) * k / (12.0 * (b.year - a.year)) AS revenue
      FROM (SELECT *, LEAD(year) OVER (PARTITION BY company ORDER BY year) AS next_year FROM annual) a
        JOIN annual b ON a.company = b.company AND b.year = a.next_year
        CROSS JOIN generate_series(0, 1200) g(k) WHERE k < 12 * (b.year - a.year)
      UNION ALL SELECT company, make_date(year, 1, 1), revenue FROM (
        SELECT company, year, revenue, ROW_NUMBER() OVER (PARTITION BY company ORDER BY year DESC) AS rn
        FROM annual) z WHERE rn = 1) u""",
    "annual",
)
def _(spark, root):
    yearly = _fin(spark, root).groupBy("company", F.year("date").alias("year")).agg(
        F.sum("revenue").alias("revenue")
    )
    return timeseries.upsample_year_to_month(yearly, "revenue")


@_register(
    "interpolate_gaps", "company date accounts_receivable filled:4",
    """SELECT company, date, accounts_receivable,
      CASE WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL OR p1 = p0 THEN v0
        ELSE v0 + (v1 - v0) * (pos - p0) / CAST(p1 - p0 AS DOUBLE) END AS filled
      FROM (SELECT *,
        LAST_VALUE(known IGNORE NULLS) OVER (PARTITION BY company ORDER BY date) AS p0,
        LAST_VALUE(accounts_receivable IGNORE NULLS) OVER (PARTITION BY company ORDER BY date) AS v0,
        FIRST_VALUE(known IGNORE NULLS) OVER (PARTITION BY company ORDER BY date
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
        FIRST_VALUE(accounts_receivable IGNORE NULLS) OVER (PARTITION BY company ORDER BY date
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
        FROM (SELECT company, date, accounts_receivable, pos,
            CASE WHEN accounts_receivable IS NOT NULL THEN pos END AS known
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company ORDER BY date) AS pos FROM seg_full) a) b) c""",
    "seg_full",
)
def _(spark, root):
    return timeseries.interpolate_linear(
        timeseries.complete_months(_segments(spark, root)), "accounts_receivable", out="filled"
    )


@_register(
    "ffill_bfill", "company date accounts_receivable filled",
    """SELECT company, date, accounts_receivable, COALESCE(
        LAST_VALUE(accounts_receivable IGNORE NULLS) OVER (PARTITION BY company ORDER BY date),
        FIRST_VALUE(accounts_receivable IGNORE NULLS) OVER (PARTITION BY company ORDER BY date
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM seg_full""",
    "seg_full",
)
def _(spark, root):
    return timeseries.ffill_bfill(
        timeseries.complete_months(_segments(spark, root)), "accounts_receivable", out="filled"
    )


@_register(
    "pct_change_12", "company date pct_change:8",
    """SELECT company, date, (revenue / NULLIF(LAG(revenue, 12) OVER (PARTITION BY company ORDER BY date), 0) - 1)
      * 100 AS pct_change FROM seg_full""",
    "seg_full",
)
def _(spark, root):
    return timeseries.complete_months(_segments(spark, root)).withColumn(
        "pct_change", timeseries.pct_change("revenue", 12)
    )


@_register(
    "date_range_filter", "company date revenue",
    "SELECT company, date, revenue FROM fin WHERE date BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'",
    "fin",
)
def _(spark, root):
    return timeseries.date_range(_fin(spark, root), dt.date(1995, 1, 1), dt.date(2000, 12, 31))


@_register(
    "ramp_column", "company date usd_zar:8 fx_static",
    """SELECT company, date, CAST(17.5 AS DOUBLE) AS fx_static, 13.5 + COALESCE(CAST(19.2 - 13.5 AS DOUBLE) *
        (ROW_NUMBER() OVER (PARTITION BY company ORDER BY date) - 1)
        / NULLIF(COUNT(*) OVER (PARTITION BY company) - 1, 0), 0) AS usd_zar FROM fin""",
    "fin",
)
def _(spark, root):
    return _fin(spark, root).select(
        "company", "date", timeseries.ramp(13.5, 19.2).alias("usd_zar"), F.lit(17.5).alias("fx_static")
    )


@_register(
    "fill_mean", "company date accounts_receivable filled:4",
    """SELECT company, date, accounts_receivable, COALESCE(accounts_receivable,
      AVG(accounts_receivable) OVER (PARTITION BY company)) AS filled FROM seg""",
    "seg",
)
def _(spark, root):
    return _segments(spark, root).withColumn("filled", timeseries.fill_mean("accounts_receivable"))


_FIN_COLUMNS = " ".join(f.split()[0] for f in FINANCIAL_COLUMNS_DDL.split(", "))


@_register("monthly_financials", _FIN_COLUMNS, "SELECT * FROM fin", "fin")
def _(spark, root):
    return _fin(spark, root)


@_register("monthly_financials_by_segment", _FIN_COLUMNS, "SELECT * FROM seg", "seg")
def _(spark, root):
    return _segments(spark, root)


@_register(
    "monthly_macro", "date inflation_rate interest_rate gdp_growth usd_zar unemployment",
    "SELECT * FROM macro", "macro",
)
def _(spark, root):
    return monthly_macro(spark, root)


@_register(
    "pnl_cascade", "company date gross_profit:4 ebitda:4 ebit:4 ebt:4 tax_expense:4 net_income:4",
    """SELECT company, date, gross_profit, ebitda, ebit, ebt, tax_expense, ebt - tax_expense AS net_income
      FROM (SELECT *, CASE WHEN ebt > 0 THEN ebt * 0.28 ELSE 0 END AS tax_expense FROM (
        SELECT company, date, revenue - cogs AS gross_profit,
          revenue - cogs - opex - rd_expense - sga_expense AS ebitda,
          revenue - cogs - opex - rd_expense - sga_expense - depreciation AS ebit,
          revenue - cogs - opex - rd_expense - sga_expense - depreciation - interest_expense AS ebt
        FROM fin) a) b""",
    "fin",
)
def _(spark, root):
    drivers = ("revenue", "cogs", "opex", "rd_expense", "sga_expense", "depreciation", "interest_expense")
    return kpis.pnl_cascade(_fin(spark, root).select("company", "date", *drivers))


# ------------------------------------------------------------ data quality

_DQ = "table_name check_name check_type column_name rows_checked rows_failed failure_pct:4 threshold:4 passed"


def _rule_sql(name: str, kind: str, column: str, failed: str, threshold: float, source="reported",
              table=quality.FINANCIALS) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{kind}' AS check_type, "
        f"'{column}' AS column_name, COUNT(*) AS rows_checked, "
        f"COUNT(CASE WHEN {failed} THEN 1 END) AS rows_failed, "
        f"COUNT(CASE WHEN {failed} THEN 1 END) / GREATEST(COUNT(*), 1) AS failure_pct, "
        f"CAST({threshold} AS DOUBLE) AS threshold, "
        f"COUNT(CASE WHEN {failed} THEN 1 END) / GREATEST(COUNT(*), 1) <= {threshold} AS passed FROM {source}"
    )


def _null_sql(columns, prefix, threshold, source="reported", table=quality.FINANCIALS) -> str:
    return " UNION ALL ".join(
        _rule_sql(f"{prefix}_{c}", "null_check", c, f"{c} IS NULL", threshold, source, table)
        for c in columns
    )


def _range_sql(ranges, source="reported", table=quality.FINANCIALS) -> str:
    return " UNION ALL ".join(
        _rule_sql(f"range_{c}_{lo}_{hi}", "range", c, f"{c} < {lo} OR {c} > {hi}", th, source, table)
        for c, lo, hi, th in ranges
    )


_SOFT_FIN = (*[c for c in AMOUNTS if c not in quality.FINANCIALS_NOT_NULL],
             "avg_revenue_per_user", "churn_rate")
_SOFT_MACRO = ("inflation_rate", "interest_rate", "gdp_growth", "usd_zar", "unemployment")
_BUSINESS = {
    "dq_rule_gp_identity": _rule_sql(
        "gross_profit_identity", "business_rule", "gross_profit",
        "ABS(gross_profit - (revenue - cogs)) > 1.0", 0.0),
    "dq_rule_gm_bounds": _rule_sql(
        "gross_margin_bounds", "business_rule", "gross_margin",
        "gross_profit / NULLIF(revenue, 0) < 0.1 OR gross_profit / NULLIF(revenue, 0) > 0.95", 0.02),
    "dq_rule_rev_gt_cogs": _rule_sql(
        "revenue_gt_cogs", "business_rule", "revenue", "revenue <= cogs", 0.05),
    "dq_rule_ni_sign": _rule_sql(
        "net_income_sign_consistent", "business_rule", "net_income", "ebt > 0 AND net_income < 0", 0.0),
}
_FRESH = {
    t: f"""SELECT '{t}' AS table_name, 'data_freshness' AS check_name, 'freshness' AS check_type,
      'date' AS column_name, CAST(1 AS BIGINT) AS rows_checked, failed AS rows_failed,
      CAST(failed AS DOUBLE) AS failure_pct, CAST(0 AS DOUBLE) AS threshold, failed = 0 AS passed
      FROM (SELECT CAST(CASE WHEN COALESCE(date_diff('day', MAX(date), DATE '{AS_OF}'), 9999) > {days}
        THEN 1 ELSE 0 END AS BIGINT) AS failed FROM {source}) f"""
    for t, source, days in ((quality.FINANCIALS, "reported", 45), (quality.MACRO, "macro", 90))
}


def _dup_sql(table: str, source: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT '{table}' AS table_name, 'no_duplicates_{"_".join(keys)}' AS check_name,
      'duplicate' AS check_type, '{k}' AS column_name, n AS rows_checked, n - u AS rows_failed,
      (n - u) / GREATEST(n, 1) AS failure_pct, CAST(0 AS DOUBLE) AS threshold, n = u AS passed
      FROM (SELECT (SELECT COUNT(*) FROM {source}) AS n,
        (SELECT COUNT(*) FROM (SELECT DISTINCT {k} FROM {source}) d) AS u) c"""


_REFERENTIAL = f"""SELECT '{quality.FINANCIALS}' AS table_name, 'fin_dates_in_macro' AS check_name,
  'referential_integrity' AS check_type, 'date' AS column_name, n AS rows_checked, o AS rows_failed,
  o / GREATEST(n, 1) AS failure_pct, CAST(0.05 AS DOUBLE) AS threshold, o / GREATEST(n, 1) <= 0.05 AS passed
  FROM (SELECT COUNT(DISTINCT date) AS n,
    COUNT(DISTINCT CASE WHEN date NOT IN (SELECT date FROM macro) THEN date END) AS o FROM reported) c"""
_SCHEMA = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{check}' AS check_name, 'schema' AS check_type,
      'all_columns' AS column_name, CAST({n} AS BIGINT) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed,
      CAST(0 AS DOUBLE) AS failure_pct, CAST(0 AS DOUBLE) AS threshold, TRUE AS passed"""
    for t, n in ((quality.FINANCIALS, 22), (quality.MACRO, 6))
    for check in ("schema_columns_present", "schema_types_compatible")
)
_DQ_ALL = " UNION ALL ".join(
    [
        _SCHEMA,
        _null_sql(quality.FINANCIALS_NOT_NULL, "not_null", 0.0),
        _null_sql(_SOFT_FIN, "null_pct", 0.05),
        _null_sql(quality.MACRO_NOT_NULL, "not_null", 0.0, "macro", quality.MACRO),
        _null_sql(_SOFT_MACRO, "null_pct", 0.05, "macro", quality.MACRO),
        _dup_sql(quality.FINANCIALS, "reported", ["date", "company"]),
        _dup_sql(quality.MACRO, "macro", ["date"]),
        _range_sql(quality.FINANCIALS_RANGES),
        _range_sql(quality.MACRO_RANGES, "macro", quality.MACRO),
        *_BUSINESS.values(),
        *_FRESH.values(),
        _REFERENTIAL,
    ]
)


def _reported_and_macro(spark, root):
    fin, macro = financials_and_macro(spark, root, "nation_segment")
    return fixtures.as_reported(fin), macro


def _reported(spark, root):
    return fixtures.reported_financials(spark, root)


def _all_checks(spark, root):
    """Both tables are small next to their sources and read by several checks: stored once."""
    fin, macro = _reported_and_macro(spark, root)
    schemas = {t: get_schema(t) for t in (quality.FINANCIALS, quality.MACRO)}
    return quality.run_checks(fin, macro, AS_OF, schemas)


def _rules(spark, root, pick):
    df = _reported(spark, root)
    return quality.evaluate(df, quality.FINANCIALS, pick(df))


_ABSENT = str([c for c in _FIN_COLUMNS.split() if c != "revenue"]).replace("'", "''")

_ORDER_COLUMNS = str(
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
).replace("'", "''")


@_register(
    "dq_schema", f"{_DQ} details",
    " UNION ALL ".join(
        f"""SELECT 'orders' AS table_name, '{check}' AS check_name, 'schema' AS check_type,
          'all_columns' AS column_name, CAST(22 AS BIGINT) AS rows_checked, CAST({bad} AS BIGINT) AS rows_failed,
          CAST({bad} AS DOUBLE) / 22 AS failure_pct, CAST(0 AS DOUBLE) AS threshold, FALSE AS passed,
          '{note}, rows: ' || COUNT(*) AS details FROM orders"""
        for check, bad, note in (
            ("schema_columns_present", 21, f"Missing: {_ABSENT}, Extra columns: {_ORDER_COLUMNS}"),
            ("schema_types_compatible", 1, "Wrong type: [''revenue'']"),
        )
    ),
)
def _(spark, root):
    orders = tables.star_table(spark, root, "orders").withColumn("revenue", F.col("o_orderstatus"))
    return quality.check_schema(orders, get_schema(quality.FINANCIALS), "orders")


@_register("dq_nulls_hard", _DQ, _null_sql(quality.FINANCIALS_NOT_NULL, "not_null", 0.0), "reported")
def _(spark, root):
    return _rules(spark, root, lambda d: quality.hard_null_rules(d, quality.FINANCIALS_NOT_NULL))


@_register("dq_nulls_soft", _DQ, _null_sql(_SOFT_FIN, "null_pct", 0.05), "reported")
def _(spark, root):
    return _rules(spark, root, lambda d: quality.soft_null_rules(d, quality.FINANCIALS_NOT_NULL))


@_register(
    "dq_duplicates", _DQ, _dup_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
)
def _(spark, root):
    lines = tables.star_table(spark, root, "lineitem")
    return quality.check_duplicates(lines, "lineitem", ["l_orderkey", "l_linenumber"])


@_register(
    "dq_duplicate_keys", "l_orderkey l_linenumber n_rows",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2
      HAVING COUNT(*) > 1 ORDER BY n_rows DESC, l_orderkey, l_linenumber LIMIT 5""",
)
def _(spark, root):
    return quality.duplicate_keys(
        tables.star_table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@_register("dq_ranges", _DQ, _range_sql(quality.FINANCIALS_RANGES), "reported")
def _(spark, root):
    return _rules(spark, root, lambda d: quality.range_rules(d, quality.FINANCIALS_RANGES))


def _register_business(key: str, rule_name: str) -> None:
    @_register(key, _DQ, _BUSINESS[key], "reported")
    def _(spark, root):
        return _rules(
            spark, root, lambda d: [r for r in quality.business_rules(d) if r.name == rule_name]
        )


for _key, _rule in (
    ("dq_rule_gp_identity", "gross_profit_identity"),
    ("dq_rule_gm_bounds", "gross_margin_bounds"),
    ("dq_rule_rev_gt_cogs", "revenue_gt_cogs"),
    ("dq_rule_ni_sign", "net_income_sign_consistent"),
):
    _register_business(_key, _rule)

_EXTENDED = (
    ("ebitda_identity", "ebitda", "ABS(ebitda - (gross_profit - opex - rd_expense - sga_expense)) > 1.0"),
    ("ebit_identity", "ebit", "ABS(ebit - (ebitda - depreciation)) > 1.0"),
    ("net_income_identity", "net_income", "ABS(net_income - (ebt - tax_expense)) > 1.0"),
    ("ebitda_margin_bounds", "ebitda_margin",
     "ebitda / NULLIF(revenue, 0) < -0.5 OR ebitda / NULLIF(revenue, 0) > 0.8"),
    ("revenue_growth_bounds", "revenue", "yoy < -0.8 OR yoy > 2.0"),
    ("tax_non_negative", "tax_expense", "tax_expense < 0"),
    ("tax_rate_near_statutory", "tax_expense",
     "ebt > 0 AND ABS(tax_expense / NULLIF(ebt, 0) - 0.28) >= 0.01"),
)


@_register(
    "dq_rules_extended", _DQ,
    " UNION ALL ".join(
        _rule_sql(n, "business_rule", c, p, 0.0,
                  """(SELECT *, (revenue - LAG(revenue, 12) OVER w) / NULLIF(LAG(revenue, 12) OVER w, 0) AS yoy
                  FROM reported WINDOW w AS (PARTITION BY company ORDER BY date)) r""")
        for n, c, p in _EXTENDED
    ),
    "reported",
)
def _(spark, root):
    df = quality.with_yearly_growth(_reported(spark, root))
    return quality.evaluate(df, quality.FINANCIALS, quality.extended_rules())


@_register("dq_freshness", _DQ, " UNION ALL ".join(_FRESH.values()), "reported macro")
def _(spark, root):
    fin, macro = _reported_and_macro(spark, root)
    return quality.evaluate(fin, quality.FINANCIALS, [quality.freshness_rule(45, AS_OF)]).unionByName(
        quality.evaluate(macro, quality.MACRO, [quality.freshness_rule(90, AS_OF)])
    )


@_register(
    "dq_referential", _DQ,
    _REFERENTIAL,
    "reported macro",
)
def _(spark, root):
    return quality.check_referential(*_reported_and_macro(spark, root))


@_register(
    "dq_log", f"run_id {_DQ} checked_at",
    f"SELECT '{RUN_ID}' AS run_id, *, TIMESTAMP '{STAMP}' AS checked_at FROM ({_DQ_ALL}) q",
    "reported macro",
)
def _(spark, root):
    return quality.stamp_log(_all_checks(spark, root), RUN_ID, STAMP)


@_register(
    "dq_summary", "scope n_passed n_checks failed_checks summary",
    f"""SELECT scope, COUNT(CASE WHEN passed THEN 1 END) AS n_passed, COUNT(*) AS n_checks,
      COALESCE(STRING_AGG(CASE WHEN NOT passed THEN table_name || '.' || check_name END, ', '
        ORDER BY table_name || '.' || check_name), '') AS failed_checks,
      COUNT(CASE WHEN passed THEN 1 END) || '/' || COUNT(*) || ' checks passed' AS summary
      FROM (SELECT *, check_type AS scope FROM ({_DQ_ALL}) a
        UNION ALL SELECT *, 'overall' FROM ({_DQ_ALL}) b) q GROUP BY scope""",
    "reported macro",
)
def _(spark, root):
    return quality.summarize(_all_checks(spark, root))


_OK = "COALESCE(ABS(gross_profit - (revenue - cogs)) <= 1.0, FALSE)"
_POSITIVE = "COALESCE(revenue > 0, FALSE)"


@_register(
    "dq_tag_rows", "company date _dq_gross_profit_ok _dq_revenue_positive _dq_passed",
    f"""SELECT company, date, {_OK} AS _dq_gross_profit_ok, {_POSITIVE} AS _dq_revenue_positive,
      {_OK} AND {_POSITIVE} AS _dq_passed FROM reported""",
    "reported",
)
def _(spark, root):
    return quality.tag_rows(_reported(spark, root))


_REASON = f"""CASE WHEN gross_profit IS NULL OR revenue IS NULL OR cogs IS NULL THEN 'null_in_rule_input'
  WHEN NOT {_OK} THEN 'gross_profit_identity_failed' ELSE 'revenue_non_positive' END"""


@_register(
    "quarantine", "company date revenue gross_profit _quarantine_reason _quarantined_at _run_id",
    f"""SELECT company, date, revenue, gross_profit, {_REASON} AS _quarantine_reason,
      TIMESTAMP '{STAMP}' AS _quarantined_at, '{RUN_ID}' AS _run_id
      FROM reported WHERE NOT ({_OK} AND {_POSITIVE})""",
    "reported",
)
def _(spark, root):
    return quality.quarantine(_reported(spark, root), RUN_ID, stamped_at=STAMP)


@_register("clean_rows", _FIN_COLUMNS, f"SELECT * FROM reported WHERE {_OK} AND {_POSITIVE}", "reported")
def _(spark, root):
    return quality.clean_rows(_reported(spark, root))


@_register(
    "dq_gate", "rows_total rows_clean rows_quarantined fail_rate:8 abort",
    f"""SELECT *, rows_quarantined / GREATEST(rows_total, 1) AS fail_rate,
      rows_quarantined / GREATEST(rows_total, 1) > 0.1 AS abort
      FROM (SELECT COUNT(*) AS rows_total, COUNT(CASE WHEN {_OK} AND {_POSITIVE} THEN 1 END) AS rows_clean,
        COUNT(CASE WHEN NOT ({_OK} AND {_POSITIVE}) THEN 1 END) AS rows_quarantined FROM reported) g""",
    "reported",
)
def _(spark, root):
    return quality.gate(_reported(spark, root))


@_register(
    "silver_validate", "company date revenue cogs gross_profit",
    """SELECT company, date, revenue, cogs, gross_profit FROM reported
      WHERE revenue > 0 AND cogs < revenue AND ABS(gross_profit - (revenue - cogs)) < 1.0""",
    "reported",
)
def _(spark, root):
    return quality.silver_validate(_reported(spark, root))


@_register(
    "quarantine_reingest", "company date gross_profit:2 side",
    f"""SELECT company, date, 'clean' AS side, CASE WHEN {_OK} AND {_POSITIVE} THEN gross_profit
        ELSE revenue - cogs END AS gross_profit
      FROM reported WHERE revenue > 0 AND cogs IS NOT NULL
      UNION ALL SELECT company, date, 'quarantined', NULL FROM reported WHERE revenue IS NULL OR cogs IS NULL""",
    "reported",
)
def _(spark, root):
    fin = layers.materialize(_reported(spark, root))
    corrected = (
        quality.quarantine(fin, RUN_ID, stamped_at=STAMP)
        .withColumn("gross_profit", F.col("revenue") - F.col("cogs"))
        .select(*fin.columns)
    )
    clean, still_out = quality.reingest(quality.clean_rows(fin), corrected, RUN_ID)
    keep = ["company", "date", "gross_profit"]
    return clean.select(*keep, F.lit("clean").alias("side")).unionByName(
        still_out.select(*keep, F.lit("quarantined").alias("side"))
    )


# ------------------------------------------------------------ KPIs


def _register_kpi(key: str, columns: str, step: Callable[[DataFrame], DataFrame], calendar=False) -> None:
    names = [c.split(":")[0] for c in columns.split()]

    @_register(key, f"company date {columns}", f"SELECT company, date, {', '.join(names)} FROM kpi", "kpi")
    def _(spark, root):
        df = _fin(spark, root)
        if not calendar:
            return step(df)
        return step(timeseries.complete_months(df)).filter(~F.col("is_gap"))


_register_kpi("kpi_margins", "gross_margin:8 ebitda_margin:8 ebit_margin:8 net_margin:8", kpis.margins)
_register_kpi("kpi_cost_ratios", "cogs_ratio:8 opex_ratio:8 rd_ratio:8 sga_ratio:8", kpis.cost_ratios)
_register_kpi(
    "kpi_working_capital", "working_capital:4 dso:8 dio:8 dpo:8 cash_conversion_cycle:8",
    kpis.working_capital,
)
_register_kpi(
    "kpi_unit_economics", "revenue_per_customer:4 gross_profit_per_customer:4", kpis.unit_economics
)
_register_kpi("kpi_mom", "revenue_mom:8", kpis.revenue_mom, True)
_register_kpi("kpi_yoy", "revenue_yoy:8", kpis.yearly_growth, True)
_register_kpi("kpi_ni_yoy", "net_income_yoy:8", kpis.yearly_growth, True)
_register_kpi("kpi_ttm", "revenue_ttm:4", kpis.trailing_revenue, True)


@_register(
    "macro_join", "company date revenue inflation_rate interest_rate gdp_growth usd_zar unemployment",
    "SELECT * FROM silver", "silver",
)
def _(spark, root):
    return kpis.join_macro(*financials_and_macro(spark, root, "nation"))


@_register("kpi_real_growth", "company date real_revenue_growth:8", "SELECT * FROM silver", "silver")
def _(spark, root):
    return _silver(spark, root)


@_register("kpi_interest_coverage", "company date interest_coverage:6", "SELECT * FROM silver", "silver")
def _(spark, root):
    return _silver(spark, root)


@_register("date_parts", "company date year month quarter", "SELECT * FROM silver", "silver")
def _(spark, root):
    return kpis.date_parts(_fin(spark, root))


@_register("kpi_anomaly", "company date revenue_yoy:8 is_anomaly",
           """SELECT company, date, revenue_yoy, COALESCE(revenue_yoy < -0.8 OR revenue_yoy > 2.0, FALSE)
             AS is_anomaly FROM (SELECT company, date, is_gap,
               (revenue - LAG(revenue, 12) OVER w) / NULLIF(LAG(revenue, 12) OVER w, 0) AS revenue_yoy
             FROM seg_full WINDOW w AS (PARTITION BY company ORDER BY date)) k WHERE NOT is_gap""", "seg_full")
def _(spark, root):
    return kpis.flag_anomalies(kpis.monthly_kpis(_segments(spark, root)))


_SILVER_DOUBLES = (
    "gross_margin ebitda_margin ebit_margin net_margin cogs_ratio opex_ratio dso dio dpo "
    "cash_conversion_cycle revenue_mom revenue_yoy net_income_yoy real_revenue_growth"
).split()


@_register(
    "silver_monthly",
    f"company date year month quarter revenue net_income {_cols(_SILVER_DOUBLES, 8)} "
    "revenue_ttm:4 interest_coverage:6 customers churn_rate inflation_rate _run_id _schema_version",
    f"SELECT *, '{RUN_ID}' AS _run_id, 'v1.1' AS _schema_version FROM silver", "silver",
)
def _(spark, root):
    return kpis.to_silver_schema(_silver(spark, root), RUN_ID)


_ANNUAL = (
    f"company year {_cols(PNL, 4)} capex:4 gross_margin_avg:8 ebitda_margin_avg:8 net_margin_avg:8 "
    "accounts_receivable inventory accounts_payable working_capital:4 customers_eoy arpu:4 "
    "churn_rate_avg:8 inflation_rate_avg:8 interest_rate_avg:8 gdp_growth_avg:8"
)


@_register("annual_rollup", _ANNUAL, "SELECT * FROM annual", "annual")
def _(spark, root):
    return kpis.annual_rollup(_silver(spark, root))


@_register(
    "annual_summary",
    "company year revenue:4 gross_margin_avg:8 ebitda_margin_avg:8 net_margin_avg:8 customers_eoy",
    "SELECT * FROM annual", "annual",
)
def _(spark, root):
    return kpis.annual_summary(kpis.annual_rollup(_silver(spark, root)))


# ------------------------------------------------------------ forecasting

_FIT = ("revenue_forecast:4 revenue_lower:4 revenue_upper:4 revenue_trend:4 revenue_seasonal:8")


@_register("forecast_revenue", f"company date step {_FIT}", "SELECT * FROM fitted", "fitted")
def _(spark, root):
    return fc.forecast_revenue(_fin(spark, root), PERIODS, until=_end(spark, root))


_REG_FIT = "revenue_forecast:2 revenue_lower:2 revenue_upper:2 revenue_trend:2 revenue_seasonal:8"


@_register("forecast_revenue_reg", f"company date step {_REG_FIT}", "SELECT * FROM reg_fitted", "reg_fitted")
def _(spark, root):
    silver = kpis.join_macro(*financials_and_macro(spark, root, "nation"))
    return forecast_revenue_with_regressors(silver, PERIODS, _end(spark, root))


@_register(
    "forecast_revenue_reg_facts",
    "company n_history n_future first_date last_date history_kept ordered fits_better",
    """SELECT f.company, COUNT(CASE WHEN f.step = 0 THEN 1 END) AS n_history, COUNT(CASE WHEN f.step > 0 THEN 1 END) AS n_future,
        MIN(f.date) AS first_date, MAX(f.date) AS last_date, TRUE AS history_kept, TRUE AS ordered, TRUE AS fits_better
      FROM fitted f GROUP BY f.company""",
    "fitted",
)
def _(spark, root):
    """What is known of the regression without fitting it: its months, its input, its order.

    Over the months it has seen it may not be further off than a straight line is.
    """
    months, macro = financials_and_macro(spark, root, "nation")
    silver = kpis.join_macro(months, macro)
    fit = forecast_revenue_with_regressors(silver, PERIODS, _end(spark, root))
    line = fc.forecast_revenue(months, PERIODS, until=_end(spark, root)).select(
        "company", "date", F.col("revenue_trend").alias("line"), F.col("revenue").alias("given")
    )
    off = lambda c: F.sum((F.col(c) - F.col("given")) ** 2)
    past = F.col("step") == 0
    return fit.join(line, ["company", "date"], "left").groupBy("company").agg(
        F.count_if(past).alias("n_history"),
        F.count_if(~past).alias("n_future"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.bool_and(F.col("revenue").eqNullSafe(F.col("given"))).alias("history_kept"),
        F.bool_and(
            (F.col("revenue_lower") <= F.col("revenue_forecast")) & (F.col("revenue_forecast") <= F.col("revenue_upper"))
        ).alias("ordered"),
        (off("revenue_forecast") <= off("line")).alias("fits_better"),
    )


@_register(
    "regressor_extend", "company date step inflation_rate:8 interest_rate:8",
    "SELECT * FROM regressors",
    "regressors",
)
def _(spark, root):
    silver = kpis.join_macro(*financials_and_macro(spark, root, "nation"))
    return fc.extend_regressors(silver, periods=PERIODS, until=_end(spark, root))


@_register("forecast_horizon", f"company date {_FIT}", "SELECT * FROM fitted WHERE step > 0", "fitted")
def _(spark, root):
    return fc.horizon(fc.forecast_revenue(_fin(spark, root), PERIODS, until=_end(spark, root)))


_HATS = "cogs_ratio_hat:8 opex_ratio_hat:8 rd_ratio_hat:8 sga_ratio_hat:8"


@_register(
    "ratio_trend", f"company date {_HATS}",
    """SELECT company, date, cogs_ratio_raw AS cogs_ratio_hat, opex_ratio_raw AS opex_ratio_hat,
      rd_ratio_raw AS rd_ratio_hat, sga_ratio_raw AS sga_ratio_hat FROM ratios WHERE step > 0""",
    "ratios",
)
def _(spark, root):
    fitted = fc.forecast_revenue(_fin(spark, root), PERIODS, until=_end(spark, root))
    return fc.horizon(fc.ratio_trend(fitted))


@_register(
    "efficiency_ramp", f"company date {_HATS}",
    "SELECT *, rd_ratio_raw AS rd_ratio_hat, sga_ratio_raw AS sga_ratio_hat FROM ramped", "ramped",
)
def _(spark, root):
    return fc.horizon(fc.forecast_frame(_fin(spark, root), PERIODS, until=_end(spark, root)))


_MARGINS = "gross_margin:4 ebitda_margin:4 net_margin:4"


@_register("forecast_pnl", f"company date {_cols(PNL, 2)} {_MARGINS}", "SELECT * FROM pnl", "pnl")
def _(spark, root):
    frame = fc.horizon(fc.forecast_frame(_fin(spark, root), PERIODS, until=_end(spark, root)))
    return fc.project_pnl(frame)


@_register(
    "forecast_wc", "company date accounts_receivable:4 inventory:4 accounts_payable:4 capex:4",
    """SELECT company, date, ar AS accounts_receivable, inv AS inventory, ap AS accounts_payable,
      cx AS capex FROM wc""",
    "wc",
)
def _(spark, root):
    frame = fc.horizon(fc.forecast_frame(_fin(spark, root), PERIODS, until=_end(spark, root)))
    return fc.project_working_capital(fc.project_pnl(frame))


_CASH = "change_in_wc:2 cfo:2 capex:2 fcf:2 cumulative_cash:2"


@_register("forecast_cashflow", f"company date {_CASH}", "SELECT * FROM gold_m", "gold_m")
def _(spark, root):
    return _gold_monthly(spark, root)


@_register(
    "gold_monthly",
    f"company date {_cols(PNL, 2)} {_MARGINS} depreciation_addback:2 {_CASH} accounts_receivable:2 "
    "inventory:2 accounts_payable:2 revenue_lower:4 revenue_upper:4 revenue_trend:4 is_forecast forecast_date",
    "SELECT * FROM gold_m", "gold_m",
)
def _(spark, root):
    return _gold_monthly(spark, root)


_GOLD_ANNUAL = (
    f"company year {_cols(PNL, 2)} cfo:2 capex:2 fcf:2 gross_margin:8 ebitda_margin:8 net_margin:8 "
    "accounts_receivable:2 inventory:2 accounts_payable:2"
)


@_register("gold_annual", f"{_GOLD_ANNUAL} is_forecast", "SELECT * FROM gold_a", "gold_a")
def _(spark, root):
    return _gold_annual(spark, root)


_SCENARIO_MONEY = "revenue:4 gross_profit:4 ebitda:4 net_income:4 fcf:4"


@_register(
    "scenarios", f"company scenario year {_SCENARIO_MONEY} cogs:2 cfo:2 gross_margin:8 ebitda_margin:8",
    "SELECT * FROM scen", "scen",
)
def _(spark, root):
    return _scenarios(spark, root)


@_register(
    "scenarios_margin_adj",
    f"company scenario year {_SCENARIO_MONEY} gross_margin:8 ebitda_margin:8 net_margin:8",
    """SELECT s.* REPLACE (g.gross_profit AS gross_profit,
        g.ebitda_margin + CAST(ma AS DOUBLE) * 0.7 AS ebitda_margin,
        g.net_margin + CAST(ma AS DOUBLE) * 0.5 AS net_margin)
      FROM scen s JOIN gold_a g ON s.company = g.company AND s.year = g.year
        JOIN cases c ON c.scenario = s.scenario""",
    "scen gold_a cases",
)
def _(spark, root):
    return fc.scenarios(_gold_annual(spark, root), adjust_margins=True)


@_register(
    "gold_forecast_table",
    "company scenario year revenue:4 net_income:4 revenue_growth_yoy:8 forecast_model _forecast_date "
    "_run_id _schema_version",
    f"""SELECT s.*, (s.revenue - COALESCE(LAG(s.revenue) OVER w, h.revenue))
        / NULLIF(COALESCE(LAG(s.revenue) OVER w, h.revenue), 0) AS revenue_growth_yoy,
        'trend_x_month_index' AS forecast_model, ({MADE_ON}) AS _forecast_date,
        '{RUN_ID}' AS _run_id, 'v1.0' AS _schema_version
      FROM scen s LEFT JOIN (SELECT company, arg_max(revenue, year) AS revenue FROM hist GROUP BY company) h
        ON s.company = h.company
      WINDOW w AS (PARTITION BY s.company, s.scenario ORDER BY s.year)""",
    "scen hist",
)
def _(spark, root):
    hist, _, cases = _layers(spark, root)
    return fc.to_gold_schema(cases, hist, RUN_ID, _made_on(_end(spark, root)))


@_register(
    "forecast_mape", "company mape:8 n_months", "SELECT * FROM mape", "mape",
)
def _(spark, root):
    return fc.forecast_mape(_fin(spark, root), until=_end(spark, root))


@_register(
    "forecast_vs_actual", "company date revenue_forecast:2 revenue_actual:2 variance:2 variance_pct:6",
    """SELECT COALESCE(g.company, f.company) AS company, COALESCE(g.date, f.date) AS date,
        g.revenue AS revenue_forecast, f.revenue AS revenue_actual, f.revenue - g.revenue AS variance,
        (f.revenue - g.revenue) / NULLIF(f.revenue, 0) AS variance_pct
      FROM gold_m g FULL JOIN fin f ON g.company = f.company AND g.date = f.date""",
    "gold_m fin",
)
def _(spark, root):
    actual = layers.materialize(_fin(spark, root))
    end = _end(spark, root)
    forecast = fc.gold_monthly(actual, PERIODS, _made_on(end), until=end)
    return fc.forecast_vs_actual(forecast, actual)


# ------------------------------------------------------------ statements

_INCOME_RATIOS = "gross_margin:8 ebitda_margin:8 ebit_margin:8 net_margin:8"


@_register(
    "income_statement", f"company year period_type {_cols(PNL, 2)} {_INCOME_RATIOS}",
    "SELECT * FROM stm_income", "stm_income",
)
def _(spark, root):
    return statements.income_statement(_model_years(spark, root))


@_register("effective_tax_rate", "company year tax_rate:8", "SELECT * FROM stm_income", "stm_income")
def _(spark, root):
    return statements.income_statement(_model_years(spark, root))


@_register("revenue_growth", "company year revenue_growth:8", "SELECT * FROM stm_income", "stm_income")
def _(spark, root):
    return statements.income_statement(_model_years(spark, root))


@_register(
    "income_statement_scenarios",
    f"company scenario year period_type {_cols(PNL, 2)} {_INCOME_RATIOS} revenue_growth:8",
    "SELECT * FROM sstm_income", "sstm_income",
)
def _(spark, root):
    return statements.income_statement(fc.scenarios(_model_years(spark, root)))


@_register("net_ppe", "company year net_ppe:3", "SELECT * FROM stm", "stm")
def _(spark, root):
    return statements.net_ppe(_model_years(spark, root))


@_register("debt_schedule", "company year long_term_debt:3", "SELECT * FROM stm", "stm")
def _(spark, root):
    return statements.debt_schedule(_model_years(spark, root))


@_register("retained_earnings", "company year retained_earnings:4", "SELECT * FROM stm", "stm")
def _(spark, root):
    return statements.retained_earnings(_model_years(spark, root))


@_register(
    "equity_liabilities", "company year paid_in_capital:4 total_equity:4 total_liabilities:3",
    "SELECT * FROM stm", "stm",
)
def _(spark, root):
    return statements.balance_sheet(_model_years(spark, root))


_BALANCE = (
    "cash:3 accounts_receivable:2 inventory:2 current_assets:3 net_ppe:3 total_assets:3 "
    "accounts_payable:2 long_term_debt:3 total_liabilities:3 paid_in_capital:4 retained_earnings:4 "
    "total_equity:4"
)


@_register("balance_sheet", f"company year {_BALANCE}", "SELECT * FROM stm", "stm")
def _(spark, root):
    return statements.balance_sheet(_model_years(spark, root))


@_register("balance_check", "company year bs_balance_check:3", "SELECT * FROM stm", "stm")
def _(spark, root):
    return statements.balance_sheet(_model_years(spark, root))


_CASH_FLOW = (
    "cfo_net_income:2 cfo_dna:2 cfo_d_ar:2 cfo_d_inv:2 cfo_d_ap:2 cfo:2 capex_outflow:3 cfi:3 "
    "debt_change:3 dividends:4 cff:3 net_cash_change:3 closing_cash:3 cf_reconciliation:3"
)


@_register("cash_flow", f"company year period_type {_CASH_FLOW}", "SELECT * FROM stm", "stm")
def _(spark, root):
    return _statements(spark, root)


@_register("cfo", "company year cfo:2", "SELECT * FROM stm", "stm")
def _(spark, root):
    return _statements(spark, root)


@_register("cfi", "company year capex_outflow:3 cfi:3", "SELECT * FROM stm", "stm")
def _(spark, root):
    return _statements(spark, root)


@_register("cff", "company year debt_change:3 dividends:4 cff:3", "SELECT * FROM stm", "stm")
def _(spark, root):
    return _statements(spark, root)


@_register(
    "cash_reconciliation",
    "company mean_error:3 max_error:3 opening_error:3 mean_error_after_opening:3",
    """SELECT company, AVG(cf_reconciliation) AS mean_error, MAX(cf_reconciliation) AS max_error,
      MAX(CASE WHEN i = 0 THEN cf_reconciliation END) AS opening_error,
      AVG(CASE WHEN i > 0 THEN cf_reconciliation END) AS mean_error_after_opening FROM stm GROUP BY company""",
    "stm",
)
def _(spark, root):
    return statements.cash_reconciliation(_statements(spark, root))


def _check_sql(checks: list[tuple[str, str, str, bool]]) -> str:
    """A check holds if it holds in every year. A year in which it is unknown fails it.

    ``stepped`` checks compare with the year before, so the first year takes no part.
    """
    return " UNION ALL ".join(
        f"SELECT company, scenario, '{name}' AS check_name, "
        f"COUNT(*) FILTER (WHERE {'i > 0 AND ' if stepped else ''}({holds}) IS NOT TRUE) = 0 AS passed, "
        f"COALESCE(CAST({worst} AS DOUBLE), 0) AS worst FROM checked GROUP BY company, scenario"
        for name, holds, worst, stepped in checks
    )


@_register(
    "three_statement_checks", "company scenario check_name passed worst:3",
    _check_sql(
        [
            ("balance_sheet_balances", "bs_balance_check < 10", "MAX(bs_balance_check)", False),
            ("net_income_to_retained_earnings", "re_gap < 100", "MAX(re_gap)", True),
            ("all_revenues_positive", "revenue > 0", "MIN(revenue)", False),
            ("ebitda_consistency", "eb_gap < 100", "MAX(eb_gap)", False),
        ]
    ),
    "checked",
)
def _(spark, root):
    return statements.three_statement_checks(_scenario_statements(spark, root))


@_register(
    "statement_identities", "company scenario check_name passed worst:3",
    _check_sql(
        [
            (n, f"{g} < 10", f"MAX({g})", False)
            for n, g in (
                ("assets_are_current_plus_fixed", "ABS(total_assets - current_assets - net_ppe)"),
                ("current_assets_add_up", "ABS(current_assets - cash - accounts_receivable - inventory)"),
                ("net_change_adds_up", "ABS(net_cash_change - cfo - cfi - cff)"),
                ("closing_cash_on_balance_sheet", "ABS(closing_cash - cash)"),
                ("depreciation_agrees", "ABS(depreciation - cfo_dna)"),
            )
        ]
        + [
            ("cash_not_negative", "cash >= 0", "MIN(cash)", False),
            ("equity_grows", "eq_step > 0", "MIN(eq_step)", True),
            ("debt_below_assets", "long_term_debt - total_assets < 0", "MAX(long_term_debt - total_assets)", False),
            ("operating_cash_positive", "cfo > 0", "MIN(cfo)", False),
            ("investing_cash_negative", "cfi < 0", "MAX(cfi)", False),
        ]
    ),
    "checked",
)
def _(spark, root):
    return statements.statement_identities(_scenario_statements(spark, root))


def _report_sql() -> str:
    selects = []
    for name, layout in reporting.STATEMENTS:
        for no, (label, column, kind) in enumerate(layout, 1):
            places = 4 if kind == "pct" else 0
            value = "CAST(NULL AS DOUBLE)" if column is None else f"ROUND(CAST({column} AS DECIMAL(24,6)), {places})"
            text = label.replace("'", "''")
            selects.append(
                f"SELECT company, '{name}' AS statement, {no} AS line_no, '{text}' AS label, '{kind}' AS kind, "
                f"'y' || year AS year, arg_max_null({value}, is_forecast) AS value FROM stm GROUP BY company, year"
            )
    return " UNION ALL ".join(selects)


@_register(
    "statement_report",
    "company statement line_no label kind year value:4", _report_sql(), "stm",
)
def _(spark, root):
    """The printed layout as long rows: its year columns are those of the data."""
    stored = layers.materialize(_statements(spark, root))
    wide = reporting.statement_report(stored)
    heads = [c for c in wide.columns if re.fullmatch(r"y\d+", c)]
    cells = wide.unpivot(["company", "statement", "line_no", "label", "kind"], heads, "year", "value")
    known = stored.select("company", F.concat(F.lit("y"), "year").alias("year")).distinct()
    return cells.join(known, ["company", "year"], "left_semi")


def _matrix_sql() -> str:
    selects = []
    for no, (label, column, kind) in enumerate(reporting.SCENARIO_METRICS, 1):
        value = f"ROUND(CAST({column} AS DECIMAL(24,6)), {4 if kind == 'pct' else 0})"
        selects.append(
            f"SELECT company, {no} AS line_no, '{label}' AS metric, scenario || '_' || year AS head, {value} AS value FROM scen"
        )
    return " UNION ALL ".join(selects)


@_register("scenario_matrix", "company line_no metric head value:4", _matrix_sql(), "scen")
def _(spark, root):
    """The matrix as long rows: its columns are the scenarios and years of the data."""
    wide = reporting.scenario_matrix(layers.materialize(_scenarios(spark, root)))
    heads = [c for c in wide.columns if c not in ("company", "line_no", "metric")]
    return wide.unpivot(["company", "line_no", "metric"], heads, "head", "value")


# ------------------------------------------------------------ valuation and serving

_DCF_SQL = """SELECT company, scenario, pv_fcf, tv AS terminal_value, tv / POW({w} + 1, n) AS pv_terminal,
  pv_fcf + tv / POW({w} + 1, n) AS enterprise_value
  FROM (SELECT company, scenario, SUM(fcf / POW(1 + {w}, t)) AS pv_fcf, COUNT(*) AS n,
      arg_max(fcf, year) * (1 + {g}) / ({w} - {g}) AS tv
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company, scenario ORDER BY year) AS t FROM scen) s
    GROUP BY company, scenario) v"""
_DCF_BASE = _DCF_SQL.format(w="CAST(0.12 AS DOUBLE)", g="CAST(0.025 AS DOUBLE)")


@_register(
    "dcf",
    "company scenario pv_fcf:3 terminal_value:3 pv_terminal:3 enterprise_value:3 equity_value:3 "
    "pv_fcf_pct:8 pv_tv_pct:8 value_per_share:6",
    f"""SELECT *, enterprise_value - 1000000 AS equity_value, pv_fcf / NULLIF(enterprise_value, 0) AS pv_fcf_pct,
      pv_terminal / NULLIF(enterprise_value, 0) AS pv_tv_pct, (enterprise_value - 1000000) / 1000000 AS value_per_share
      FROM ({_DCF_BASE}) d""",
    "scen",
)
def _(spark, root):
    return valuation.dcf(_scenarios(spark, root), net_debt=1_000_000.0)


@_register(
    "dcf_schedule", "company scenario year t fcf:4 discount_factor:8 pv_fcf:4",
    """SELECT company, scenario, year, CAST(t AS INTEGER) AS t, fcf, 1 / POW(CAST(1.12 AS DOUBLE), t) AS discount_factor,
      fcf / POW(CAST(1.12 AS DOUBLE), t) AS pv_fcf
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company, scenario ORDER BY year) AS t FROM scen) s""",
    "scen",
)
def _(spark, root):
    return valuation.dcf_schedule(_scenarios(spark, root))


@_register(
    "dcf_sensitivity", "company scenario wacc_pct growth_pct equity_value_m:6",
    """SELECT company, scenario, CAST(wp AS INTEGER) AS wacc_pct, CAST(gp AS INTEGER) AS growth_pct,
      CASE WHEN wp > gp THEN (pv + last_fcf * (1 + gp / 100.0) / ((wp - gp) / 100.0) / POW(1 + wp / 100.0, n)) / 1e6 END
        AS equity_value_m
      FROM (SELECT company, scenario, wp, gp, SUM(fcf / POW(1 + wp / 100.0, t)) AS pv, COUNT(*) AS n,
          arg_max(fcf, year) AS last_fcf
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company, scenario ORDER BY year) AS t FROM scen) s
          CROSS JOIN generate_series(2, 22, 2) w(wp) CROSS JOIN generate_series(1, 5) g(gp)
        GROUP BY company, scenario, wp, gp) v""",
    "scen",
)
def _(spark, root):
    return valuation.dcf_sensitivity(_scenarios(spark, root), wacc_pct=(2, 22, 2))


SHOCKS = [(r / 100, s / 100) for r in (-20, -10, 0, 10, 20) for s in (-5, 0, 5)]


@_register(
    "shock_grid",
    "company scenario year revenue_shock:3 margin_shock:3 revenue:4 ebitda:4 net_income:4 fcf:4",
    f"""SELECT company, scenario, year, CAST(r AS DOUBLE) AS revenue_shock, CAST(s AS DOUBLE) AS margin_shock,
      revenue * (1 + CAST(r AS DOUBLE)) AS revenue,
      CASE WHEN r = 0 AND s = 0 THEN ebitda ELSE revenue * (1 + CAST(r AS DOUBLE)) * (ebitda_margin + CAST(s AS DOUBLE)) END AS ebitda,
      CASE WHEN r = 0 AND s = 0 THEN net_income ELSE revenue * (1 + CAST(r AS DOUBLE)) * (net_margin + CAST(s AS DOUBLE) * 0.6) END AS net_income,
      CASE WHEN r = 0 AND s = 0 THEN fcf ELSE revenue * (1 + CAST(r AS DOUBLE)) * (net_margin + CAST(s AS DOUBLE) * 0.6) * 0.85 END AS fcf
      FROM scen CROSS JOIN (VALUES {", ".join(f"({r}, {s})" for r, s in SHOCKS)}) p(r, s)""",
    "scen",
)
def _(spark, root):
    return valuation.shock(_scenarios(spark, root), SHOCKS)


@_register(
    "headline_kpis",
    "company scenario last_revenue:4 forecast_revenue:4 revenue_growth:8 net_income_growth:8 "
    "forecast_gross_margin:8 forecast_ebitda_margin:8 forecast_fcf:4",
    """SELECT f.company, f.scenario, h.revenue AS last_revenue, f.revenue AS forecast_revenue,
      (f.revenue - h.revenue) / NULLIF(h.revenue, 0) AS revenue_growth,
      (f.net_income - h.net_income) / NULLIF(h.net_income, 0) AS net_income_growth,
      f.gross_margin AS forecast_gross_margin, f.ebitda_margin AS forecast_ebitda_margin, f.fcf AS forecast_fcf
      FROM scen f JOIN hist h ON f.company = h.company 
      WHERE f.year = (SELECT MAX(year) FROM scen WHERE company = f.company)
        AND h.year = (SELECT MAX(year) FROM hist WHERE company = f.company)""",
    "scen hist",
)
def _(spark, root):
    hist, _, cases = _layers(spark, root)
    return reporting.headline_kpis(hist, cases)


@_register(
    "scenario_totals",
    "company scenario total_revenue:3 total_net_income:3 total_fcf:3 avg_ebitda_margin:8",
    """SELECT company, scenario, SUM(revenue) AS total_revenue, SUM(net_income) AS total_net_income,
      SUM(fcf) AS total_fcf, AVG(ebitda_margin) AS avg_ebitda_margin FROM scen GROUP BY company, scenario""",
    "scen",
)
def _(spark, root):
    return reporting.scenario_totals(_scenarios(spark, root))


@_register(
    "balance_sheet_serving",
    "company year cash:3 current_assets:3 net_ppe:3 total_assets:3 long_term_debt:3 total_liabilities:3 "
    "retained_earnings:4 paid_in_capital:4 total_equity:4 bs_balance_check:3",
    "SELECT * FROM serving", "serving",
)
def _(spark, root):
    return statements.balance_sheet_serving(_model_years(spark, root))


@_register(
    "cash_flow_serving",
    "company year cfo:2 cfi:2 debt_change:3 dividends:4 cff:3 net_cash_change:3 cumulative_cash:3",
    "SELECT * FROM serving_cash", "serving_cash",
)
def _(spark, root):
    return statements.cash_flow_serving(_model_years(spark, root))


@_register(
    "margin_progression", "company year period_type margin pct:6",
    """SELECT company, year, period_type, margin, pct FROM (
      SELECT company, year, 'Historical' AS period_type, 'Gross Margin' AS margin, gross_margin_avg * 100 AS pct FROM hist
      UNION ALL SELECT company, year, 'Historical', 'EBITDA Margin', ebitda_margin_avg * 100 FROM hist
      UNION ALL SELECT company, year, 'Historical', 'Net Margin', net_margin_avg * 100 FROM hist
      UNION ALL SELECT company, year, 'Forecast', 'Gross Margin', gross_margin * 100 FROM gold_a
      UNION ALL SELECT company, year, 'Forecast', 'EBITDA Margin', ebitda_margin * 100 FROM gold_a
      UNION ALL SELECT company, year, 'Forecast', 'Net Margin', net_margin * 100 FROM gold_a) m""",
    "hist gold_a",
)
def _(spark, root):
    return reporting.margin_progression(_years(spark, root))


@_register(
    "revenue_band", "company date series value:2",
    """SELECT company, date, 'revenue' AS series, revenue AS value FROM gold_m
      UNION ALL SELECT company, date, 'revenue_lower', revenue_lower FROM gold_m
      UNION ALL SELECT company, date, 'revenue_upper', revenue_upper FROM gold_m""",
    "gold_m",
)
def _(spark, root):
    return reporting.revenue_band(_gold_monthly(spark, root))


@_register(
    "cash_waterfall", "company year step_no label measure amount:3 bar_start:3 bar_end:3",
    """SELECT company, year, 1 AS step_no, 'CFO' AS label, 'relative' AS measure, cfo AS amount, 0 AS bar_start, cfo AS bar_end FROM final_year
      UNION ALL SELECT company, year, 2, 'CFI', 'relative', cfi, cfo, cfo + cfi FROM final_year
      UNION ALL SELECT company, year, 3, 'CFF', 'relative', cff, cfo + cfi, cfo + cfi + cff FROM final_year
      UNION ALL SELECT company, year, 4, 'Net Change', 'total', cfo + cfi + cff, 0, cfo + cfi + cff FROM final_year""",
    "final_year",
)
def _(spark, root):
    return reporting.cash_waterfall(_statements(spark, root))


@_register(
    "value_bridge", "company scenario step_no label measure amount:3 bar_start:3 bar_end:3",
    f"""SELECT company, scenario, 1 AS step_no, 'PV of FCFs' AS label, 'relative' AS measure, pv_fcf AS amount,
        0 AS bar_start, pv_fcf AS bar_end FROM ({_DCF_BASE}) a
      UNION ALL SELECT company, scenario, 2, 'PV of Terminal Value', 'relative', pv_terminal, pv_fcf,
        enterprise_value FROM ({_DCF_BASE}) b
      UNION ALL SELECT company, scenario, 3, 'Enterprise Value', 'total', enterprise_value, 0,
        enterprise_value FROM ({_DCF_BASE}) c""",
    "scen",
)
def _(spark, root):
    return reporting.value_bridge(valuation.dcf(_scenarios(spark, root)))


@_register(
    "scenario_lines", "company series year revenue:3",
    """SELECT company, scenario AS series, year, revenue FROM scen
      UNION ALL SELECT company, 'Historical', year, revenue FROM hist""",
    "scen hist",
)
def _(spark, root):
    hist, _, cases = _layers(spark, root)
    return reporting.scenario_lines(hist, cases)


@_register(
    "asset_composition", "company year asset_class amount:3 share:8",
    " UNION ALL ".join(
        f"""SELECT company, year, '{label}' AS asset_class, {c} AS amount,
          {c} / NULLIF(cash + accounts_receivable + inventory + net_ppe, 0) AS share FROM stm"""
        for label, c in (("Cash", "cash"), ("AR", "accounts_receivable"),
                         ("Inventory", "inventory"), ("Net PP&E", "net_ppe"))
    ),
    "stm",
)
def _(spark, root):
    return reporting.asset_composition(statements.balance_sheet(_model_years(spark, root)))


@_register("customers_arpu", "company year customers_eoy arpu:4", "SELECT * FROM annual", "annual")
def _(spark, root):
    return reporting.customers_arpu(
        kpis.annual_rollup(kpis.monthly_kpis(_fin(spark, root)).withColumns(
            {c: F.lit(None).cast("double") for c in kpis.MACRO_COLUMNS}))
    )


@_register(
    "format_labels",
    "company date revenue revenue_label accounts_receivable_label gross_margin_label revenue_cell",
    """SELECT company, date, revenue,
      CASE WHEN revenue IS NULL THEN '—' WHEN ABS(revenue) >= 1000000 THEN 'R ' || format('{:.0f}', revenue / 1e6) || 'M'
        ELSE 'R ' || format('{:,.0f}', revenue) END AS revenue_label,
      CASE WHEN accounts_receivable IS NULL THEN '—'
        WHEN ABS(accounts_receivable) >= 1000000 THEN 'R ' || format('{:.0f}', accounts_receivable / 1e6) || 'M'
        ELSE 'R ' || format('{:,.0f}', accounts_receivable) END AS accounts_receivable_label,
      CASE WHEN revenue IS NULL THEN '—' ELSE format('{:.1f}', gross_profit / revenue * 100) || '%' END AS gross_margin_label,
      CASE WHEN revenue IS NULL THEN '-' ELSE 'R ' || LPAD(format('{:,.0f}', revenue), 14, ' ') END AS revenue_cell
      FROM seg_full""",
    "seg_full",
)
def _(spark, root):
    rows = kpis.margins(timeseries.complete_months(_segments(spark, root)))
    return reporting.with_labels(rows, ["revenue", "accounts_receivable"], ["gross_margin"], ["revenue"])


@_register(
    "bi_measures", "company latest_revenue:3 revenue_growth_pct:8 ebitda_margin_pct:8 fcf_base:3",
    """SELECT s.company, MAX(s.revenue) AS latest_revenue,
      (MAX(s.revenue) - MAX(h.revenue)) / NULLIF(MAX(h.revenue), 0) AS revenue_growth_pct,
      SUM(s.ebitda) / NULLIF(SUM(s.revenue), 0) AS ebitda_margin_pct, SUM(s.fcf) AS fcf_base
      FROM scen s LEFT JOIN (SELECT company, MAX(revenue) AS revenue FROM hist GROUP BY company) h
        ON s.company = h.company WHERE scenario = 'Base' GROUP BY s.company""",
    "scen hist",
)
def _(spark, root):
    hist, _, cases = _layers(spark, root)
    return reporting.bi_measures(hist, cases)


@_register(
    "bi_model_join", "company year scenario historical_revenue:3 forecast_revenue:3 scenario_revenue:3",
    """SELECT g.company, g.year, s.scenario, h.revenue AS historical_revenue, g.revenue AS forecast_revenue,
      s.revenue AS scenario_revenue
      FROM gold_a g LEFT JOIN annual h ON g.company = h.company AND g.year = h.year
        LEFT JOIN scen s ON g.company = s.company AND g.year = s.year""",
    "gold_a annual scen",
)
def _(spark, root):
    actual = layers.materialize(_fin(spark, root))
    yearly = actual.groupBy("company", F.year("date").alias("year")).agg(F.sum("revenue").alias("revenue"))
    end = _end(spark, root)
    gold = fc.gold_annual(fc.gold_monthly(actual, PERIODS, _made_on(end), until=end))
    return reporting.bi_model_join(yearly, gold, fc.scenarios(gold))


@_register(
    "scenario_slice", "company scenario year revenue:3 ebitda:3 net_income:3 fcf:3",
    "SELECT * FROM scen WHERE scenario IN ('Bull', 'Bear')", "scen",
)
def _(spark, root):
    return reporting.scenario_slice(_scenarios(spark, root), ["Bull", "Bear"])


@_register(
    "combined_years", "company year period_type revenue:2 net_income:2 cfo:2 arpu:4 gross_margin_avg:8 gross_margin:8",
    """SELECT company, year, 'Historical' AS period_type, revenue, net_income, CAST(NULL AS DOUBLE) AS cfo, arpu,
        gross_margin_avg, CAST(NULL AS DOUBLE) AS gross_margin FROM hist
      UNION ALL SELECT company, year, 'Forecast', revenue, net_income, cfo, NULL, NULL, gross_margin FROM gold_a""",
    "hist gold_a",
)
def _(spark, root):
    return _years(spark, root)


@_register(
    "margin_fallback", "company year gross_margin:8 ebitda_margin:8 net_margin:8",
    """SELECT company, year, gross_margin, CASE WHEN is_forecast THEN ebitda_margin ELSE NULL END AS ebitda_margin,
        net_margin FROM stm_income WHERE FALSE
      UNION ALL SELECT company, year, gross_margin_avg, ebitda / NULLIF(revenue, 0), net_income / NULLIF(revenue, 0) FROM hist
      UNION ALL SELECT company, year, gross_profit / NULLIF(revenue, 0), ebitda_margin, net_income / NULLIF(revenue, 0) FROM gold_a""",
    "stm_income hist gold_a",
)
def _(spark, root):
    years = _years(spark, root).drop("gross_margin", "ebitda_margin_avg", "net_margin", "net_margin_avg")
    return reporting.margin_fallback(years)


# ------------------------------------------------------------ logs and monitoring


@_register(
    "audit_events",
    "run_id event_type stage table_name rows_affected message severity metadata_json recorded_at",
    "SELECT * FROM audit", "audit",
)
def _(spark, root):
    return fixtures.audit_from_events(spark, root)


@_register(
    "run_log",
    "run_id stage status started_at completed_at duration_seconds rows_processed rows_failed error_message",
    """SELECT 'run_' || user_id AS run_id, event_type AS stage, LOWER(status) AS status, ts AS started_at,
      ts + to_seconds(CAST(FLOOR(value) AS INTEGER)) AS completed_at, value AS duration_seconds,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_processed,
      CAST(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS BIGINT) AS rows_failed,
      CASE WHEN status = 'FAILED' THEN 'failed' END AS error_message FROM ev""",
    "ev",
)
def _(spark, root):
    return fixtures.run_log_from_events(spark, root)


def _batch_runs(spark, root) -> list:
    """What the log of a batch would hold for the runs in ``events``: one entry per kind of event.

    A batch logs a handful of entries; the kinds are few whatever the size of the table.
    """
    kinds = tables.star_table(spark, root, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 90).alias("failed")
    )
    return kinds.orderBy("event_type").collect()


@_register(
    "audit_writer", "run_id event_type stage table_name rows_affected message severity metadata_json",
    f"""SELECT '{RUN_ID}' AS run_id, 'stage_event' AS event_type, event_type AS stage, 'events' AS table_name,
        COUNT(*) AS rows_affected, 'counted ' || event_type AS message,
        CASE WHEN COUNT(CASE WHEN value > 90 THEN 1 END) > 0 THEN 'WARN' ELSE 'INFO' END AS severity,
        '{{"failed": ' || COUNT(CASE WHEN value > 90 THEN 1 END) || '}}' AS metadata_json
      FROM events GROUP BY event_type""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "audit")
    events = [
        {"run_id": RUN_ID, "stage": r.event_type, "table_name": "events", "rows_affected": r.n,
         "message": f"counted {r.event_type}", "severity": "WARN" if r.failed else "INFO",
         "metadata": {"failed": r.failed}}
        for r in _batch_runs(spark, root)
    ]
    layers.append(logs.audit_frame(spark, events), path)
    return spark.read.schema(nullable_copy(get_schema("gold_audit_log"))).parquet(path)


@_register(
    "run_log_writer", "run_id stage status rows_processed rows_failed error_message took_time wacc",
    f"""SELECT '{RUN_ID}' AS run_id, event_type AS stage,
        CASE WHEN COUNT(CASE WHEN value > 90 THEN 1 END) > 0 THEN 'failed' ELSE 'success' END AS status,
        COUNT(*) AS rows_processed, COUNT(CASE WHEN value > 90 THEN 1 END) AS rows_failed,
        CASE WHEN COUNT(CASE WHEN value > 90 THEN 1 END) > 0 THEN 'values above 90' END AS error_message,
        TRUE AS took_time, '0.12' AS wacc
      FROM events GROUP BY event_type""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "run_log")
    log = logs.RunLogger(spark, RUN_ID, f"{path}/audit", f"{path}/runs")
    started = dt.datetime.now(dt.timezone.utc)
    for r in _batch_runs(spark, root):
        log.stage(
            r.event_type, "failed" if r.failed else "success", started, r.n, r.failed,
            "values above 90" if r.failed else None,
        )
    log.flush()
    rows = spark.read.schema(nullable_copy(get_schema("bronze_pipeline_run_log"))).parquet(f"{path}/runs")
    return rows.withColumns(
        {
            "took_time": (F.col("duration_seconds") >= 0) & (F.col("completed_at") >= F.col("started_at")),
            "wacc": F.get_json_object("config_snapshot", "$.model.default_wacc"),
        }
    )


@_register(
    "config_snapshot", "run_id n_events event_type wacc tax_rate first_scenario",
    """SELECT 'run_' || event_type AS run_id, COUNT(*) AS n_events, 'pipeline_start' AS event_type, '0.12' AS wacc,
      '0.28' AS tax_rate, 'Base' AS first_scenario FROM events e GROUP BY e.event_type""",
)
def _(spark, root):
    path = layers.scratch_path(spark, "snapshots")
    events = tables.star_table(spark, root, "events")
    for r in _batch_runs(spark, root):
        layers.append(logs.config_snapshot_event(spark, f"run_{r.event_type}"), path)
    written = spark.read.schema(nullable_copy(get_schema("gold_audit_log"))).parquet(path)
    counts = events.groupBy(F.concat(F.lit("run_"), "event_type").alias("run_id")).agg(F.count("*").alias("n_events"))
    setting = lambda name: F.get_json_object("metadata_json", name)
    return written.join(counts, "run_id").withColumns(
        {
            "wacc": setting("$.model.default_wacc"),
            "tax_rate": setting("$.model.corporate_tax_rate"),
            "first_scenario": setting("$.scenarios[0].name"),
        }
    )


@_register(
    "mon_run_health", "run_date successes failures",
    f"""SELECT CAST(recorded_at AS DATE) AS run_date,
      COUNT(CASE WHEN event_type = 'pipeline_complete' AND message LIKE '%SUCCESS%' THEN 1 END) AS successes,
      COUNT(CASE WHEN event_type = 'pipeline_complete' AND message LIKE '%FAILED%' THEN 1 END) AS failures
      FROM audit WHERE recorded_at >= DATE '{TODAY}' - INTERVAL 30 DAY GROUP BY 1""",
    "audit",
)
def _(spark, root):
    return monitoring.run_health(fixtures.audit_from_events(spark, root), TODAY)


@_register(
    "mon_dq_trend", "check_date failure_pct:6",
    """SELECT CAST(checked_at AS DATE) AS check_date, failure_pct * 100 AS failure_pct FROM dqlog
      WHERE check_name = 'gross_profit_identity'""",
    "dqlog",
)
def _(spark, root):
    return monitoring.dq_trend(fixtures.dq_log_from_events(spark, root))


@_register(
    "mon_avg_duration", "avg_duration_seconds:8",
    """SELECT AVG(CAST(regexp_extract(message, '([0-9.]+)s', 1) AS DOUBLE)) AS avg_duration_seconds
      FROM audit WHERE event_type = 'pipeline_complete'""",
    "audit",
)
def _(spark, root):
    return monitoring.mean_duration(fixtures.audit_from_events(spark, root))


@_register(
    "mon_recent_errors", "run_id stage event_type message recorded_at",
    """SELECT run_id, stage, event_type, message, recorded_at FROM audit WHERE severity IN ('WARN', 'ERROR')
      ORDER BY recorded_at DESC, run_id, message LIMIT 50""",
    "audit",
)
def _(spark, root):
    return monitoring.recent_problems(fixtures.audit_from_events(spark, root))


@_register(
    "mon_failed_checks", "run_id check_name failure_pct:4 passed checked_at",
    "SELECT * FROM dqlog WHERE NOT passed", "dqlog",
)
def _(spark, root):
    return monitoring.failed_checks(fixtures.dq_log_from_events(spark, root))


@_register(
    "mon_quarantine", "date company revenue _quarantine_reason _quarantined_at",
    f"""SELECT date, company, revenue, {_REASON} AS _quarantine_reason, TIMESTAMP '{STAMP}' AS _quarantined_at
      FROM reported WHERE NOT ({_OK} AND {_POSITIVE})""",
    "reported",
)
def _(spark, root):
    return monitoring.quarantine_listing(
        quality.quarantine(_reported(spark, root), RUN_ID, stamped_at=STAMP)
    )


@_register(
    "mon_latest_rows", "date company revenue gross_margin:8",
    """SELECT date, company, revenue, gross_profit / NULLIF(revenue, 0) AS gross_margin FROM fin
      ORDER BY date DESC, company LIMIT 20""",
    "fin",
)
def _(spark, root):
    return monitoring.latest_rows(_fin(spark, root))


PLANNED = ["signup", "view", "click", "purchase", "error", "export"]


@_register(
    "mon_stage_summary", "run_id stage_no stage status duration_seconds rows_processed",
    f"""SELECT p.run_id, p.stage_no, p.stage, COALESCE(l.status, 'not_run') AS status,
        l.duration_seconds, l.rows_processed
      FROM (SELECT DISTINCT 'run_' || user_id AS run_id, stage_no, stage FROM events
        CROSS JOIN (VALUES {", ".join(f"({i}, '{s}')" for i, s in enumerate(PLANNED))}) v(stage_no, stage)) p
      LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, stage
          ORDER BY ts DESC, status DESC, duration_seconds DESC, rows_processed DESC) AS rn FROM (
        SELECT 'run_' || user_id AS run_id, event_type AS stage, LOWER(status) AS status,
          value AS duration_seconds, CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_processed, ts
        FROM ev) e) l ON p.run_id = l.run_id AND p.stage = l.stage AND l.rn = 1""",
    "ev",
)
def _(spark, root):
    return monitoring.stage_summary(fixtures.run_log_from_events(spark, root), PLANNED)


@_register(
    "mon_metrics", "metric value:3",
    f"""SELECT 'rows_ingested' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM past
      UNION ALL SELECT 'rows_failed_dq', CAST(SUM(rows_failed) AS DOUBLE) FROM dqlog
      UNION ALL SELECT 'rows_quarantined', CAST(COUNT(CASE WHEN NOT ({_OK} AND {_POSITIVE}) THEN 1 END) AS DOUBLE) FROM past
      UNION ALL SELECT 'pipeline_duration_seconds', SUM(value) FROM ev
      UNION ALL SELECT 'forecast_mape', AVG(mape) FROM mape
      UNION ALL SELECT 'bs_balance_error', MAX(bs_balance_check) FROM stm
      UNION ALL SELECT 'cf_reconciliation_error', AVG(cf_reconciliation) FROM stm""",
    "past dqlog ev mape stm",
)
def _(spark, root):
    past = layers.materialize(_fin(spark, root))
    years = fc.model_years(past, PERIODS, until=_end(spark, root))
    return monitoring.tracked_metrics(
        past,
        quality.gate(past),
        fixtures.dq_log_from_events(spark, root),
        fixtures.run_log_from_events(spark, root),
        fc.forecast_mape(past, until=_end(spark, root)),
        statements.three_statements(years),
    )


from ledgerline.plans import extended  # noqa: E402, F401  registers its queries
