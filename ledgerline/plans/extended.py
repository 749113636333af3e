"""Queries beyond the monthly model: upkeep by changes, mergeable distinct counts, joins on time, hierarchies.

Registered by ``plans.queries``, which imports this module last.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import changes, distinct, monitoring, quality, statements, temporal
from ledgerline.operators import forecast as fc
from ledgerline.plans import fixtures
from ledgerline.plans.oracle import AMOUNTS, PNL
from ledgerline.plans.queries import (
    _CASH, _GOLD_ANNUAL, _INCOME_RATIOS, _MARGINS, _OK, _POSITIVE, _SCENARIO_MONEY, PERIODS, _cols, _end, _made_on, _register, _reported,
)
from ledgerline.schemas import FINANCIAL_COLUMNS_DDL, get_schema
from ledgerline.sources import financials, layers, tables
from ledgerline.sources.tables import star_table
from ledgerline.streaming import health

# ------------------------------------------------------------ changes between snapshots

_EARLIER = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 2 THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
  CAST(date_trunc('month', o_orderdate) - CASE WHEN o_orderkey % 13 = 5 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS DATE) AS date
  FROM orders WHERE o_orderkey % 17 <> 3"""
_LATER = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS date
  FROM orders WHERE o_orderkey % 19 <> 7"""


@_register(
    "order_changes", "o_orderkey change",
    f"""SELECT o_orderkey, CASE WHEN n.date IS NULL THEN 'deleted' WHEN o.date IS NULL THEN 'inserted' ELSE 'changed' END AS change
      FROM ({_EARLIER}) o FULL JOIN ({_LATER}) n USING (o_orderkey)
      WHERE n.date IS NULL OR o.date IS NULL OR n.date <> o.date OR n.o_orderstatus <> o.o_orderstatus""",
)
def _(spark, root):
    return changes.kinds_of_change(changes.signed_difference(*fixtures.order_snapshots(spark, root)), ["o_orderkey"])


@_register(
    "financials_incremental", f"company date {_cols(AMOUNTS, 2)} customers churn_rate:4",
    "SELECT * FROM fin_later", "fin_later",
)
def _(spark, root):
    old, new = fixtures.order_snapshots(spark, root)
    stored = layers.materialize(financials.customer_months(financials.order_totals(spark, root), old))
    changed = layers.materialize(changes.signed_difference(old, new))
    return financials.updated_financials(spark, root, stored, changed, "nation")[1]


# ------------------------------------------------------------ distinct customers over periods

_BUYERS = """SELECT DISTINCT n_name AS company, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
_YEAR_OF_BUYERS = f"""WITH b AS ({_BUYERS}),
  e AS (SELECT DISTINCT company, CAST(date + to_months(k) AS DATE) AS date
    FROM (SELECT company, date, UNNEST(range(0, 12))::INTEGER AS k FROM b) s
    WHERE CAST(date + to_months(k) AS DATE) <= (SELECT MAX(date) FROM b))
  SELECT e.company, e.date, COUNT(DISTINCT o_custkey) AS customers, TRUE AS within_bound
  FROM e JOIN b ON b.company = e.company AND b.date <= e.date AND b.date > e.date - INTERVAL 12 MONTH
  GROUP BY e.company, e.date"""


def _exact(months, last):
    return distinct.merged_count(distinct.into_windows(distinct.bitmaps(months, ["company", "date"], "o_custkey"), 12, last), ["company", "date"], "customers")


@_register("customers_trailing", "company date customers", _YEAR_OF_BUYERS)
def _(spark, root):
    months = layers.materialize(fixtures.buyers(spark, root))
    return _exact(months, months.agg(F.max("date")))


@_register("customers_sketched", "company date customers within_bound", _YEAR_OF_BUYERS)
def _(spark, root):
    months = layers.materialize(fixtures.buyers(spark, root))
    last = months.agg(F.max("date"))
    sketched = distinct.into_windows(distinct.sketches(months, ["company", "date"], "o_custkey"), 12, last)
    both = distinct.merged_estimate(sketched, ["company", "date"], "estimate").join(_exact(months, last), ["company", "date"])
    error = F.abs(F.col("estimate") / F.col("customers") - 1)
    return both.withColumn("within_bound", error <= distinct.error_bound())


@_register(
    "customers_by_year", "company year customers",
    f"SELECT company, CAST(year(date) AS INTEGER) AS year, COUNT(DISTINCT o_custkey) AS customers FROM ({_BUYERS}) b GROUP BY ALL",
)
def _(spark, root):
    mapped = distinct.bitmaps(fixtures.buyers(spark, root), ["company", "date"], "o_custkey")
    return distinct.merged_count(mapped.withColumn("year", F.year("date")), ["company", "year"], "customers")


# ------------------------------------------------------------ joins on time


@_register(
    "purchase_last_view", "event_id user_id right_event_id right_value",
    """WITH v AS (SELECT user_id, ts, MAX(event_id) AS event_id, arg_max(value, event_id) AS value
        FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
      SELECT p.event_id, p.user_id, CASE WHEN p.ts - v.ts <= INTERVAL 6 HOUR THEN v.event_id END AS right_event_id,
        CASE WHEN p.ts - v.ts <= INTERVAL 6 HOUR THEN v.value END AS right_value
      FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def _(spark, root):
    events = star_table(spark, root, "events")
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.where("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    return temporal.asof_join(left, right, "ts", ["user_id"], "event_id", tolerance=6 * 3600)


@_register(
    "orders_in_periods", "o_orderkey right_months right_start days",
    """WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start, CAST(MAX(l_shipdate) AS DATE) AS stop
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate),
      p AS (SELECT DISTINCT m AS months, CAST(date_trunc(u, o_orderdate) AS DATE) AS start
        FROM orders, (VALUES (3, 'quarter'), (12, 'year')) x(m, u)),
      q AS (SELECT months, start, CAST(start + to_months(months) - INTERVAL 1 DAY AS DATE) AS stop FROM p)
      SELECT o_orderkey, q.months AS right_months, q.start AS right_start,
        date_diff('day', GREATEST(t.start, q.start), LEAST(t.stop, q.stop)) + 1 AS days
      FROM t JOIN q ON t.start <= q.stop AND q.start <= t.stop WHERE t.start <= t.stop""",
)
def _(spark, root):
    pairs = temporal.interval_join(fixtures.order_terms(spark, root), fixtures.statement_periods(spark, root), "start", "stop", unit=32)
    days = F.date_diff(F.least("stop", "right_stop"), F.greatest("start", "right_start")) + 1
    return pairs.withColumn("days", days.cast("bigint"))


@_register(
    "run_sessions", "user_id session_start session_end n_rows duration:3 stages",
    """WITH g AS (SELECT user_id, ts, event_type, CASE WHEN ts - LAG(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS begins
        FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT *, SUM(begins) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g),
      f AS (SELECT user_id, session, event_type, MIN(ts) AS first, MAX(ts) AS last, COUNT(*) AS n FROM s GROUP BY ALL)
      SELECT user_id, MIN(first) AS session_start, MAX(last) AS session_end, CAST(SUM(n) AS BIGINT) AS n_rows,
        (epoch_us(MAX(last)) - epoch_us(MIN(first))) / 1000000.0 AS duration,
        string_agg(event_type, ' > ' ORDER BY first, event_type) AS stages
      FROM f GROUP BY user_id, session""",
)
def _(spark, root):
    return temporal.sessions(star_table(spark, root, "events"), ["user_id"], "ts", "event_type", gap=12 * 3600)


# ------------------------------------------------------------ logs: metadata and streams

_METADATA = """SELECT event_id, event_type, CASE WHEN event_id % 23 = 4 THEN left(props, length(props) - 1)
    WHEN event_id % 29 = 5 THEN '{}' WHEN event_id % 31 = 6 THEN '{"k": "many"}' WHEN event_id % 37 <> 7 THEN props END AS t
  FROM events"""


@_register(
    "audit_metadata", "event_id k is_valid",
    f"""SELECT event_id, CASE WHEN json_valid(t) THEN TRY_CAST(json_extract_string(t, '$.k') AS BIGINT) END AS k,
        COALESCE(json_valid(t), FALSE) AS is_valid FROM ({_METADATA}) m""",
)
def _(spark, root):
    rows = monitoring.with_metadata(fixtures.audit_metadata(spark, root), {"k": "bigint"})
    return rows.withColumn("is_valid", F.col("metadata").isNotNull())


@_register(
    "audit_metadata_schema", "event_type metadata_schema valid malformed missing",
    f"""SELECT event_type, CASE
          WHEN COUNT(DISTINCT json_type(j, '$.k')) > 1 THEN 'OBJECT<k: VARIANT>'
          WHEN MAX(json_type(j, '$.k')) = 'VARCHAR' THEN 'OBJECT<k: STRING>'
          WHEN MAX(json_type(j, '$.k')) IS NOT NULL THEN 'OBJECT<k: BIGINT>'
          WHEN COUNT(j) > 0 THEN 'OBJECT<>' ELSE 'VOID' END AS metadata_schema,
        COUNT(j) AS valid, COUNT(t) - COUNT(j) AS malformed, COUNT(*) - COUNT(t) AS missing
      FROM (SELECT *, CASE WHEN json_valid(t) THEN t END AS j FROM ({_METADATA}) m) v GROUP BY event_type""",
)
def _(spark, root):
    return monitoring.metadata_schemas(fixtures.audit_metadata(spark, root), "event_type")


@_register(
    "streamed_health", "window_start window_end n_rows n_failed late_rows",
    """WITH a AS (SELECT ts, event_id % 5 = 0 AS failed,
          LEAST(date_diff('day', (SELECT CAST(MIN(ts) AS DATE) FROM events), CAST(ts AS DATE)) // 8
            + CASE WHEN event_id % 50 = 7 THEN 1 ELSE 0 END, 3) AS part FROM events),
      m AS (SELECT p.part, (SELECT MAX(ts) FROM a WHERE a.part < p.part) - INTERVAL 3 DAY AS mark FROM (SELECT DISTINCT part FROM a) p),
      w AS (SELECT a.*, m.mark, date_trunc('day', ts) - to_days(k) AS s
        FROM a JOIN m USING (part), (VALUES (0), (1)) x(k)),
      v AS (SELECT s AS window_start, s + INTERVAL 2 DAY AS window_end, failed, mark IS NULL OR s + INTERVAL 2 DAY > mark AS kept FROM w)
      SELECT window_start, window_end, COUNT(*) FILTER (kept) AS n_rows, COUNT(*) FILTER (kept AND failed) AS n_failed,
        COUNT(*) FILTER (NOT kept) AS late_rows FROM v GROUP BY ALL""",
)
def _(spark, root):
    """Four deliveries of log files, each taken in by a stream that ends and is started again."""
    rows = layers.materialize(fixtures.arrivals(spark, root))
    landing, table, checkpoint = (layers.scratch_path(spark, x) for x in ("landing", "health", "stream"))
    for part in range(4):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(landing)
        health.follow(spark, landing, rows.drop("part").schema, table, checkpoint)
    return health.with_late_rows(health.latest(spark, table), rows)


# ------------------------------------------------------------ hierarchies

_PLACES, _TIMES = ("region", "nation", "segment"), ("year", "quarter", "month")
_SETS = [_PLACES[:i] + _TIMES[:j] for i in range(4) for j in range(4)]


@_register(
    "hierarchy_totals", "region nation segment year quarter month level revenue:2 n_orders",
    f"""SELECT region, nation, segment, year, quarter, month, GROUPING(region, nation, segment, year, quarter, month) AS level,
        CAST(SUM(rev) AS DOUBLE) AS revenue, COUNT(DISTINCT o_orderkey) AS n_orders
      FROM (SELECT r_name AS region, n_name AS nation, c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS year,
          CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderkey,
          CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) s
      GROUP BY GROUPING SETS ({", ".join(f"({', '.join(x)})" for x in _SETS)})""",
)
def _(spark, root):
    return financials.hierarchy_totals(spark, root, _SETS, (*_PLACES, *_TIMES))


# ------------------------------------------------------------ registered names and schemas


@_register(
    "view_registration", "nation customers",
    "SELECT n_name AS nation, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def _(spark, root):
    for name in ("customer", "nation"):
        tables.register_view(star_table(spark, root, name), f"registered_{name}")
    return spark.sql(
        """SELECT n_name AS nation, COUNT(*) AS customers FROM registered_customer
           JOIN registered_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


_FIELDS = [x.split()[:2] for x in FINANCIAL_COLUMNS_DDL.split(", ")]


@_register(
    "schema_registry", "position name type written n_values",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT {k} AS position, '{n}' AS name, '{t}' AS type, '{t}' AS written, (SELECT COUNT({n}) FROM fin) AS n_values"
        for k, (n, t) in enumerate(_FIELDS)
    )
    + ") r",
    "fin",
)
def _(spark, root):
    """The registered schema beside what a table written by it has, with values per column."""
    fields = [f for f in get_schema("bronze_company_financials").fields if not f.name.startswith("_")]
    months = financials.monthly_financials(spark, root, "nation").select(*[F.col(f.name).cast(f.dataType) for f in fields])
    stored = layers.materialize(months)
    counts = stored.agg(*[F.count(f.name).alias(f.name) for f in fields])
    registered = spark.createDataFrame([(k, f.name, f.dataType.simpleString(), stored.schema[f.name].dataType.simpleString()) for k, f in enumerate(fields)], "position int, name string, type string, written string")
    per_column = counts.unpivot([], [f.name for f in fields], "name", "n_values")
    return registered.join(per_column, "name")


# ------------------------------------------------------------ forecasts from gated months

_GATED = {
    "fin": (
        f"""SELECT * FROM reported WHERE {_OK} AND {_POSITIVE}
          AND revenue > 0 AND cogs < revenue AND ABS(gross_profit - (revenue - cogs)) < 1.0""",
        ("reported",),
    )
}


def _gated(spark, root):
    """Booked months that pass the gate and the stricter filter after it; quarantined ones are gaps."""
    return quality.silver_validate(quality.clean_rows(_reported(spark, root)))


def _gated_years(spark, root):
    return fc.model_years(_gated(spark, root), PERIODS, until=_end(spark, root))


@_register(
    "gold_monthly_gated",
    f"company date {_cols(PNL, 2)} {_MARGINS} {_CASH} accounts_receivable:2 inventory:2 accounts_payable:2 "
    "revenue_lower:4 revenue_upper:4 revenue_trend:4 forecast_date",
    "SELECT * FROM gold_m", "gold_m", _GATED,
)
def _(spark, root):
    end = _end(spark, root)
    return fc.gold_monthly(_gated(spark, root), PERIODS, _made_on(end), until=end)


@_register("gold_annual_gated", _GOLD_ANNUAL, "SELECT * FROM gold_a", "gold_a", _GATED)
def _(spark, root):
    return _gated_years(spark, root).filter("is_forecast")


@_register("scenarios_gated", f"company scenario year {_SCENARIO_MONEY}", "SELECT * FROM scen", "scen", _GATED)
def _(spark, root):
    return fc.scenarios(_gated_years(spark, root).filter("is_forecast"))


@_register(
    "income_statement_gated", f"company year period_type {_cols(PNL, 2)} {_INCOME_RATIOS}",
    "SELECT * FROM stm_income", "stm_income", _GATED,
)
def _(spark, root):
    return statements.income_statement(_gated_years(spark, root))
