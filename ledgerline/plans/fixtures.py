"""Inputs that queries need and the star schema lacks, derived from its tables.

Booked financials with defects for the quality gate, and logs made of ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.timeseries import complete_months
from ledgerline.schemas import get_schema, nullable_copy
from ledgerline.sources.financials import monthly_financials
from ledgerline.sources.tables import star_table


def reported_financials(
    spark: SparkSession, root: str, company: str = "nation_segment", unit: str = "2.20"
) -> DataFrame:
    """Financials as a company books them: the input that exercises the quality gate.

    Gross profit is booked in multiples of ``unit``, so some rows break the
    identity by more than the tolerance, and months without any order come in
    as rows without amounts.
    """
    return as_reported(monthly_financials(spark, root, company), unit)


def as_reported(months: DataFrame, unit: str = "2.20") -> DataFrame:
    """``reported_financials`` of given monthly financials."""
    booked = f"CAST(ROUND(CAST(gross_profit AS DECIMAL(22,2)) / {unit}, 0) AS DECIMAL(22,0)) * {unit}"
    return (
        complete_months(months)
        .withColumn("gross_profit", F.expr(f"CAST({booked} AS DOUBLE)"))
        .drop("is_gap")
    )


def _events(spark: SparkSession, root: str) -> DataFrame:
    status = F.when(F.col("event_id") % 5 == 0, "FAILED").otherwise("SUCCESS")
    return star_table(spark, root, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props", status.alias("status")
    )


def audit_from_events(spark: SparkSession, root: str) -> DataFrame:
    kind = F.col("event_type")
    return (
        _events(spark, root)
        .select(
            F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
            F.when(kind == "purchase", "pipeline_complete").otherwise("stage_event").alias("event_type"),
            kind.alias("stage"),
            F.lit("events").alias("table_name"),
            F.lit(1).cast("bigint").alias("rows_affected"),
            F.concat(
                F.lit("Pipeline "), F.col("status"), F.lit(" in "),
                F.format_string("%.2f", F.col("value")), F.lit("s"),
            ).alias("message"),
            F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO").alias("severity"),
            F.to_json(F.struct("event_id", "status")).alias("metadata_json"),
            F.col("ts").alias("recorded_at"),
        )
        .to(nullable_copy(get_schema("gold_audit_log")))
    )


def run_log_from_events(spark: SparkSession, root: str) -> DataFrame:
    """Each event as one stage run that took ``value`` seconds."""
    seconds = F.col("value")
    return (
        _events(spark, root)
        .select(
            F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
            F.col("event_type").alias("stage"),
            F.lower("status").alias("status"),
            F.col("ts").alias("started_at"),
            F.timestamp_add("SECOND", F.floor(seconds).cast("int"), "ts").alias("completed_at"),
            seconds.alias("duration_seconds"),
            F.get_json_object("props", "$.k").cast("bigint").alias("rows_processed"),
            F.when(F.col("status") == "FAILED", 1).otherwise(0).cast("bigint").alias("rows_failed"),
            F.when(F.col("status") == "FAILED", "failed").alias("error_message"),
            F.lit(None).cast("string").alias("config_snapshot"),
        )
        .to(nullable_copy(get_schema("bronze_pipeline_run_log")))
    )


def dq_log_from_events(spark: SparkSession, root: str) -> DataFrame:
    """A daily quality log over events: three checks per day, evaluated in one aggregate."""
    days = _events(spark, root).groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "error").alias("f_error"),
        F.count_if(F.col("value") > 90).alias("f_value"),
        F.count_if(F.col("status") == "FAILED").alias("f_status"),
    )
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"), F.lit(kind).alias("check_type"),
                F.lit(column).alias("column_name"), F.col(c).alias("rows_failed"),
                F.lit(limit).alias("threshold"),
            )
            for name, kind, column, c, limit in (
                ("gross_profit_identity", "business_rule", "event_type", "f_error", 0.2),
                ("range_value_0_90", "range", "value", "f_value", 0.01),
                ("status_ok", "business_rule", "status", "f_status", 0.2),
            )
        ]
    )
    share = F.col("rows_failed") / F.col("n")
    return (
        days.select("day", "n", F.inline(checks))
        .select(
            F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
            F.lit("events").alias("table_name"),
            "check_name", "check_type", "column_name",
            F.col("n").alias("rows_checked"),
            "rows_failed",
            F.round(share, 4).alias("failure_pct"),
            "threshold",
            (share <= F.col("threshold")).alias("passed"),
            F.lit("").alias("details"),
            F.col("day").cast("timestamp").alias("checked_at"),
        )
    )


def order_snapshots(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(o_orderkey, o_custkey, o_orderstatus, date) as an earlier and a later snapshot has them.

    The later one lacks some orders of the earlier one and has others in addition; some have
    moved to the next month since, some are no longer pending.
    """
    orders = star_table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("date")
    )
    key = F.col("o_orderkey")
    earlier = orders.where(key % 17 != 3).withColumns(
        {
            "date": F.when(key % 13 == 5, F.add_months("date", -1)).otherwise(F.col("date")),
            "o_orderstatus": F.when(key % 11 == 2, "P").otherwise(F.col("o_orderstatus")),
        }
    )
    return earlier, orders.where(key % 19 != 7)


def order_terms(spark: SparkSession, root: str) -> DataFrame:
    """(o_orderkey, start, stop): days from an order to the last shipment of its lines."""
    shipped = star_table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("stop"))
    orders = star_table(spark, root, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("start"))
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "start", "stop")


def statement_periods(spark: SparkSession, root: str) -> DataFrame:
    """(months, start, stop): the quarters and years that orders fall into."""
    dates = star_table(spark, root, "orders").select(F.to_date("o_orderdate").alias("d"))
    both = [dates.select(F.lit(n).alias("months"), F.trunc("d", unit).alias("start")) for n, unit in ((3, "quarter"), (12, "year"))]
    return both[0].unionByName(both[1]).where("start IS NOT NULL").distinct().withColumn("stop", F.date_sub(F.add_months("start", F.col("months")), 1))


def buyers(spark: SparkSession, root: str) -> DataFrame:
    """(company, date, o_custkey): which customers ordered in a month, each once."""
    orders = star_table(spark, root, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("date")).distinct()
    owners = (
        star_table(spark, root, "customer")
        .join(star_table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("company"))
    )
    return orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select("company", "date", "o_custkey")


def audit_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Audit rows whose metadata is the events' own text; some is cut off, lacks a key or is missing."""
    id_, text = F.col("event_id"), F.col("props")
    broken = (
        F.when(id_ % 23 == 4, F.expr("left(props, length(props) - 1)"))
        .when(id_ % 29 == 5, F.lit("{}"))
        .when(id_ % 31 == 6, F.lit('{"k": "many"}'))
        .when(id_ % 37 != 7, text)
    )
    return _events(spark, root).select("event_id", "event_type", broken.alias("metadata_json"))


def arrivals(spark: SparkSession, root: str, days: int = 8, parts: int = 4) -> DataFrame:
    """Log rows with the delivery they come in: ``days`` days each, one row in 50 a delivery later."""
    events = _events(spark, root)
    first = events.agg(F.to_date(F.min("ts")).alias("_first"))
    late = F.when(F.col("event_id") % 50 == 7, 1).otherwise(0)
    part = F.floor(F.date_diff(F.to_date("ts"), "_first") / days) + late
    return events.crossJoin(F.broadcast(first)).select(
        F.least(part, F.lit(parts - 1)).cast("int").alias("part"), F.col("ts").cast("timestamp").alias("recorded_at"), (F.col("status") == "FAILED").alias("failed")
    )
