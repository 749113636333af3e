"""Queries over audit, run and data-quality logs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio


def run_health(audit: DataFrame, today: dt.date, days: int = 30) -> DataFrame:
    """Completed runs per day, split by outcome."""
    complete = F.col("event_type") == "pipeline_complete"
    return (
        audit.filter(F.col("recorded_at") >= F.date_sub(F.lit(today), days).cast("timestamp"))
        .groupBy(F.to_date("recorded_at").alias("run_date"))
        .agg(
            F.count_if(complete & F.col("message").like("%SUCCESS%")).alias("successes"),
            F.count_if(complete & F.col("message").like("%FAILED%")).alias("failures"),
        )
    )


def dq_trend(dq_log: DataFrame, check_name: str = "gross_profit_identity") -> DataFrame:
    """Failure percentage of one check over time."""
    return dq_log.filter(F.col("check_name") == check_name).select(
        F.to_date("checked_at").alias("check_date"),
        (F.col("failure_pct") * 100).alias("failure_pct"),
    ).orderBy(F.col("check_date").desc())


def mean_duration(audit: DataFrame) -> DataFrame:
    """Mean run time in seconds, read from the completion message."""
    seconds = F.regexp_extract("message", r"([0-9.]+)s", 1).try_cast("double")
    return audit.filter(F.col("event_type") == "pipeline_complete").agg(
        F.avg(seconds).alias("avg_duration_seconds")
    )


def recent_problems(audit: DataFrame, top: int = 50) -> DataFrame:
    """The newest warnings and errors."""
    return (
        audit.filter(F.col("severity").isin("WARN", "ERROR"))
        .select("run_id", "stage", "event_type", "message", "recorded_at")
        .orderBy(F.col("recorded_at").desc(), "run_id", "message")
        .limit(top)
    )


def failed_checks(dq_log: DataFrame) -> DataFrame:
    return (
        dq_log.filter(~F.col("passed"))
        .select("run_id", "check_name", "failure_pct", "passed", "checked_at")
        .orderBy(F.col("checked_at").desc())
    )


def quarantine_listing(quarantined: DataFrame) -> DataFrame:
    return quarantined.select(
        "date", "company", "revenue", "_quarantine_reason", "_quarantined_at"
    ).orderBy(F.col("_quarantined_at").desc(), "company", "date")


def latest_rows(bronze: DataFrame, top: int = 20) -> DataFrame:
    """The newest bronze rows with their gross margin."""
    return (
        bronze.select("date", "company", "revenue", ratio("gross_profit", "revenue").alias("gross_margin"))
        .orderBy(F.col("date").desc(), "company")
        .limit(top)
    )


def stage_summary(run_log: DataFrame, stages: list[str]) -> DataFrame:
    """One row per run and planned stage with the latest status; ``not_run`` where absent."""
    wanted = F.array(*[F.lit(s) for s in stages])
    planned = run_log.groupBy("run_id").agg(F.first(wanted).alias("_stages")).select(
        "run_id", F.posexplode("_stages").alias("stage_no", "stage")
    )
    state = F.struct("started_at", "status", "duration_seconds", "rows_processed")
    latest = run_log.groupBy("run_id", "stage").agg(F.max(state).alias("_last"))
    return planned.join(latest, ["run_id", "stage"], "left").select(
        "run_id",
        "stage_no",
        "stage",
        F.coalesce(F.col("_last.status"), F.lit("not_run")).alias("status"),
        F.col("_last.duration_seconds").alias("duration_seconds"),
        F.col("_last.rows_processed").alias("rows_processed"),
    )


def tracked_metrics(
    ingested: DataFrame,
    gate_row: DataFrame,
    dq_log: DataFrame,
    run_log: DataFrame,
    mape: DataFrame,
    statements: DataFrame,
) -> DataFrame:
    """The run's tracked metrics, one row per metric; each part is a one-row aggregate."""
    parts = {
        "rows_ingested": ingested.agg(F.count("*").cast("double").alias("value")),
        "rows_failed_dq": dq_log.agg(F.sum("rows_failed").cast("double").alias("value")),
        "rows_quarantined": gate_row.select(F.col("rows_quarantined").cast("double").alias("value")),
        "pipeline_duration_seconds": run_log.agg(F.sum("duration_seconds").alias("value")),
        "forecast_mape": mape.agg(F.avg("mape").alias("value")),
    }
    errors = statements.agg(
        F.max("bs_balance_check").alias("bs_balance_error"),
        F.avg("cf_reconciliation").alias("cf_reconciliation_error"),
    ).unpivot([], ["bs_balance_error", "cf_reconciliation_error"], "metric", "value")
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("metric"), "value") for name, df in parts.items()] + [errors],
    )


def with_metadata(audit: DataFrame, fields: dict[str, str], column: str = "metadata_json") -> DataFrame:
    """Audit rows with their metadata as VARIANT and typed fields of it.

    ``metadata`` is null where the text is null or no JSON; a field (name -> type) is null where
    the key is missing, or its value is of another kind and cannot be cast.
    """
    parsed = audit.withColumn("metadata", F.try_parse_json(F.col(column)))
    return parsed.withColumns({name: F.try_variant_get("metadata", f"$.{name}", kind) for name, kind in fields.items()})


def metadata_schemas(audit: DataFrame, by: str, column: str = "metadata_json") -> DataFrame:
    """Per value of ``by``: the schema that covers all its metadata, rows with and without valid metadata."""
    parsed = audit.withColumn("_parsed", F.try_parse_json(F.col(column)))
    return parsed.groupBy(by).agg(
        F.schema_of_variant_agg("_parsed").alias("metadata_schema"),
        F.count("_parsed").alias("valid"),
        F.count_if(F.col("_parsed").isNull() & F.col(column).isNotNull()).alias("malformed"),
        F.count_if(F.col(column).isNull()).alias("missing"),
    )
