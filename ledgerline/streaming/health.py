"""Health of runs from a stream of log files, kept up to date by micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Length and step of the windows; rows of windows that ended this long before the newest row are late.
LENGTH, STEP, LATENESS = "2 days", "1 day", "3 days"


def health(rows: DataFrame, length: str = LENGTH, step: str | None = STEP) -> DataFrame:
    """(recorded_at, failed) -> rows and failures per window; tumbling windows without a ``step``.

    The same plan for a table and a stream. A row without a time is in no window.
    """
    window = F.window("recorded_at", length, step) if step else F.window("recorded_at", length)
    return rows.groupBy(window.alias("_window")).agg(F.count("*").alias("n_rows"), F.count_if("failed").alias("n_failed")).select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "n_rows", "n_failed"
    )


def _store(changed: DataFrame, path: str) -> None:
    changed.write.mode("overwrite").parquet(path)


def follow(
    spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str,
    length: str = LENGTH, step: str | None = STEP, lateness: str = LATENESS,
) -> None:
    """Takes all log files of ``landing`` that are new since the last call into ``table``, then ends.

    State, watermark and files seen are in ``checkpoint``; a call after a crash goes on there.
    Each micro-batch writes its changed windows to a folder named by its number, so a repeated
    batch replaces its own rows; ``latest`` picks the newest row of a window.
    """
    rows = spark.readStream.schema(schema).parquet(landing).withWatermark("recorded_at", lateness)

    def upsert(changed: DataFrame, batch: int) -> None:
        _store(changed, f"{table}/_batch={batch}")

    stream = health(rows, length, step).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    stream.foreachBatch(upsert).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The windows of ``table`` as of its newest micro-batch."""
    stored = spark.read.option("basePath", table).parquet(table)
    values = F.max_by(F.struct("n_rows", "n_failed"), "_batch").alias("_values")
    return stored.groupBy("window_start", "window_end").agg(values).select("window_start", "window_end", "_values.*")


def with_late_rows(
    followed: DataFrame, rows: DataFrame, length: str = LENGTH, step: str | None = STEP
) -> DataFrame:
    """``late_rows`` beside each window: how many of all ``rows`` came after it was closed."""
    whole = health(rows, length, step).select("window_start", "window_end", F.col("n_rows").alias("_all"))
    kept: Column = F.coalesce("n_rows", F.lit(0))
    return whole.join(followed, ["window_start", "window_end"], "left").select(
        "window_start", "window_end", kept.alias("n_rows"), F.coalesce("n_failed", F.lit(0)).alias("n_failed"),
        (F.col("_all") - kept).alias("late_rows"),
    )
