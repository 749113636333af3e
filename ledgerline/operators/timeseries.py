"""Calendar, resampling, filling and change operators for keyed monthly series.

Every window is partitioned by the series key, so no step funnels all series
through one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio


def complete_months(
    df: DataFrame, keys: tuple[str, ...] = ("company",), until: dt.date | None = None
) -> DataFrame:
    """Insert the missing months between the first and last row of each series.

    Each row explodes to itself plus the gap up to the next row, so filling the
    calendar needs one sort by key and no join. Inserted rows have null measures
    and ``is_gap`` true. With ``until`` every series is continued to that month,
    which gives series that stop early the same end as the others.
    """
    upcoming = F.lead("date").over(Window.partitionBy(*keys).orderBy("date"))
    slot_end = F.add_months(upcoming, -1)
    if until is not None:
        slot_end = F.coalesce(slot_end, F.trunc(F.lit(until), "month"))
    # greatest ignores the null after the last row and keeps one slot for a repeated month
    slots = df.withColumn("_until", F.greatest(slot_end, F.col("date"))).withColumn(
        "_slot", F.explode(F.sequence("date", "_until", F.expr("interval 1 month")))
    )
    own = F.col("_slot") == F.col("date")
    return slots.select(
        *[
            F.col("_slot").alias("date")
            if c == "date"
            else (F.col(c) if c in keys else F.when(own, F.col(c)).alias(c))
            for c in df.columns
        ],
        (~own).alias("is_gap"),
    )


def extend_months(df: DataFrame, periods: int, keys: tuple[str, ...] = ("company",)) -> DataFrame:
    """Append ``periods`` future months to each series.

    The last row of a series explodes into itself and its future, so the
    extension reads its input once. ``step`` is 0 on history rows and 1..periods
    on future rows, whose other columns are null.
    """
    last = F.max("date").over(Window.partitionBy(*keys))
    steps = F.when(
        F.col("date") == last, F.sequence(F.lit(0), F.lit(periods))
    ).otherwise(F.array(F.lit(0)))
    grown = df.withColumn("_steps", steps).select("*", F.explode("_steps").alias("step"))
    own = F.col("step") == 0
    return grown.select(
        *[
            F.add_months("date", F.col("step")).alias("date")
            if c == "date"
            else (F.col(c) if c in keys else F.when(own, F.col(c)).alias(c))
            for c in df.columns
        ],
        "step",
    )


def resample_month(
    df: DataFrame, keys: tuple[str, ...], ts: str, value: str, scale: int | None = None
) -> DataFrame:
    """Mean per month start on a gap-free monthly grid; months without data are null.

    Values are averaged as they are. With ``scale`` they are amounts of that many places,
    summed exactly, so that the mean does not depend on the order of addition.
    """
    amount = F.col(value) if scale is None else F.col(value).cast(f"decimal(18,{scale})")
    mean = F.avg(amount) if scale is None else ratio(F.sum(amount).cast("double"), F.count(amount))
    months = df.groupBy(*keys, F.trunc(ts, "month").alias("date")).agg(mean.alias(value))
    return complete_months(months, keys).drop("is_gap")


def _nearest(value: Column, keys: tuple[str, ...], ahead: bool = False) -> Column:
    """The closest non-null value at or before a row, or at or after it.

    Looking ahead runs over descending dates: a growing frame is linear, while a
    frame up to the end of the series would be scanned again for every row.
    """
    date = F.col("date").desc() if ahead else F.col("date")
    frame = Window.partitionBy(*keys).orderBy(date).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.last(value, ignorenulls=True).over(frame)


def interpolate_linear(
    df: DataFrame, value: str, keys: tuple[str, ...] = ("company",), out: str | None = None
) -> DataFrame:
    """Linear interpolation by row position between known values.

    Rows before the first known value stay null; rows after the last carry it.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(value).alias("v")))
    x0, x1 = F.col("_left"), F.col("_right")
    share = ratio((F.col("_pos") - x0["p"]).cast("double"), (x1["p"] - x0["p"]).cast("double"))
    filled = F.when(x1.isNull() | (x1["p"] == x0["p"]), x0["v"]).otherwise(
        x0["v"] + (x1["v"] - x0["v"]) * share
    )
    return (
        df.withColumn("_pos", F.row_number().over(order))
        .withColumns(
            {
                "_left": _nearest(known, keys),
                "_right": _nearest(known, keys, ahead=True),
            }
        )
        .withColumn(out or value, F.when(x0.isNotNull(), filled))
        .drop("_pos", "_left", "_right")
    )


def upsample_year_to_month(
    df: DataFrame, value: str, keys: tuple[str, ...] = ("company",)
) -> DataFrame:
    """Annual points (``year``) placed on January and interpolated to months."""
    points = df.select(*keys, F.make_date("year", F.lit(1), F.lit(1)).alias("date"), value)
    return interpolate_linear(complete_months(points, keys).drop("is_gap"), value, keys)


def ffill_bfill(
    df: DataFrame, value: str, keys: tuple[str, ...] = ("company",), out: str | None = None
) -> DataFrame:
    """Carry the last known value forward, then the first known value backward."""
    forward, backward = _nearest(F.col(value), keys), _nearest(F.col(value), keys, ahead=True)
    return df.withColumn(out or value, F.coalesce(forward, backward))


def pct_change(value: str, periods: int, keys: tuple[str, ...] = ("company",)) -> Column:
    """Change over ``periods`` rows in percent."""
    base = F.lag(value, periods).over(Window.partitionBy(*keys).orderBy("date"))
    return (ratio(F.col(value), base) - 1) * 100


def date_range(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Inclusive range of the ``date`` column."""
    return df.filter(F.col("date").between(F.lit(start), F.lit(end)))


def ramp(first: float, last: float, keys: tuple[str, ...] = ("company",)) -> Column:
    """Straight line from ``first`` to ``last`` over the rows of each series."""
    spec = Window.partitionBy(*keys)
    n = F.count("*").over(spec)
    i = F.row_number().over(spec.orderBy("date")) - 1
    slope = ratio(F.lit(last - first) * i, (n - 1).cast("double"))
    return F.lit(first) + F.coalesce(slope, F.lit(0.0))


def fill_mean(value: str, keys: tuple[str, ...] = ("company",)) -> Column:
    """Null becomes the mean of the series."""
    return F.coalesce(F.col(value), F.avg(value).over(Window.partitionBy(*keys)))
