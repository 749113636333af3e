"""Joins on time: the last known value as of a time, and overlaps of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    keys: list[str],
    tie: str,
    tolerance: float | None = None,
    seconds: int = 86_400,
) -> DataFrame:
    """Each left row with the last right row of its keys at or before its time ``on``.

    Right columns other than the keys come with the prefix ``right_`` and are null where there
    is no such row, or where it is more than ``tolerance`` seconds older. Of right rows at one
    time the one with the largest ``tie`` counts. Rows without a time match nothing.

    Time is cut into ranges of ``seconds``. Within a range a running ``last`` over both tables
    finds the row; what is known before a range is carried into it, as one row per range. So a
    key's rows are dealt to its ranges, and no key is one task.
    """
    keep = [c for c in right.columns if c not in keys]
    epoch = F.unix_micros(F.col(on).cast("timestamp"))
    found = F.struct(*[F.col(c) for c in keep])
    known = right.where(F.col(on).isNotNull()).select(*keys, epoch.alias("_t"), F.col(tie).alias("_tie"), found.alias("_found"))
    asked = left.select("*", epoch.alias("_t"))
    cut = F.floor(F.col("_t") / (seconds * 1_000_000)).alias("_range")
    known, asked = known.select("*", cut), asked.select("*", cut)

    # The last row of each range is what later ranges know at first; equal keys, null included.
    last = known.groupBy(*keys, "_range").agg(F.max_by("_found", F.struct("_t", "_tie")).alias("_carried"))
    ranges = last.unionByName(asked.select(*keys, "_range", F.lit(None).cast(last.schema["_carried"].dataType).alias("_carried")).distinct())
    ranges = ranges.groupBy(*keys, "_range").agg(F.first("_carried", ignorenulls=True).alias("_carried"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(*keys, "_range", F.last("_carried", ignorenulls=True).over(before).alias("_carried")).where("_carried IS NOT NULL")

    row = F.struct(*[F.col(c) for c in left.columns])
    kind = asked.select(row.alias("_row")).schema["_row"].dataType
    both = known.select(*keys, "_range", "_t", "_tie", F.lit(0).alias("_side"), "_found", F.lit(None).cast(kind).alias("_row")).unionByName(
        asked.select(*keys, "_range", "_t", F.lit(None).cast(known.schema["_tie"].dataType).alias("_tie"), F.lit(1).alias("_side"),
                     F.lit(None).cast(known.schema["_found"].dataType).alias("_found"), row.alias("_row"))
    )
    carried = carried.select(*keys, "_range", F.lit(None).cast("long").alias("_t"), F.lit(None).cast(known.schema["_tie"].dataType).alias("_tie"),
                             F.lit(0).alias("_side"), F.col("_carried").alias("_found"), F.lit(None).cast(kind).alias("_row"))
    # A carried row comes first in its range: it has no time.
    running = Window.partitionBy(*keys, "_range").orderBy(F.asc_nulls_first("_t"), "_side", F.asc_nulls_first("_tie")).rowsBetween(Window.unboundedPreceding, 0)
    joined = both.unionByName(carried).withColumn("_found", F.last("_found", ignorenulls=True).over(running)).where("_side = 1")
    if tolerance is not None:
        age = joined["_t"] - F.unix_micros(F.col(f"_found.{on}").cast("timestamp"))
        joined = joined.withColumn("_found", F.when(age <= F.lit(int(tolerance * 1_000_000)), F.col("_found")))
    dated = F.when(F.col(f"_row.{on}").isNotNull(), F.col("_found"))
    return joined.withColumn("_found", dated).select("_row.*", *[F.col(f"_found.{c}").alias(f"right_{c}") for c in keep])


def interval_join(left: DataFrame, right: DataFrame, start: str, stop: str, unit: int = 1) -> DataFrame:
    """Pairs of rows whose day intervals [start, stop] overlap; each pair once.

    ``start`` and ``stop`` are date columns of both tables; right ones come as ``right_*``.
    An interval with a null end, or that stops before it starts, overlaps nothing.

    An interval's level is that of the smallest buckets (``unit`` days doubled as often as
    needed) of which it touches two at most, so a long one costs no more rows than a short
    one. A pair meets on the higher of its two levels: rows are copied to the levels above
    their own that the other side has, and joined there on the bucket. Of the buckets that a
    pair shares, the one in which the overlap starts counts.
    """
    left, right = _levelled(left, start, stop, unit), _levelled(right.toDF(*[f"right_{c}" for c in right.columns]), f"right_{start}", f"right_{stop}", unit)
    levels = {side: sorted(r[0] for r in df.select("_level").distinct().collect()) for side, df in (("left", left), ("right", right))}
    names = [*[c for c in left.columns if c[0] != "_"], *[c for c in right.columns if c[0] != "_"]]
    # A row on its own level with those of the other side of the same or a lower level.
    pairs = [
        _met(_placed(left, start, stop, unit), _placed(_raised(right, levels["left"]), f"right_{start}", f"right_{stop}", unit), start, unit),
        _met(_placed(_raised(left, levels["right"], above=True), start, stop, unit), _placed(right, f"right_{start}", f"right_{stop}", unit), start, unit),
    ]
    low, high = F.greatest(F.col(start), F.col(f"right_{start}")), F.least(F.col(stop), F.col(f"right_{stop}"))
    return pairs[0].unionByName(pairs[1]).where(low <= high).select(*names)


def _day(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date"))


def _levelled(df: DataFrame, start: str, stop: str, unit: int) -> DataFrame:
    """Adds ``_level``: the first at which an interval is no longer than a bucket."""
    days = _day(stop) - _day(start) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(days / F.lit(unit)))).cast("int")
    return df.where(F.col(start) <= F.col(stop)).withColumn("_level", level)


def _raised(df: DataFrame, levels: list[int], above: bool = False) -> DataFrame:
    """Rows copied to those of ``levels`` that are not below (or are above) their own: 40 at most."""
    given = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
    own = F.col("_level")
    return df.withColumn("_level", F.explode(F.filter(given, lambda x: x > own if above else x >= own)))


def _placed(df: DataFrame, start: str, stop: str, unit: int) -> DataFrame:
    """A row for each bucket that an interval touches on its level."""
    size = F.lit(unit) * F.pow(F.lit(2), F.col("_level")).cast("long")
    first, last = F.floor(_day(start) / size), F.floor(_day(stop) / size)
    return df.withColumn("_bucket", F.explode(F.sequence(first, last)))


def _met(left: DataFrame, right: DataFrame, start: str, unit: int) -> DataFrame:
    size = F.lit(unit) * F.pow(F.lit(2), F.col("_level")).cast("long")
    begins = F.greatest(_day(start), _day(f"right_{start}"))
    return left.join(right, ["_level", "_bucket"]).where(F.floor(begins / size) == F.col("_bucket"))


def sessions(rows: DataFrame, keys: list[str], on: str, stage: str, gap: float, seconds: int = 86_400) -> DataFrame:
    """Sessions of each key: runs of rows no more than ``gap`` seconds apart.

    Returns keys, ``session_start``, ``session_end``, ``n_rows``, ``duration`` (seconds) and
    ``stages``: the values of ``stage`` in the order they first occur (ties by name, a null one
    left out). Rows without a time are in no session. Equal times are in the same one.

    Time is cut into ranges of ``seconds``: sessions within a range are found first, so a key's
    rows are dealt to its ranges; then a key's sessions, one row each, are joined across ranges.
    """
    micros, far = F.unix_micros(F.col(on).cast("timestamp")), F.lit(int(gap * 1_000_000))

    def numbered(df: DataFrame, start: str, stop: str, by: list[str], name: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(start, stop)
        begins = F.coalesce((F.col(start) - F.lag(stop).over(order) > far).cast("int"), F.lit(1))
        return df.withColumn("_new", begins).withColumn(name, F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    # Keys are packed, so that a column of the table can have any name.
    packed = rows.where(F.col(on).isNotNull()).select(F.struct(*keys).alias("_key"), micros.alias("_t"), F.col(stage).cast("string").alias("_stage"))
    dealt = packed.withColumn("_range", F.floor(F.col("_t") / (seconds * 1_000_000)))
    local = numbered(dealt, "_t", "_t", ["_key", "_range"], "_local").groupBy("_key", "_range", "_local", "_stage")
    local = local.agg(F.min("_t").alias("_start"), F.max("_t").alias("_stop"), F.count("*").alias("_n"))
    per_stage = F.collect_list(F.struct("_stage", "_start", "_n")).alias("_stages")
    local = local.groupBy("_key", "_range", "_local").agg(F.min("_start").alias("_start"), F.max("_stop").alias("_stop"), per_stage)
    whole = numbered(local, "_start", "_stop", ["_key"], "_session")
    whole = whole.select("_key", "_session", "_stop", F.inline(F.transform("_stages", lambda s: F.struct(s["_stage"].alias("_stage"), s["_start"].alias("_first"), s["_n"].alias("_n")))))
    whole = whole.groupBy("_key", "_session", "_stage").agg(F.min("_first").alias("_first"), F.max("_stop").alias("_stop"), F.sum("_n").alias("_n"))
    seen = F.when(F.col("_stage").isNotNull(), F.struct("_first", "_stage"))
    found = whole.groupBy("_key", "_session").agg(
        F.min("_first").alias("_first"), F.max("_stop").alias("_last"), F.sum("_n").alias("n_rows"),
        F.concat_ws(" > ", F.transform(F.array_sort(F.collect_list(seen)), lambda s: s["_stage"])).alias("stages"),
    )
    return found.select(
        "_key.*", F.timestamp_micros("_first").alias("session_start"), F.timestamp_micros("_last").alias("session_end"), "n_rows",
        ((F.col("_last") - F.col("_first")) / 1_000_000).alias("duration"), "stages",
    )
