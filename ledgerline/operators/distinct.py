"""Distinct counts that can be merged over periods: sketches, and exact bitmaps.

Distinct counts do not add up, but what they are counted from does: a month's sketch or bitmap
is made once and merged into every period the month belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's registers. One standard error of an estimate is 1.04 / 2 ** (LG_K / 2).
LG_K = 12
#: Standard errors within which an estimate has to lie.
ERRORS = 4


def error_bound(lg_k: int = LG_K) -> float:
    """Relative error that an estimate stays below (``ERRORS`` standard errors)."""
    return ERRORS * 1.04 / 2 ** (lg_k / 2)


def sketches(rows: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """(keys, sketch): a HyperLogLog sketch of the distinct values per key. Nulls are not counted."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def merged_estimate(sketched: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): estimate of the distinct values of all sketches of a key together."""
    return sketched.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def bitmaps(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, bucket, bits): which whole numbers a key has, 32,768 of them per bitmap. Nulls are left out."""
    number = F.col(value).cast("long")
    dealt = rows.where(number.isNotNull()).withColumn("bucket", F.bitmap_bucket_number(number))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    return dealt.groupBy(*keys, "bucket").agg(bits)


def merged_count(mapped: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): exact number of distinct values of all bitmaps of a key together."""
    merged = mapped.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def into_windows(monthly: DataFrame, months: int, last: DataFrame | None = None) -> DataFrame:
    """Rows of a month (``date``) once for each window of so many months that they belong to.

    ``date`` becomes the window's last month. With ``last`` (one row, one date) no window ends
    after it. A row is repeated ``months`` times at most.
    """
    ends = F.sequence("date", F.add_months("date", months - 1), F.expr("INTERVAL 1 MONTH"))
    spread = monthly.withColumn("date", F.explode(ends))
    if last is None:
        return spread
    return spread.join(F.broadcast(last.select(F.col(last.columns[0]).alias("_last"))), F.col("date") <= F.col("_last")).drop("_last")
