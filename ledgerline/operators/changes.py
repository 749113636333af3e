"""Changes between two snapshots of a table, and sums that are kept up to date by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, DELETED, CHANGED = "inserted", "deleted", "changed"


def signed_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that the snapshots do not have in common, with ``sign``: how many more the new one has.

    A multiset difference both ways in one shuffle: equal rows are cancelled in the tasks
    before they move, repeated rows count as often as they come, and nulls equal nulls.
    """
    columns = new.columns
    both = new.withColumn("sign", F.lit(1)).unionByName(old.select(*columns).withColumn("sign", F.lit(-1)))
    return both.groupBy(*columns).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def kinds_of_change(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of a ``signed_difference``: inserted, deleted, or changed (both)."""
    came, gone = F.max("sign") > 0, F.min("sign") < 0
    kind = F.when(came & gone, CHANGED).when(came, INSERTED).otherwise(DELETED)
    return changes.groupBy(*keys).agg(kind.alias("change"))


def apply_delta(stored: DataFrame, delta: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Stored sums plus those of a delta, key by key; keys without ``rows`` left are gone.

    All columns but the keys are sums. What is zero for a key that has rows stays a row.
    """
    sums = [F.sum(c).alias(c) for c in stored.columns if c not in keys]
    return stored.unionByName(delta.select(*stored.columns)).groupBy(*keys).agg(*sums).where(F.col(rows) > 0)
