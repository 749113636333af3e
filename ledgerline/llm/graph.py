"""Connected components over pairs of ids, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import save, tidy


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and the smallest id of their component for the edges (a[i], b[i]); roots left out."""
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(ids)))
    return ids[member], ids[label[member]]


def spanning(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the edges of a lightest spanning forest: every round each part takes its
    lightest edge to another part. Ties go to the earlier edge."""
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(weight, kind="stable")] = np.arange(len(a))
    by_rank = np.argsort(rank)
    part, kept = np.arange(len(ids)), np.zeros(len(a), bool)
    while True:
        apart = np.flatnonzero(part[x] != part[y])
        if not len(apart):
            return np.flatnonzero(kept)
        lightest = np.full(len(ids), len(a))
        np.minimum.at(lightest, part[x[apart]], rank[apart])
        np.minimum.at(lightest, part[y[apart]], rank[apart])
        taken = by_rank[np.unique(lightest[lightest < len(a)])]
        kept[taken] = True
        members, roots = forest(part[x[taken]], part[y[taken]])
        new = np.arange(len(ids))
        new[members] = roots
        part = new[part]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as stars around its components' smallest ids."""
    for batch in batches:
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) long ids -> (id, component_id) of every id in an edge; smallest id of each component.

    Alternates two steps until nothing changes: every id points all its larger neighbours at
    the smallest one it knows, then all its smaller ones. Both are a minimum per id (combined
    before the shuffle, so a hub costs one row per task) and a join back on it. Batches of
    edges are first reduced to stars, so repeated links do not travel. Nulls and loops are
    ignored; an empty table gives an empty result.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    stars = save(pairs.mapInArrow(tidy(_contract), "a long, b long").distinct(), "edges")
    for _ in range(rounds):
        # a > b throughout: each a with several b links all of them to the smallest
        least = stars.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        # large step: the smaller end pulls its larger neighbours to its own smallest neighbour
        low = least.select(F.col("a").alias("b"), "m")
        large = stars.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.inline(
                F.when(F.col("b") == F.col("m"), F.array(F.struct(F.col("a"), F.col("m").alias("b")))).otherwise(
                    F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
                )
            )
        )
        new = save(small.distinct(), "edges")
        # Done when every a has one b and no b is itself an a.
        open_ends = new.join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        double = 0 if open_ends else new.groupBy("a").count().where("count > 1").limit(1).count()
        stars = new
        if not open_ends and not double:
            roots = stars.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
            return stars.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
