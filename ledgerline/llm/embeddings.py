"""Embedding near-duplicates: cross-polytope hashing with multiprobe and verified pairs.

A hash rotates a unit vector at random (three rounds of random signs and a fast Hadamard
transform) and takes the nearest vertex of the cross-polytope: the largest coordinate by
absolute value, with its sign. A table concatenates ``k`` hashes; every vector is kept in
the buckets of its two nearest vertices per hash (multiprobe), so two vectors meet if they
share any of them. Buckets are verified by matrix products in double precision.

No pair is written out: a bucket returns, per vector, how many links it found and one edge
to its group's smallest id. A pair that meets in several buckets is counted in the first
bucket they share, which both sides know from their codes.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import mix64, save
from ledgerline.llm.graph import components, forest

NEAR, PROBES = 0.9, 2
#: Recall planned for pairs right at the threshold; closer pairs are found more often.
RECALL = 0.985
#: Members of a bucket aimed at, and members that one task compares with as many others.
AIM, BLOCK = 1500, 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Walsh-Hadamard transform of each row (length a power of two)."""
    rows, n = x.shape
    h = 1
    while h < n:
        y = x.reshape(rows, n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, n)
        h *= 2
    return x / math.sqrt(n)


def vertices(x: np.ndarray, seed: int) -> np.ndarray:
    """The two nearest cross-polytope vertices of each row after rotation ``seed``, nearest first."""
    n = 1 << (x.shape[1] - 1).bit_length() if x.shape[1] > 1 else 2
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    for signs in np.random.default_rng([seed, n]).choice([-1.0, 1.0], size=(3, n)):
        x = hadamard(x * signs)
    best = np.argpartition(-np.abs(x), PROBES - 1, axis=1)[:, :PROBES]
    size = np.take_along_axis(x, best, 1)
    order = np.argsort(-np.abs(size), axis=1, kind="stable")
    best, size = np.take_along_axis(best, order, 1), np.take_along_axis(size, order, 1)
    return 2 * best + (size > 0)


def codes(x: np.ndarray, tables: int, k: int) -> np.ndarray:
    """(rows, tables, probes ** k) bucket codes; equal codes of a table are one bucket."""
    out = []
    for t in range(tables):
        code = np.zeros((len(x), 1), np.uint64)
        for h in range(k):
            near = vertices(x, t * k + h).astype(np.uint64)
            code = mix64(code[:, :, None] * np.uint64(1 << 20) + near[:, None, :] + np.uint64(1)).reshape(len(x), -1)
        out.append(code)
    return np.stack(out, axis=1).view(np.int64)


#: The trial below is on vectors in general position; ones with few components tie in a table.
LEAST_TABLES = 3


@cache
def shared(dim: int, near: float) -> float:
    """Chance that two vectors right at the threshold share a vertex of one hash, by trial."""
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=(2, 1000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a if dim > 1 else 0
    b = near * a + math.sqrt(1 - near * near) * b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    met = [(vertices(a, s)[:, :, None] == vertices(b, s)[:, None, :]).any(axis=(1, 2)).mean() for s in range(4)]
    return min(max(float(np.mean(met)), 0.05), 0.999)


def plan(n: int, dim: int, near: float = NEAR) -> tuple[int, int]:
    """(tables, hashes per table): buckets near the size aimed at, tables for the recall."""
    k = 1
    while n * PROBES**k / (2 * max(dim, 2)) ** k > AIM and k < 8:
        k += 1
    return max(LEAST_TABLES, math.ceil(math.log(1 - RECALL) / math.log(1 - shared(dim, near) ** k))), k


def _hashed(tables: int, k: int):
    def run(vectors: pa.Array) -> pa.Array:
        lengths = vectors.value_lengths().to_numpy()
        out = np.zeros((len(lengths), tables * PROBES**k), np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths):
            where = np.flatnonzero(lengths == dim)
            for at in range(0, len(where), 4096):
                own = where[at : at + 4096]
                x = flat[starts[own][:, None] + np.arange(dim)]
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                out[own] = codes(x, tables, k).reshape(len(own), -1)
        ends = np.arange(0, out.size + 1, out.shape[1] or 1, dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return F.arrow_udf(run, T.ArrayType(T.LongType()))


FOUND = "id long, n long, root long"


def _verified(tables: int, k: int, near: float):
    probes = PROBES**k

    def run(key: tuple, group: pa.Table) -> pa.Table:
        table, code, _, first, second = (x.as_py() for x in key)
        ids, copies = group.column("id").to_numpy(), group.column("m").to_numpy()
        x = group.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        code_of = group.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), tables, probes)
        part = group.column("part").to_numpy()
        rows, columns = np.flatnonzero(part == first), np.flatnonzero(part == second)
        links = np.zeros(len(ids), np.int64)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(rows), 256):
            own = rows[at : at + 256]
            i, j = np.nonzero(x[own] @ x[columns].T >= near)
            i, j = own[i], columns[j]
            apart = ids[i] < ids[j] if first == second else ids[i] != ids[j]
            i, j = i[apart], j[apart]
            p, q = forest(ids[i], ids[j])
            a.append(p)
            b.append(q)
            mine = np.ones(len(i), bool)
            for t in range(table):  # met in an earlier table: counted there
                mine &= ~(code_of[i, t][:, :, None] == code_of[j, t][:, None, :]).any(axis=(1, 2))
            i, j = i[mine], j[mine]
            both = np.where((code_of[i, table][:, :, None] == code_of[j, table][:, None, :]).any(axis=2), code_of[i, table], np.iinfo(np.int64).max)
            mine = both.min(axis=1, initial=np.iinfo(np.int64).max) == code
            i, j = i[mine], j[mine]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
        members, roots = forest(np.concatenate(a), np.concatenate(b))
        root = dict(zip(members.tolist(), roots.tolist(), strict=True))
        seen = np.flatnonzero((links > 0) | np.isin(ids, members))
        own = ids[seen].tolist()
        return pa.table({"id": pa.array(own, pa.int64()), "n": links[seen], "root": pa.array([root.get(v, v) for v in own], pa.int64())})

    return run


def near_vectors(vectors: DataFrame, near: float = NEAR) -> DataFrame:
    """(vec_id, embedding) -> vec_id, n_links, component_id, kept, one row per input row.

    Equal vectors form a class without comparison, and a class enters the search once.
    Vectors that are null, zero or hold null or non-finite components link with nothing, nor
    do vectors of different lengths. A row without id links like any other, but names no
    component: one of such rows alone has none. Rows of one id with different vectors are
    separate, too, and link like any others. Repeated rows are separate copies.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    plain = F.transform("vector", lambda v: v + F.lit(0).cast("float"))  # -0.0 becomes 0.0
    rows = rows.withColumn("vector", F.when(usable, plain))
    keyed = rows.withColumn("h", F.xxhash64("vector")).withColumn("g", F.xxhash64("vector", F.lit(1)))
    classes = keyed.where("vector IS NOT NULL").groupBy("h", "g").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.min("vector").alias("vector")
    )
    # A number for each class, fixed when it is stored: ids may be missing or stand at several vectors.
    classes = save(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    n, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    tables, k = plan(n, dim or 1, near)
    hashed = save(
        classes.select(F.col("node").alias("id"), "m", "vector", _hashed(tables, k)("vector").alias("codes")), "hashed"
    )
    probes = PROBES**k
    in_buckets = hashed.select(
        "id", "m", "vector", "codes", F.size("vector").alias("dim"), F.posexplode("codes").alias("at", "code")
    ).withColumn("table", F.floor(F.col("at") / probes).cast("int"))
    key = ["table", "code", "dim"]
    sizes = (
        hashed.select(F.size("vector").alias("dim"), F.posexplode("codes").alias("at", "code"))
        .withColumn("table", F.floor(F.col("at") / probes).cast("int"))
        .groupBy(*key)
        .count()
        .where("count > 1")
        .select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    )
    # Large buckets: every pair of parts is a task of its own; a row goes to each of its part's.
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (
        in_buckets.join(sizes, key)
        .withColumn("part", part)
        .withColumn("other", other)
        .withColumn("first", F.least("part", "other"))
        .withColumn("second", F.greatest("part", "other"))
        .select(*key, "first", "second", "part", "id", "m", "vector", "codes")
    )
    found = save(dealt.groupBy(*key, "first", "second").applyInArrow(_verified(tables, k, near), FOUND), "links")
    links = found.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "node")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).select(
        F.col("id").alias("node"), F.col("component_id").alias("root")
    )
    members = classes.select("node", "h", "g", "id", "m").join(joined, "node", "left").join(links, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    smallest = members.groupBy("root").agg(F.min("id").alias("component_id"))
    named = members.join(smallest, "root").select("h", "g", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    linked = keyed.where("vector IS NOT NULL").select("vec_id", "h", "g").join(named, ["h", "g"]).drop("h", "g")
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
