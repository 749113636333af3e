"""Layer table writers on plain parquet, snapshots and shared scratch space.

A table that is being read is never overwritten: upserts go to a new run
snapshot (``_run_id=...``) and readers pick the newest one. Row counts come from
an ``Observation`` on the write itself, so no write is followed by a count.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import nullable_copy

COUNTER = "rows"


class DuplicateKeys(ValueError):
    """An upsert source holds the same key twice."""


class StaleRun(ValueError):
    """A run id that sorts before the newest snapshot."""


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints.

    Only a local session without one gets a temporary folder; on a cluster that would be
    another folder on each machine, so the setting is asked for.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/ledgerline/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Store a derived table that several branches read, cutting its lineage.

    It is a table in the shared folder, which lost executors do not take along, and whose
    size the planner knows.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, path: str, mode: str, partitions: tuple[str, ...] = (), fmt="parquet", **options) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias(COUNTER)).write.mode(mode).options(**options)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.format(fmt).save(path)
    return seen.get[COUNTER]


def _clustered(df: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Rows of one partition value together, so a write opens few files per task.

    Adaptive execution splits a value that is far larger than the others.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def overwrite(df: DataFrame, path: str) -> int:
    """Full refresh."""
    return _write(df, path, "overwrite")


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...]) -> int:
    """Replace only the partitions that the input touches."""
    return _write(
        _clustered(df, partitions), path, "overwrite", partitions, partitionOverwriteMode="dynamic"
    )


def overwrite_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...]) -> int:
    """Full refresh of a partitioned table: partitions that the input lacks go."""
    return _write(
        _clustered(df, partitions), path, "overwrite", partitions, partitionOverwriteMode="static"
    )


def write_run(df: DataFrame, path: str, column: str, run_id: str) -> int:
    """Replace what the table holds of one run, also by no rows; ``column`` names the runs."""
    return _write(df.drop(column), f"{path}/{_folder(df.sparkSession, run_id, column)}", "overwrite")


def append(df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> int:
    return _write(_clustered(df, partitions), path, "append", partitions)


def export_csv(df: DataFrame, path: str) -> int:
    return _write(df, path, "overwrite", fmt="csv", header=True)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder and safely cast to a schema; raises on a missing or incompatible column.

    Extra columns raise too, instead of being dropped in silence. NOT NULL is
    left to the gate's null checks, since every file read is nullable.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the schema: {extra}")
    return df.to(nullable_copy(schema))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a source row, plus all source rows."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if a key repeats; stops at the first one found."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).first()
    if repeated is not None:
        raise DuplicateKeys(f"source repeats key {repeated.asDict()}")


def upsert_snapshot(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], run_id: str
) -> int:
    """Upsert into the newest snapshot and write the outcome as the snapshot of ``run_id``.

    ``run_id`` has to sort after the ids already there, else ``StaleRun``. A retried run
    replaces its own snapshot, building again on the one before it. A table at ``path``
    that holds no snapshots is left alone (``ValueError``).
    """
    require_unique(source, keys)
    rows = source
    runs = snapshot_runs(spark, path)
    if runs and run_id < runs[-1]:
        raise StaleRun(f"{run_id!r} sorts before the newest snapshot {runs[-1]!r}")
    if previous := [r for r in runs if r < run_id]:
        rows = upsert(_snapshot(spark, path, previous[-1]).drop("_run_id"), source, keys)
    return write_partitioned(rows.withColumn("_run_id", F.lit(run_id)), path, ("_run_id",))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def snapshot_runs(spark: SparkSession, path: str) -> list[str]:
    """Ids of the snapshots at ``path``, oldest first, from the names of its folders.

    One name per run; no data is read. Raises if the folder holds another kind of table.
    """
    if not exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    entries = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [e.getPath().getName() for e in entries]
    runs = [unescape(n.removeprefix("_run_id=")) for n in names if n.startswith("_run_id=")]
    if not runs and any(not n.startswith(("_", ".")) for n in names):
        raise ValueError(f"{path} holds a table without snapshots")
    return sorted(runs)


def _snapshot(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/{_folder(spark, run_id)}")
    return rows.withColumn("_run_id", F.lit(run_id))


def _folder(spark: SparkSession, run_id: str, column: str = "_run_id") -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(run_id)}"


def read_snapshot(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The newest snapshot, or the newest not after ``run_id``: one folder is read.

    Raises ``LookupError`` if there is none.
    """
    runs = [r for r in snapshot_runs(spark, path) if run_id is None or r <= run_id]
    if not runs:
        raise LookupError(f"{path} has no snapshot" + (f" up to {run_id!r}" if run_id else ""))
    return _snapshot(spark, path, runs[-1])


def as_of(df: DataFrame, keys: list[str], run_id: str | None = None) -> DataFrame:
    """Per key, the row of the newest run not after ``run_id``.

    An aggregate rather than a ranking window: repeated keys are reduced before
    the shuffle.
    """
    rows = df if run_id is None else df.filter(F.col("_run_id") <= run_id)
    values = [c for c in df.columns if c not in keys and c != "_run_id"]
    newest = F.max(F.struct("_run_id", *values)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def new_partitions(source: DataFrame, target: DataFrame, partitions: list[str]) -> DataFrame:
    """Source rows whose partition value the target does not have yet.

    New rows of an existing partition are left out; use ``upsert`` to take them.
    """
    return source.join(target.select(*partitions).distinct(), partitions, "left_anti")


def write_incremental(
    spark: SparkSession, df: DataFrame, path: str, partitions: tuple[str, ...]
) -> int:
    """Append only partitions that are absent; the first write takes everything."""
    if not partitions:
        raise ValueError("an incremental write needs partition columns")
    if not exists(spark, path):
        return append(df, path, partitions)
    existing = spark.read.parquet(path)
    return append(new_partitions(df, existing, list(partitions)), path, partitions)


def ingest_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns, total nulls and date range in one aggregate."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        nulls.alias("n_nulls"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )
