"""Scans of source and layer tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.params import TABLES
from ledgerline.schemas import nullable_copy

NUMERIC_TEXT_TYPE = "double"

# Column types of the transactional source tables.
STAR_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def star_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the transactional star schema; the declared types save the inference job."""
    return spark.read.schema(STAR_DDL[name]).parquet(f"{root}/{name}.parquet")


def scan_layer(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """A layer table by logical name, or by path relative to ``root``.

    A declared schema skips the footer read that inference needs and pins the
    types between runs.
    """
    reader = spark.read if schema is None else spark.read.schema(nullable_copy(schema))
    return reader.parquet(f"{root}/{TABLES.get(table, table)}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema, text columns that hold only numbers become numeric."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return coerce_numeric(reader.csv(path))


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Turn each string column numeric if every non-null value parses, else keep it.

    One aggregate over all columns decides, so a single row comes back to the
    driver however large the file is.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    verdict = df.agg(
        *[
            (
                F.count(F.col(c).try_cast(NUMERIC_TEXT_TYPE)) == F.count(F.col(c))
            ).alias(c)
            for c in texts
        ]
    ).first()
    return reduce(
        lambda acc, c: acc.withColumn(c, F.col(c).cast(NUMERIC_TEXT_TYPE)) if verdict[c] else acc,
        texts,
        df,
    )


def tag_provenance(
    df: DataFrame, run_id: str, source: str, schema_version: str, ingested_at=None
) -> DataFrame:
    """Add the four provenance columns; ``ingested_at`` pins the time of a re-run."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return df.withColumns(
        {
            "_ingested_at": stamp,
            "_run_id": F.lit(run_id),
            "_source": F.lit(source),
            "_schema_version": F.lit(schema_version),
        }
    )


def priority_merge(sources: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """For each key, the row of the first listed source that has it, with its source name.

    ``min_by`` combines on the map side, so a key repeated a billion times still
    sends one candidate per task through the shuffle. Within one source the
    smallest row wins, which keeps repeated keys deterministic.
    """
    names = sources[0][1].columns
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(*names).withColumns({"_rank": F.lit(i), "_source": F.lit(name)})
            for i, (name, df) in enumerate(sources)
        ],
    )
    values = [c for c in names if c not in keys]
    best = F.min(F.struct("_rank", *values, "_source")).alias("_best")
    return tagged.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_best.{c}").alias(c) for c in values], F.col("_best._source").alias("_source")
    )


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a table addressable by name in SQL."""
    df.createOrReplaceTempView(name)
    return df
