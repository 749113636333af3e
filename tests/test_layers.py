import pytest
from pyspark.sql import functions as F

from ledgerline.sources import layers, tables


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, rows, ddl="id int, v double"):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_overwrite_and_append_return_row_counts(spark, path):
    assert layers.overwrite(frame(spark, [(1, 1.0), (2, 2.0)]), path) == 2
    assert layers.append(frame(spark, [(3, 3.0)]), path) == 1
    assert spark.read.parquet(path).count() == 3
    assert layers.overwrite(frame(spark, [(9, 9.0)]), path) == 1
    assert rows(spark.read.parquet(path)) == [(9, 9.0)]
    assert layers.append(frame(spark, []), path) == 0


def test_partition_overwrite_leaves_other_partitions(spark, path):
    ddl = "id int, year int"
    layers.write_partitioned(frame(spark, [(1, 2020), (2, 2021)], ddl), path, ("year",))
    layers.write_partitioned(frame(spark, [(3, 2021)], ddl), path, ("year",))
    assert rows(spark.read.parquet(path)) == [(1, 2020), (3, 2021)]


def test_incremental_skips_known_partitions(spark, path):
    ddl = "id int, year int"
    assert layers.write_incremental(spark, frame(spark, [(1, 2020)], ddl), path, ("year",)) == 1
    again = frame(spark, [(1, 2020), (5, 2020), (2, 2021)], ddl)
    assert layers.write_incremental(spark, again, path, ("year",)) == 1
    assert layers.write_incremental(spark, again, path, ("year",)) == 0
    assert rows(spark.read.parquet(path)) == [(1, 2020), (2, 2021)]
    with pytest.raises(ValueError):
        layers.write_incremental(spark, again, path, ())


def test_upsert_snapshots(spark, path):
    layers.upsert_snapshot(spark, path, frame(spark, [(1, 1.0), (2, 2.0)]), ["id"], "run_1")
    change = frame(spark, [(2, 20.0), (3, 30.0)])
    for _ in range(2):  # a retried run replaces its own snapshot
        layers.upsert_snapshot(spark, path, change, ["id"], "run_2")
        got = rows(layers.read_snapshot(spark, path).drop("_run_id"))
        assert got == [(1, 1.0), (2, 20.0), (3, 30.0)]
    assert rows(layers.read_snapshot(spark, path, "run_1").drop("_run_id")) == [(1, 1.0), (2, 2.0)]


def test_upsert_keeps_its_target(spark, path):
    first = frame(spark, [(1, 1.0)])
    layers.upsert_snapshot(spark, path, first, ["id"], "run_9")
    with pytest.raises(layers.StaleRun):  # sorts before run_9 as text
        layers.upsert_snapshot(spark, path, frame(spark, [(2, 2.0)]), ["id"], "run_10")
    assert rows(layers.read_snapshot(spark, path)) == [(1, 1.0, "run_9")]
    assert layers.snapshot_runs(spark, path) == ["run_9"]
    with pytest.raises(LookupError):
        layers.read_snapshot(spark, path, "run_1")


def test_upsert_leaves_other_tables_alone(spark, path):
    layers.overwrite(frame(spark, [(1, 1.0), (2, 2.0)]), path)
    with pytest.raises(ValueError):
        layers.upsert_snapshot(spark, path, frame(spark, [(3, 3.0)]), ["id"], "run_1")
    assert spark.read.parquet(path).count() == 2


def test_run_ids_with_odd_characters(spark, path):
    for run_id in ("run 1/a=b", "run 2:%"):
        layers.upsert_snapshot(spark, path, frame(spark, [(1, 1.0)]), ["id"], run_id)
    assert layers.snapshot_runs(spark, path) == ["run 1/a=b", "run 2:%"]
    assert rows(layers.read_snapshot(spark, path)) == [(1, 1.0, "run 2:%")]


def test_a_full_refresh_drops_old_partitions(spark, path):
    ddl = "id int, year int"
    layers.overwrite_partitioned(frame(spark, [(1, 2020), (2, 2021)], ddl), path, ("year",))
    layers.overwrite_partitioned(frame(spark, [(3, 2021)], ddl), path, ("year",))
    assert rows(spark.read.parquet(path)) == [(3, 2021)]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Cluster()
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})()

    with pytest.raises(RuntimeError):
        layers.shared_dir(Session())


def test_upsert_refuses_repeated_source_keys(spark, path):
    with pytest.raises(layers.DuplicateKeys):
        layers.upsert_snapshot(spark, path, frame(spark, [(1, 1.0), (1, 2.0)]), ["id"], "run_1")


def test_as_of_takes_the_newest_row_per_key(spark):
    df = frame(spark, [(1, "r1", 1.0), (1, "r3", 3.0), (2, "r2", 2.0)], "id int, _run_id string, v double")
    assert rows(layers.as_of(df, ["id"])) == [(1, "r3", 3.0), (2, "r2", 2.0)]
    assert rows(layers.as_of(df, ["id"], "r2")) == [(1, "r1", 1.0), (2, "r2", 2.0)]


def test_schema_enforcement(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("v double not null, id bigint")
    assert layers.enforce_schema(frame(spark, [(1, 1.0)]), schema).columns == ["v", "id"]
    with pytest.raises(Exception):
        layers.enforce_schema(frame(spark, [(1,)], "id int"), T.StructType.fromDDL("v double not null")).collect()
    with pytest.raises(ValueError):
        layers.enforce_schema(frame(spark, [(1, 1.0)]), T.StructType.fromDDL("id int"))


def test_csv_coercion_keeps_mixed_columns(spark, path):
    df = frame(spark, [("1", "x", "2.5"), ("2", "7", None)], "a string, b string, c string")
    assert layers.export_csv(df, path) == 2
    back = tables.read_csv(spark, path)
    assert dict(back.dtypes) == {"a": "double", "b": "string", "c": "double"}


def test_priority_merge(spark):
    first = frame(spark, [(1, 1.0)])
    second = frame(spark, [(1, 5.0), (2, 6.0)])
    got = tables.priority_merge([("x", first), ("y", second)], ["id"])
    assert rows(got) == [(1, 1.0, "x"), (2, 6.0, "y")]


def test_profile(spark):
    df = spark.sql("SELECT DATE '2020-01-01' AS date, CAST(NULL AS DOUBLE) AS x UNION ALL SELECT DATE '2020-03-01', 1D")
    row = layers.ingest_profile(df, "t").first()
    assert (row.n_rows, row.n_columns, row.n_nulls, str(row.max_date)) == (2, 2, 1, "2020-03-01")


def test_materialize_uses_the_configured_folder(spark):
    df = layers.materialize(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert layers.shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_views(spark):
    tables.register_view(spark.range(3), "numbers")
    assert spark.sql("SELECT sum(id) FROM numbers").first()[0] == 3
