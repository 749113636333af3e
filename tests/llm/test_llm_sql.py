import duckdb

from ledgerline.llm import queries


def test_sql_counterparts(spark):
    root = "/root/testdata/sf0.001"
    base = duckdb.connect()
    base.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/documents.parquet')")
    for name, sql in queries.ORACLE_SQL.items():
        found = queries.QUERIES[name](spark, root)
        columns = sorted(found.columns)
        ours = sorted(tuple(map(str, r)) for r in found.select(*columns).collect())
        theirs = sorted(tuple(map(str, r)) for r in base.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
        assert ours == theirs, name
