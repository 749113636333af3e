import datetime as dt

import numpy as np
import pandas as pd
import pytest
from helpers import month, months
from pyspark.sql import functions as F

from ledgerline.operators import timeseries as ts


def ordered(df, *cols):
    return [tuple(r) for r in df.orderBy("company", "date").select(*cols).collect()]


def test_complete_months_fills_gaps_per_company(spark):
    df = months(spark, {"a": [1, ..., ..., 4], "b": [7, 8]})
    got = ordered(ts.complete_months(df), "company", "date", "revenue", "is_gap")
    assert got == [
        ("a", month(0), 1.0, False), ("a", month(1), None, True), ("a", month(2), None, True),
        ("a", month(3), 4.0, False), ("b", month(0), 7.0, False), ("b", month(1), 8.0, False),
    ]


def test_complete_months_keeps_repeated_months(spark):
    df = months(spark, {"a": [1, 2, 3]}).unionByName(months(spark, {"a": [..., 9]}))
    assert ts.complete_months(df).count() == 4


def test_extend_months(spark):
    got = ordered(ts.extend_months(months(spark, {"a": [1, 2], "b": [5]}), 2), "company", "date", "revenue", "step")
    assert got == [
        ("a", month(0), 1.0, 0), ("a", month(1), 2.0, 0), ("a", month(2), None, 1), ("a", month(3), None, 2),
        ("b", month(0), 5.0, 0), ("b", month(1), None, 1), ("b", month(2), None, 2),
    ]


def test_interpolation_matches_pandas_on_random_gaps(spark):
    rng = np.random.default_rng(7)
    series = {}
    for c in "abcdef":
        v = rng.normal(100, 20, 30)
        v[rng.random(30) < 0.5] = np.nan
        series[c] = [None if np.isnan(x) else x for x in v]
    df = months(spark, series)
    got = ts.interpolate_linear(df, "revenue").orderBy("company", "date").toPandas()
    for c, values in series.items():
        want = pd.Series(values, dtype=float).interpolate(method="linear").to_numpy()
        np.testing.assert_allclose(got[got.company == c]["revenue"].astype(float), want, rtol=1e-12)


def test_ffill_then_bfill_matches_pandas(spark):
    values = [None, None, 3, None, 5, None]
    got = [r[0] for r in ordered(ts.ffill_bfill(months(spark, {"a": values}), "revenue"), "revenue")]
    assert got == pd.Series(values, dtype=float).ffill().bfill().tolist()


def test_resample_means_and_empty_months(spark):
    rows = [("a", dt.datetime(2020, 1, 3), 10.0), ("a", dt.datetime(2020, 1, 9), 20.0),
            ("a", dt.datetime(2020, 3, 1), 7.5)]
    df = spark.createDataFrame(rows, "company string, ts timestamp, x double")
    got = ordered(ts.resample_month(df, ("company",), "ts", "x"), "date", "x")
    assert got == [(month(0), 15.0), (month(1), None), (month(2), 7.5)]


def test_pct_change_ramp_and_mean(spark):
    df = months(spark, {"a": [100, 110, None, 0, 5]})
    df = df.withColumn("p", ts.pct_change("revenue", 1)).withColumn("r", ts.ramp(0.0, 8.0))
    got = ordered(df.withColumn("m", ts.fill_mean("revenue")), "p", "r", "m")
    assert [g[1] for g in got] == [0, 2, 4, 6, 8]
    assert got[0][0] is None and abs(got[1][0] - 10) < 1e-9 and got[4][0] is None
    assert got[2][2] == (100 + 110 + 0 + 5) / 4


def test_ramp_of_a_single_row(spark):
    assert months(spark, {"a": [1]}).select(ts.ramp(3.0, 9.0)).first()[0] == 3.0


def test_date_range_is_inclusive(spark):
    df = months(spark, {"a": [1, 2, 3, 4]})
    assert [r[0] for r in ordered(ts.date_range(df, month(1), month(2)), "revenue")] == [2.0, 3.0]


def test_upsample_years(spark):
    df = spark.createDataFrame([("a", 2020, 12.0), ("a", 2021, 24.0)], "company string, year int, x double")
    got = ts.upsample_year_to_month(df, "x").orderBy("date").agg(F.count("*"), F.sum("x")).first()
    assert got[0] == 13 and abs(got[1] - sum(12.0 + i for i in range(13))) < 1e-9


def test_complete_months_up_to_a_common_end(spark):
    df = ts.complete_months(months(spark, {"a": [1, 2], "b": [1, 2, 3, 4]}), until=month(3))
    assert {r.company: r["count"] for r in df.groupBy("company").count().collect()} == {"a": 4, "b": 4}


def test_resample_keeps_small_places(spark):
    df = spark.sql("SELECT 'a' AS company, TIMESTAMP '2020-01-03' AS ts, x FROM VALUES (0.1234D), (0.1239D) v(x)")
    assert ts.resample_month(df, ("company",), "ts", "x").first().x == pytest.approx(0.12365)
    assert ts.resample_month(df, ("company",), "ts", "x", scale=2).first().x == pytest.approx(0.12)
