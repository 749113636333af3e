import datetime as dt

import pytest
from helpers import full_history, month

from ledgerline.operators import kpis


def test_growth_compares_the_same_month_across_a_gap(spark):
    df = full_history(spark, 26).filter(f"date != '{month(3)}'")
    rows = {r.date: r for r in kpis.monthly_kpis(df).collect()}
    assert month(3) not in rows and len(rows) == 25
    assert rows[month(4)].revenue_mom is None
    assert rows[month(15)].revenue_yoy is None
    assert rows[month(16)].revenue_yoy == pytest.approx(
        rows[month(16)].revenue / rows[month(4)].revenue - 1
    )
    assert rows[month(14)].revenue_ttm == pytest.approx(
        sum(rows[month(i)].revenue for i in range(4, 15))
    )


def test_other_companies_do_not_matter(spark):
    alone = full_history(spark, 24, ("a",))
    both = full_history(spark, 24, ("a", "b"))
    one = kpis.monthly_kpis(alone).orderBy("date").collect()
    two = kpis.monthly_kpis(both).filter("company = 'a'").orderBy("date").collect()
    assert one == two


def test_zero_denominators_give_null(spark):
    from pyspark.sql import functions as F

    df = full_history(spark, 1).withColumns({"revenue": F.lit(0.0), "customers": F.lit(0).cast("bigint")})
    row = kpis.monthly_kpis(df).first()
    assert row.gross_margin is None and row.dso is None and row.revenue_per_customer is None


def test_months_without_macro_keep_the_row(spark):
    macro = spark.createDataFrame(
        [(month(0), 5.0, 7.0, 1.0, 15.0, 30.0)],
        "date date, " + ", ".join(f"{c} double" for c in kpis.MACRO_COLUMNS),
    )
    rows = kpis.silver_monthly(full_history(spark, 14), macro).orderBy("date").collect()
    assert len(rows) == 14
    assert rows[0].inflation_rate == 5.0 and rows[1].inflation_rate is None
    assert rows[13].real_revenue_growth is None and rows[13].revenue_yoy is not None
    assert rows[0].quarter == 1 and rows[0].interest_coverage == pytest.approx(rows[0].ebit / 5.0)


def test_interest_coverage_without_interest(spark):
    from pyspark.sql import functions as F

    df = full_history(spark, 1).withColumns(
        {"interest_expense": F.lit(0.0), "inflation_rate": F.lit(1.0), "revenue_yoy": F.lit(0.1)}
    )
    row = kpis.macro_adjusted(df).first()
    assert row.interest_coverage == row.ebit
    assert row.real_revenue_growth == pytest.approx(0.09)


def test_year_end_values_are_of_the_last_month(spark):
    from pyspark.sql import functions as F

    silver = kpis.monthly_kpis(full_history(spark, 24)).withColumns(
        {c: F.lit(1.0) for c in kpis.MACRO_COLUMNS}
    )
    annual = {r.year: r for r in kpis.annual_rollup(silver.repartition(7)).collect()}
    last = {r.date: r for r in silver.collect()}[dt.date(2020, 12, 1)]
    assert annual[2020].accounts_receivable == last.accounts_receivable
    assert annual[2020].customers_eoy == 10
    assert annual[2020].revenue == pytest.approx(
        sum(r.revenue for r in silver.collect() if r.date.year == 2020)
    )


def test_cascade_floors_tax_at_zero(spark):
    from pyspark.sql import functions as F

    df = full_history(spark, 1).withColumn("interest_expense", F.lit(1e6))
    row = kpis.pnl_cascade(df).first()
    assert row.tax_expense == 0.0 and row.net_income == row.ebt < 0
