"""Explicit table schemas, written as DDL and looked up by table name."""

from __future__ import annotations

from pyspark.sql import types as T

PROVENANCE_DDL = (
    "_ingested_at timestamp not null, _run_id string not null, "
    "_source string not null, _schema_version string not null"
)

# Column names, order, types and nullability are fixed values of the data model.
FINANCIAL_COLUMNS_DDL = (
    "date date not null, company string not null, revenue double not null, "
    "cogs double not null, gross_profit double not null, opex double, "
    "rd_expense double, sga_expense double, ebitda double, depreciation double, "
    "ebit double, interest_expense double, ebt double, tax_expense double, "
    "net_income double, accounts_receivable double, inventory double, "
    "accounts_payable double, capex double, customers bigint, "
    "avg_revenue_per_user double, churn_rate double"
)
MACRO_COLUMNS_DDL = (
    "date date not null, inflation_rate double, interest_rate double, "
    "gdp_growth double, usd_zar double, unemployment double"
)

_DDL = {
    "bronze_company_financials": f"{FINANCIAL_COLUMNS_DDL}, {PROVENANCE_DDL}",
    "bronze_macro_indicators": f"{MACRO_COLUMNS_DDL}, {PROVENANCE_DDL}",
    "bronze_pipeline_run_log": (
        "run_id string not null, stage string not null, status string not null, "
        "started_at timestamp not null, completed_at timestamp, "
        "duration_seconds double, rows_processed bigint, rows_failed bigint, "
        "error_message string, config_snapshot string"
    ),
    "silver_monthly_financials": (
        "date date not null, year int not null, month int not null, "
        "quarter int not null, company string not null, revenue double not null, "
        "cogs double not null, gross_profit double not null, opex double, "
        "rd_expense double, sga_expense double, ebitda double, depreciation double, "
        "ebit double, interest_expense double, ebt double, tax_expense double, "
        "net_income double, gross_margin double, ebitda_margin double, "
        "ebit_margin double, net_margin double, cogs_ratio double, opex_ratio double, "
        "accounts_receivable double, inventory double, accounts_payable double, "
        "working_capital double, dso double, dio double, dpo double, "
        "cash_conversion_cycle double, revenue_mom double, revenue_yoy double, "
        "net_income_yoy double, revenue_ttm double, customers bigint, "
        "revenue_per_customer double, churn_rate double, inflation_rate double, "
        "interest_rate double, gdp_growth double, usd_zar double, "
        "real_revenue_growth double, interest_coverage double, "
        "_processed_at timestamp not null, _run_id string not null, "
        "_schema_version string not null"
    ),
    "silver_data_quality_log": (
        "run_id string not null, table_name string not null, "
        "check_name string not null, check_type string not null, column_name string, "
        "rows_checked bigint not null, rows_failed bigint not null, "
        "failure_pct double not null, threshold double, passed boolean not null, "
        "details string, checked_at timestamp not null"
    ),
    "gold_annual_forecast": (
        "year int not null, company string not null, scenario string not null, "
        "revenue double not null, cogs double, gross_profit double, opex double, "
        "rd_expense double, sga_expense double, ebitda double, depreciation double, "
        "ebit double, interest_expense double, ebt double, tax_expense double, "
        "net_income double, cfo double, capex double, fcf double, "
        "gross_margin double, ebitda_margin double, net_margin double, "
        "revenue_growth_yoy double, is_forecast boolean not null, "
        "forecast_model string, _forecast_date date not null, "
        "_run_id string not null, _schema_version string not null"
    ),
    "gold_audit_log": (
        "run_id string not null, event_type string not null, stage string, "
        "table_name string, rows_affected bigint, message string, "
        "severity string not null, metadata_json string, recorded_at timestamp not null"
    ),
}

REGISTERED = tuple(_DDL)


def get_schema(table_name: str) -> T.StructType:
    """Schema of a registered table; ``KeyError`` for an unknown name.

    The DDL is parsed by Spark, so a session has to be running.
    """
    try:
        ddl = _DDL[table_name]
    except KeyError:
        raise KeyError(
            f"no schema for '{table_name}', registered: {sorted(REGISTERED)}"
        ) from None
    return T.StructType.fromDDL(ddl)


def business_columns(schema: T.StructType) -> list[T.StructField]:
    """Fields without the underscore-prefixed provenance columns."""
    return [f for f in schema.fields if not f.name.startswith("_")]


def nullable_copy(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable (every file read is nullable)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
