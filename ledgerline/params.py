"""Model, quality and scenario parameters.

The defaults are fixed values of the modelled domain: they have to equal the
published assumptions for results to agree.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json


@dataclasses.dataclass(frozen=True)
class IngestionWindow:
    """Inclusive date range, for a model that is to be fitted on a part of the history."""

    start: dt.date
    end: dt.date


@dataclasses.dataclass(frozen=True)
class QualityLimits:
    """Thresholds of the quality gate (fixed values)."""

    max_null_pct: float = 0.05
    max_data_age_days: int = 45
    revenue_min: int = 50_000
    revenue_max: int = 50_000_000
    gross_margin_min: float = 0.10
    gross_margin_max: float = 0.95
    ebitda_margin_min: float = -0.50
    ebitda_margin_max: float = 0.80
    max_revenue_growth_yoy: float = 2.00
    min_revenue_growth_yoy: float = -0.80
    identity_tolerance: float = 1.0
    bs_tolerance: float = 10.0
    linkage_tolerance: float = 100.0
    dq_fail_threshold: float = 0.10


@dataclasses.dataclass(frozen=True)
class ModelAssumptions:
    """Statement and valuation assumptions (fixed values)."""

    corporate_tax_rate: float = 0.28
    dividend_payout_ratio: float = 0.30
    retention_ratio: float = 0.7
    debt_decay: float = 0.95
    implied_interest_rate: float = 0.07
    periods_per_year: int = 12
    opening_ppe_capex_multiple: float = 4.0
    paid_in_revenue_share: float = 0.3
    ratio_band: float = 0.03
    cogs_efficiency: float = 0.03
    opex_efficiency: float = 0.05
    days_per_month: int = 30
    fcf_conversion: float = 0.85
    interval_z: float = 1.2816
    default_wacc: float = 0.12
    default_terminal_growth: float = 0.025


@dataclasses.dataclass(frozen=True)
class ServingAssumptions:
    """Fallback rates used by the serving variant of the statements (fixed values)."""

    opening_ppe_revenue_share: float = 0.4
    paid_in_revenue_share: float = 0.25
    receivables_rate: float = 0.12
    inventory_rate: float = 0.08
    payables_rate: float = 0.06
    capex_rate: float = 0.05
    depreciation_rate: float = 0.04


@dataclasses.dataclass(frozen=True)
class Scenario:
    name: str
    revenue_adj: float
    margin_adj: float


# The three planning scenarios.
SCENARIOS = (
    Scenario("Base", 1.00, 0.000),
    Scenario("Bull", 1.12, 0.020),
    Scenario("Bear", 0.88, -0.025),
)

# How much of a margin shift reaches each profit line.
SCENARIO_EBITDA_PASS_THROUGH = 0.7
SCENARIO_NET_PASS_THROUGH = 0.5
SHOCK_NET_PASS_THROUGH = 0.6

# Stages in run order.
STAGES = (
    "ingest_financials",
    "ingest_macro",
    "dq_validation",
    "silver_transforms",
    "forecasting",
    "financial_statements",
    "export",
)

# Version written into each layer's rows.
SCHEMA_VERSIONS = {
    "bronze_financials": "v1.2",
    "silver_monthly": "v1.1",
    "gold_forecast": "v1.0",
}

# Logical table names, layer first.
TABLES = {
    "bronze_financials": "bronze/company_financials",
    "bronze_macro": "bronze/macro_indicators",
    "bronze_run_log": "bronze/pipeline_run_log",
    "silver_monthly": "silver/monthly_financials",
    "silver_annual": "silver/annual_financials",
    "silver_dq_log": "silver/data_quality_log",
    "gold_monthly_forecast": "gold/monthly_forecast",
    "gold_annual_forecast": "gold/annual_forecast",
    "gold_scenarios": "gold/scenario_forecasts",
    "gold_income_stmt": "gold/income_statement",
    "gold_balance_sheet": "gold/balance_sheet",
    "gold_cash_flow": "gold/cash_flow_statement",
    "gold_dcf": "gold/dcf_valuation",
    "gold_audit_log": "gold/audit_log",
    "quarantine_financials": "quarantine/financials",
}


def config_snapshot() -> str:
    """All parameters as one JSON text, for the audit log."""
    return json.dumps(
        {
            "dq": dataclasses.asdict(QualityLimits()),
            "model": dataclasses.asdict(ModelAssumptions()),
            "scenarios": [dataclasses.asdict(s) for s in SCENARIOS],
            "stages": list(STAGES),
        },
        sort_keys=True,
    )
