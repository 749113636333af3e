"""The monthly batch: sources to bronze, gate, silver, forecast, statements, exports.

Each layer is written once and read back by the next stage, so no stage
recomputes another and a lost executor costs at most the stage it was in.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc
from ledgerline.operators import kpis, quality, statements, valuation
from ledgerline.params import SCHEMA_VERSIONS, TABLES, IngestionWindow
from ledgerline.schemas import business_columns, get_schema, nullable_copy
from ledgerline.sources import layers
from ledgerline.sources.financials import financials_and_macro
from ledgerline.sources.logs import RunLogger, config_snapshot_event
from ledgerline.sources.tables import scan_layer, tag_provenance

EXPORTS = (
    "silver_annual", "gold_monthly_forecast", "gold_annual_forecast", "gold_scenarios",
    "gold_income_stmt", "gold_balance_sheet", "gold_cash_flow",
)


@dataclasses.dataclass(frozen=True)
class RunConfig:
    run_id: str
    as_of: dt.date
    company: str = "nation"
    window: IngestionWindow | None = None  # a part of the history; all of it by default
    horizon_months: int = 36


def new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("run_%Y%m%d_%H%M%S")


class BatchRun:
    """One run over one output root; stages are methods in run order."""

    def __init__(self, spark: SparkSession, source_root: str, root: str, config: RunConfig):
        self.spark, self.source_root, self.root, self.config = spark, source_root, root, config
        self.rows_failed: dict[str, int] = {}
        self.macro: DataFrame | None = None  # made along with the financials
        self.log = RunLogger(
            spark, config.run_id, self._path("gold_audit_log"), self._path("bronze_run_log")
        )

    def _path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table]}"

    def _read(self, table: str, schema: str | None = None) -> DataFrame:
        """A layer table; bronze tables hold one snapshot per run, of which the newest is read."""
        if table.startswith("bronze"):
            return layers.read_snapshot(self.spark, self._path(table), self.config.run_id)
        return scan_layer(self.spark, self.root, table, get_schema(schema) if schema else None)

    def _bronze(self, df: DataFrame, table: str, schema: str, source: str) -> int:
        tagged = tag_provenance(df, self.config.run_id, source, SCHEMA_VERSIONS["bronze_financials"])
        rows = layers.enforce_schema(tagged, get_schema(schema))
        return layers.write_partitioned(rows, self._path(table), ("_run_id",))

    def ingest_financials(self) -> int:
        fin, self.macro = financials_and_macro(
            self.spark, self.source_root, self.config.company, self.config.window
        )
        return self._bronze(fin, "bronze_financials", "bronze_company_financials", "orders")

    def ingest_macro(self) -> int:
        return self._bronze(self.macro, "bronze_macro", "bronze_macro_indicators", "orders")

    def _fin(self) -> DataFrame:
        names = [f.name for f in business_columns(get_schema("bronze_company_financials"))]
        return self._read("bronze_financials").select(*names)

    def _macro(self) -> DataFrame:
        names = [f.name for f in business_columns(get_schema("bronze_macro_indicators"))]
        return self._read("bronze_macro").select(*names)

    def dq_validation(self) -> int:
        """Log every check, park failing rows, and stop the run if there are too many."""
        fin, macro = self._fin(), self._macro()
        schemas = {
            t: nullable_copy(get_schema(t)) for t in (quality.FINANCIALS, quality.MACRO)
        }
        results = quality.run_checks(fin, macro, self.config.as_of, schemas)
        # by run, so that a retried run replaces what it wrote before
        run_id = self.config.run_id
        layers.write_run(
            quality.stamp_log(results, run_id), self._path("silver_dq_log"), "run_id", run_id
        )
        parked = layers.write_run(
            quality.quarantine(fin, run_id), self._path("quarantine_financials"), "_run_id", run_id
        )
        self.rows_failed["dq_validation"] = parked
        if parked:
            self.log.event("dq_validation", "rows quarantined", "WARN",
                           event_type="quarantine", rows_affected=parked)
        return quality.enforce_gate(fin)

    def silver_transforms(self) -> int:
        clean = quality.clean_rows(self._fin()).transform(quality.silver_validate)
        silver = kpis.silver_monthly(clean, self._macro()).withColumns(
            {
                "_processed_at": F.current_timestamp(),
                "_run_id": F.lit(self.config.run_id),
                "_schema_version": F.lit(SCHEMA_VERSIONS["silver_monthly"]),
            }
        )
        rows = layers.overwrite_partitioned(silver, self._path("silver_monthly"), ("year",))
        layers.overwrite(kpis.annual_rollup(self._read("silver_monthly")), self._path("silver_annual"))
        return rows

    def forecasting(self) -> int:
        history = self._read("silver_monthly")
        end = self.config.window.end if self.config.window else history.agg(F.max("date")).first()[0]
        first_month = (end.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
        monthly = fc.gold_monthly(history, self.config.horizon_months, first_month, until=end)
        rows = layers.overwrite(monthly, self._path("gold_monthly_forecast"))
        layers.overwrite(
            fc.gold_annual(self._read("gold_monthly_forecast")), self._path("gold_annual_forecast")
        )
        cases = fc.scenarios(self._read("gold_annual_forecast"))
        balances = ["company", "scenario", "year", *fc.CLOSING_COLUMNS]
        registered = fc.to_gold_schema(
            cases, self._read("silver_annual"), self.config.run_id, first_month
        )
        layers.overwrite(
            registered.join(cases.select(*balances), balances[:3]), self._path("gold_scenarios")
        )
        return rows

    def financial_statements(self) -> int:
        years = statements.combine_years(
            self._read("silver_annual"), self._read("gold_annual_forecast")
        )
        layers.overwrite(statements.income_statement(years), self._path("gold_income_stmt"))
        layers.overwrite(statements.balance_sheet(years), self._path("gold_balance_sheet"))
        rows = layers.overwrite(
            statements.cash_flow_statement(
                self._read("gold_income_stmt"), self._read("gold_balance_sheet")
            ),
            self._path("gold_cash_flow"),
        )
        layers.overwrite(valuation.dcf(self._read("gold_scenarios")), self._path("gold_dcf"))
        return rows

    def export(self) -> int:
        return sum(
            layers.export_csv(self._read(t), f"{self.root}/exports/{t}") for t in EXPORTS
        )

    def run(self) -> dict[str, int]:
        """All stages in order. A failing stage ends the run, except the export."""
        layers.append(
            config_snapshot_event(self.spark, self.config.run_id), self._path("gold_audit_log")
        )
        rows: dict[str, int] = {}
        try:
            for stage in (
                self.ingest_financials, self.ingest_macro, self.dq_validation,
                self.silver_transforms, self.forecasting, self.financial_statements, self.export,
            ):
                self._run_stage(stage, rows)
            self.log.event("export", "Pipeline SUCCESS", event_type="pipeline_complete")
        finally:
            self.log.flush()
        return rows

    def _run_stage(self, stage, rows: dict[str, int]) -> None:
        name, started = stage.__name__, dt.datetime.now(dt.timezone.utc)
        try:
            rows[name] = stage()
        except Exception as error:
            self.log.stage(name, "failed", started, error=str(error))
            self.log.event(name, f"Pipeline FAILED in {name}", "ERROR", event_type="pipeline_complete")
            if name != "export":
                raise
            return
        self.log.stage(name, "success", started, rows[name], self.rows_failed.get(name, 0))


def run(spark: SparkSession, source_root: str, root: str, config: RunConfig) -> dict[str, int]:
    return BatchRun(spark, source_root, root, config).run()


