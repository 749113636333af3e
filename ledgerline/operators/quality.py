"""The data-quality gate: rules as data, one aggregate per table, quarantine split.

A table's row-level rules are conditional counts of a single aggregate, so a
table is scanned once however many rules it has. Key uniqueness and references
need a shuffle of their key columns only and run as separate narrow branches.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import by_date, growth, inline_rows, literal, ratio
from ledgerline.params import QualityLimits
from ledgerline.schemas import business_columns

FINANCIALS = "bronze_company_financials"
MACRO = "bronze_macro_indicators"
LIMITS = QualityLimits()

# Columns that may never be null.
FINANCIALS_NOT_NULL = ("date", "company", "revenue", "cogs", "gross_profit")
MACRO_NOT_NULL = ("date",)

# Fixed values: (column, smallest, largest, tolerated share outside).
FINANCIALS_RANGES = (
    ("revenue", LIMITS.revenue_min, LIMITS.revenue_max, 0.0),
    ("gross_profit", -1_000_000, 20_000_000, 0.0),
    ("churn_rate", 0.0, 1.0, 0.0),
    ("customers", 0, 100_000, 0.0),
)
MACRO_RANGES = (
    ("inflation_rate", -5.0, 50.0, 0.05),
    ("interest_rate", 0.0, 50.0, 0.0),
    ("gdp_growth", -20.0, 25.0, 0.05),
    ("usd_zar", 5.0, 50.0, 0.05),
)

NO_DATA_AGE_DAYS = 9999
# Rows that may fail two of the business rules, and quarantine reasons.
MARGIN_OUTSIDE_SHARE, COGS_ABOVE_REVENUE_SHARE = 0.02, 0.05
REASONS = {
    "null": "null_in_rule_input",
    "identity": "gross_profit_identity_failed",
    "revenue": "revenue_non_positive",
}


@dataclasses.dataclass(frozen=True, eq=False)
class Rule:
    """One check: ``failed`` and ``checked`` are aggregate expressions over the table."""

    name: str
    kind: str
    column: str
    failed: Column
    threshold: float
    details: str = ""
    checked: Column | None = None


def _violations(predicate: Column) -> Column:
    """Rows where the predicate is true; a null operand does not fail."""
    return F.count_if(predicate)


def hard_null_rules(df: DataFrame, columns: tuple[str, ...]) -> list[Rule]:
    return [
        Rule(f"not_null_{c}", "null_check", c, _violations(F.col(c).isNull()), 0.0)
        for c in columns
        if c in df.columns
    ]


def soft_null_rules(
    df: DataFrame, not_null: tuple[str, ...], limits: QualityLimits = LIMITS
) -> list[Rule]:
    return [
        Rule(
            f"null_pct_{f.name}",
            "null_check",
            f.name,
            _violations(F.col(f.name).isNull()),
            limits.max_null_pct,
        )
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
        and f.name not in not_null
        and not f.name.startswith("_")
    ]


def range_rules(df: DataFrame, ranges) -> list[Rule]:
    return [
        Rule(
            f"range_{c}_{low}_{high}",
            "range",
            c,
            _violations((F.col(c) < low) | (F.col(c) > high)),
            threshold,
            f"Expected [{low}, {high}]",
        )
        for c, low, high, threshold in ranges
        if c in df.columns
    ]


def _off_by(actual: str, expected: Column, tolerance: float) -> Column:
    return F.abs(F.col(actual) - expected) > tolerance


def business_rules(df: DataFrame, limits: QualityLimits = LIMITS) -> list[Rule]:
    margin = ratio("gross_profit", "revenue")
    low, high = limits.gross_margin_min, limits.gross_margin_max
    rules = [
        Rule(
            "gross_profit_identity",
            "business_rule",
            "gross_profit",
            _violations(
                _off_by("gross_profit", F.col("revenue") - F.col("cogs"), limits.identity_tolerance)
            ),
            0.0,
            "gross_profit != revenue - cogs",
        ),
        Rule(
            "gross_margin_bounds",
            "business_rule",
            "gross_margin",
            _violations((margin < low) | (margin > high)),
            MARGIN_OUTSIDE_SHARE,
            f"Expected [{low}, {high}]",
        ),
        Rule(
            "revenue_gt_cogs",
            "business_rule",
            "revenue",
            _violations(F.col("revenue") <= F.col("cogs")),
            COGS_ABOVE_REVENUE_SHARE,
        ),
    ]
    if "ebt" in df.columns:
        rules.append(
            Rule(
                "net_income_sign_consistent",
                "business_rule",
                "net_income",
                _violations((F.col("ebt") > 0) & (F.col("net_income") < 0)),
                0.0,
            )
        )
    return rules


def extended_rules(limits: QualityLimits = LIMITS, tax_rate: float = 0.28) -> list[Rule]:
    """Identities and bounds that are documented next to the gate but not part of it.

    Needs the ``_revenue_yoy`` column of ``with_yearly_growth``.
    """
    tol = limits.identity_tolerance
    margin = ratio("ebitda", "revenue")
    implied = ratio("tax_expense", "ebt")
    yoy = F.col("_revenue_yoy")
    operating = F.col("gross_profit") - F.col("opex") - F.col("rd_expense") - F.col("sga_expense")
    checks = [
        ("ebitda_identity", "ebitda", _off_by("ebitda", operating, tol)),
        ("ebit_identity", "ebit", _off_by("ebit", F.col("ebitda") - F.col("depreciation"), tol)),
        (
            "net_income_identity",
            "net_income",
            _off_by("net_income", F.col("ebt") - F.col("tax_expense"), tol),
        ),
        (
            "ebitda_margin_bounds",
            "ebitda_margin",
            (margin < limits.ebitda_margin_min) | (margin > limits.ebitda_margin_max),
        ),
        (
            "revenue_growth_bounds",
            "revenue",
            (yoy < limits.min_revenue_growth_yoy) | (yoy > limits.max_revenue_growth_yoy),
        ),
        ("tax_non_negative", "tax_expense", F.col("tax_expense") < 0),
        (
            "tax_rate_near_statutory",
            "tax_expense",
            (F.col("ebt") > 0) & (F.abs(implied - tax_rate) >= 0.01),
        ),
    ]
    return [Rule(n, "business_rule", c, _violations(p), 0.0) for n, c, p in checks]


def with_yearly_growth(df: DataFrame) -> DataFrame:
    return df.withColumn("_revenue_yoy", growth("revenue", F.lag("revenue", 12).over(by_date())))


def freshness_rule(max_age_days: int, as_of: dt.date) -> Rule:
    """Age of the newest row; an empty table counts as far too old."""
    age = F.coalesce(
        F.date_diff(F.lit(as_of), F.max(F.col("date").cast("date"))), F.lit(NO_DATA_AGE_DAYS)
    )
    failed = F.when(age > max_age_days, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return Rule(
        "data_freshness", "freshness", "date", failed, 0.0,
        f"max age {max_age_days} days", checked=F.lit(1).cast("bigint"),
    )


def _verdicts(raw: DataFrame) -> DataFrame:
    """Failure share and verdict; compared before the share is rounded for the log."""
    share = F.col("rows_failed") / F.greatest(F.col("rows_checked"), F.lit(1))
    return raw.select(
        "table_name",
        "check_name",
        "check_type",
        "column_name",
        "rows_checked",
        "rows_failed",
        F.round(share, 4).alias("failure_pct"),
        "threshold",
        (share <= F.col("threshold")).alias("passed"),
        "details",
    )


def evaluate(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All rules of a table in one aggregate, one result row per rule."""
    counts = df.agg(
        F.count("*").alias("n"),
        *[r.failed.alias(f"f{i}") for i, r in enumerate(rules)],
        *[r.checked.alias(f"c{i}") for i, r in enumerate(rules) if r.checked is not None],
    )
    rows = [
        {
            "table_name": literal(table),
            "check_name": literal(r.name),
            "check_type": literal(r.kind),
            "column_name": literal(r.column),
            "rows_checked": "n" if r.checked is None else f"c{i}",
            "rows_failed": f"f{i}",
            "threshold": literal(float(r.threshold)),
            "details": literal(r.details),
        }
        for i, r in enumerate(rules)
    ]
    return _verdicts(counts.select(inline_rows(rows)))


def _single(df: DataFrame, table, name, kind, column, threshold, details="") -> DataFrame:
    """A result row from a one-row frame holding ``rows_checked`` and ``rows_failed``."""
    return _verdicts(
        df.select(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            F.lit(kind).alias("check_type"),
            F.lit(column).alias("column_name"),
            "rows_checked",
            "rows_failed",
            F.lit(float(threshold)).alias("threshold"),
            F.lit(details).alias("details"),
        )
    )


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def check_duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key: ``n - distinct keys``."""
    zero = F.lit(0).cast("bigint")
    counts = key_counts(df, keys).agg(
        F.coalesce(F.sum("n_rows"), zero).alias("rows_checked"),
        F.coalesce(F.sum(F.col("n_rows") - 1), zero).alias("rows_failed"),
    )
    return _single(
        counts, table, f"no_duplicates_{'_'.join(keys)}", "duplicate", ", ".join(keys), 0.0
    )


def duplicate_keys(df: DataFrame, keys: list[str], top: int = 5) -> DataFrame:
    """The most repeated keys."""
    return (
        key_counts(df, keys)
        .filter(F.col("n_rows") > 1)
        .orderBy(F.col("n_rows").desc(), *keys)
        .limit(top)
    )


def check_referential(fin: DataFrame, macro: DataFrame) -> DataFrame:
    """Distinct financial months without a macro month."""
    known = macro.select("date").distinct().withColumn("_known", F.lit(True))
    counts = (
        fin.select("date")
        .distinct()
        .join(known, "date", "left")
        .agg(
            F.count("*").alias("rows_checked"),
            F.count_if(F.col("_known").isNull()).alias("rows_failed"),
        )
    )
    return _single(
        counts, FINANCIALS, "fin_dates_in_macro", "referential_integrity", "date", 0.05
    )


def check_schema(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """Expected columns that are absent, and present columns of an incompatible type.

    The comparison is on metadata; the row count goes into the details. The type
    check is separate from the presence check and allows widening. Business columns beyond
    the schema are named in the details as a warning and fail nothing.
    """
    wanted = business_columns(expected)
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in wanted if f.name not in actual]
    wrong = [
        f.name for f in wanted if f.name in actual and not _compatible(actual[f.name], f.dataType)
    ]
    known = {f.name for f in expected.fields}
    extra = [c for c in actual if c not in known and not c.startswith("_")]
    warning = f"Extra columns: {extra}, " if extra else ""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            F.lit("schema").alias("check_type"),
            F.lit("all_columns").alias("column_name"),
            F.lit(len(wanted)).cast("bigint").alias("rows_checked"),
            F.lit(len(bad)).cast("bigint").alias("rows_failed"),
            F.lit(0.0).alias("threshold"),
            F.concat(
                F.lit((f"{label}: {bad}, " if bad else "") + (warning if label == "Missing" else "") + "rows: "),
                F.col("n").cast("string"),
            ).alias("details"),
        )
        for name, bad, label in (
            ("schema_columns_present", missing, "Missing"),
            ("schema_types_compatible", wrong, "Wrong type"),
        )
    ]
    raw = df.agg(F.count("*").alias("n")).select(F.inline(F.array(*rows)))
    return _verdicts(raw)


_WIDENING = {
    "int": {"bigint", "double"},
    "bigint": {"double"},
    "float": {"double"},
    "date": {"timestamp"},
}


def _compatible(actual: T.DataType, expected: T.DataType) -> bool:
    a, e = actual.simpleString(), expected.simpleString()
    return a == e or e in _WIDENING.get(a, set())


def financial_rules(df: DataFrame, as_of: dt.date, limits: QualityLimits = LIMITS) -> list[Rule]:
    return [
        *hard_null_rules(df, FINANCIALS_NOT_NULL),
        *soft_null_rules(df, FINANCIALS_NOT_NULL, limits),
        *range_rules(df, FINANCIALS_RANGES),
        *business_rules(df, limits),
        freshness_rule(limits.max_data_age_days, as_of),
    ]


def macro_rules(df: DataFrame, as_of: dt.date, limits: QualityLimits = LIMITS) -> list[Rule]:
    return [
        *hard_null_rules(df, MACRO_NOT_NULL),
        *soft_null_rules(df, MACRO_NOT_NULL, limits),
        *range_rules(df, MACRO_RANGES),
        freshness_rule(2 * limits.max_data_age_days, as_of),
    ]


def run_checks(
    fin: DataFrame,
    macro: DataFrame,
    as_of: dt.date,
    schemas: dict[str, T.StructType] | None = None,
    limits: QualityLimits = LIMITS,
) -> DataFrame:
    """Every check of the gate as one result table."""
    parts = [
        evaluate(fin, FINANCIALS, financial_rules(fin, as_of, limits)),
        evaluate(macro, MACRO, macro_rules(macro, as_of, limits)),
        check_duplicates(fin, FINANCIALS, ["date", "company"]),
        check_duplicates(macro, MACRO, ["date"]),
        check_referential(fin, macro),
    ]
    for table, df in ((FINANCIALS, fin), (MACRO, macro)):
        if schemas:
            parts.append(check_schema(df, schemas[table], table))
    return reduce(DataFrame.unionByName, parts)


def stamp_log(results: DataFrame, run_id: str, checked_at=None) -> DataFrame:
    """Results in the shape of the data-quality log."""
    stamp = F.current_timestamp() if checked_at is None else F.lit(checked_at).cast("timestamp")
    return results.select(
        F.lit(run_id).alias("run_id"), *results.columns, stamp.alias("checked_at")
    )


def summarize(results: DataFrame) -> DataFrame:
    """Passed over total per check type and overall, with the failed check names.

    ``results`` are the checks of one run: a few dozen rows, fixed by the rules.
    """
    scopes = results.select(
        "*", F.explode(F.array("check_type", F.lit("overall"))).alias("scope")
    )
    failed = F.concat_ws(
        ", ",
        F.array_sort(
            F.collect_list(
                F.when(~F.col("passed"), F.concat_ws(".", "table_name", "check_name"))
            )
        ),
    )
    return (
        scopes.groupBy("scope")
        .agg(
            F.count_if("passed").alias("n_passed"),
            F.count("*").alias("n_checks"),
            failed.alias("failed_checks"),
        )
        .withColumn(
            "summary", F.format_string("%d/%d checks passed", F.col("n_passed"), F.col("n_checks"))
        )
    )


def tag_rows(df: DataFrame, tolerance: float = LIMITS.identity_tolerance) -> DataFrame:
    """Row verdicts of the two hard rules. A null operand fails: every row gets a side."""
    gap = F.abs(F.col("gross_profit") - (F.col("revenue") - F.col("cogs")))
    ok = F.coalesce(gap <= tolerance, F.lit(False))
    positive = F.coalesce(F.col("revenue") > 0, F.lit(False))
    return df.withColumns(
        {"_dq_gross_profit_ok": ok, "_dq_revenue_positive": positive, "_dq_passed": ok & positive}
    )


def quarantine(
    df: DataFrame, run_id: str, tolerance: float = LIMITS.identity_tolerance, stamped_at=None
) -> DataFrame:
    """Rows that fail a hard rule, with the first failing rule as the reason."""
    inputs_missing = F.col("gross_profit").isNull() | F.col("revenue").isNull() | F.col("cogs").isNull()
    reason = (
        F.when(inputs_missing, REASONS["null"])
        .when(~F.col("_dq_gross_profit_ok"), REASONS["identity"])
        .when(~F.col("_dq_revenue_positive"), REASONS["revenue"])
        .otherwise("unknown")
    )
    stamp = F.current_timestamp() if stamped_at is None else F.lit(stamped_at).cast("timestamp")
    return (
        tag_rows(df, tolerance)
        .filter(~F.col("_dq_passed"))
        .withColumns(
            {
                "_quarantine_reason": reason,
                "_quarantined_at": stamp,
                "_run_id": F.lit(run_id),
            }
        )
    )


def clean_rows(df: DataFrame, tolerance: float = LIMITS.identity_tolerance) -> DataFrame:
    """Rows that pass both hard rules, without helper columns."""
    return (
        tag_rows(df, tolerance)
        .filter("_dq_passed")
        .drop("_dq_gross_profit_ok", "_dq_revenue_positive", "_dq_passed")
    )


def gate(df: DataFrame, limits: QualityLimits = LIMITS) -> DataFrame:
    """One row: counts on both sides, failure rate and whether the run must stop."""
    rate = F.col("rows_quarantined") / F.greatest(F.col("rows_total"), F.lit(1))
    return (
        tag_rows(df, limits.identity_tolerance)
        .agg(
            F.count("*").alias("rows_total"),
            F.count_if("_dq_passed").alias("rows_clean"),
            F.count_if(~F.col("_dq_passed")).alias("rows_quarantined"),
        )
        .select("*", rate.alias("fail_rate"), (rate > limits.dq_fail_threshold).alias("abort"))
    )


class GateAborted(RuntimeError):
    """Too many rows failed the hard rules."""


def enforce_gate(df: DataFrame, limits: QualityLimits = LIMITS) -> int:
    """Raise if the gate says stop; returns the clean row count. The only collect is one row."""
    verdict = gate(df, limits).first()
    if verdict["abort"]:
        raise GateAborted(
            f"data-quality failure rate {verdict['fail_rate']:.1%} exceeds "
            f"{limits.dq_fail_threshold:.0%}"
        )
    return verdict["rows_clean"]


def silver_validate(df: DataFrame, tolerance: float = LIMITS.identity_tolerance) -> DataFrame:
    """Second, stricter filter before enrichment: the tolerance itself already fails."""
    gap = F.abs(F.col("gross_profit") - (F.col("revenue") - F.col("cogs")))
    return df.filter(
        (F.col("revenue") > 0) & (F.col("cogs") < F.col("revenue")) & (gap < tolerance)
    )


def reingest(
    clean: DataFrame, corrected: DataFrame, run_id: str, tolerance: float = LIMITS.identity_tolerance
) -> tuple[DataFrame, DataFrame]:
    """Corrected quarantine rows through the gate again.

    Returns the clean table with the accepted corrections upserted on
    (company, date), and the rows that still fail.
    """
    from ledgerline.sources.layers import upsert

    accepted = clean_rows(corrected, tolerance).select(*clean.columns)
    return upsert(clean, accepted, ["company", "date"]), quarantine(corrected, run_id, tolerance)
