"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with null for a zero denominator (ANSI mode would raise)."""
    return F.try_divide(col(num), col(den))


def floor_at_zero(x: Column | str) -> Column:
    """Clip below at zero; a null stays null (``greatest`` would turn it into 0)."""
    return F.when(col(x) < 0, F.lit(0.0)).otherwise(col(x))


def clip(x: Column, low: Column, high: Column) -> Column:
    return F.when(x < low, low).when(x > high, high).otherwise(x)


def growth(x: Column | str, base: Column) -> Column:
    return ratio(col(x) - base, base)


def by_company(*extra: str) -> WindowSpec:
    return Window.partitionBy("company", *extra)


def by_date(*extra: str) -> WindowSpec:
    return by_company(*extra).orderBy("date")


def by_year(*extra: str) -> WindowSpec:
    return by_company(*extra).orderBy("year")


def by_period(*extra: str) -> WindowSpec:
    """Year order in which the actual part of a year comes before its forecast part."""
    return by_company(*extra).orderBy("year", "is_forecast")


def running(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rise(x: str, spec: WindowSpec) -> Column:
    """Increase over the previous row; the first row of a series is 0."""
    return F.coalesce(F.col(x) - F.lag(x).over(spec), F.lit(0.0))


def fall(x: str, spec: WindowSpec) -> Column:
    """Decrease over the previous row; the first row of a series is 0."""
    return F.coalesce(F.lag(x).over(spec) - F.col(x), F.lit(0.0))


def negate(x: Column | str) -> Column:
    """Sign change that turns 0 into 0, not into -0."""
    return F.lit(0.0) - col(x)


def literal(value) -> str:
    """A Python value as SQL text, for long literal lists that are parsed in one go."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_rows(rows: list[dict[str, str]]) -> Column:
    """Generator of one output row per dict of SQL expressions."""
    structs = (
        "named_struct(" + ", ".join(f"'{k}', {x}" for k, x in row.items()) + ")" for row in rows
    )
    return F.expr(f"inline(array({', '.join(structs)}))")


def money_label(x: Column | str, decimals: int = 0) -> Column:
    """``R 12M`` from one million up, ``R 12,345`` below, a dash for null."""
    v = col(x)
    return (
        F.when(v.isNull(), F.lit("—"))
        .when(
            F.abs(v) >= 1_000_000,
            F.concat(F.lit("R "), F.format_string(f"%.{decimals}f", v / 1e6), F.lit("M")),
        )
        .otherwise(F.concat(F.lit("R "), F.format_number(v, 0)))
    )


def percent_label(x: Column | str) -> Column:
    v = col(x)
    return F.when(v.isNull(), F.lit("—")).otherwise(
        F.concat(F.format_string("%.1f", v * 100), F.lit("%"))
    )


def line_item_amount(x: Column | str) -> Column:
    """Statement cell text: ``R`` and an at least 14-wide grouped amount, ``-`` for null."""
    v = col(x)
    text = F.format_number(v, 0)
    wide = F.when(F.length(text) < 14, F.lpad(text, 14, " ")).otherwise(text)
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.lit("R "), wide))
