"""Revenue forecast with changepoints, yearly seasonality and macro regressors.

One ridge fit per company by its normal equations. Spark shuffles by company once; a company's
months (one per calendar month, a few hundred at most) become one array, and its Gram matrix, the
Cholesky factor of that and the fitted months are column expressions on it: no Python worker.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.forecast import fill_regressors
from ledgerline.operators.timeseries import complete_months, extend_months
from ledgerline.params import ModelAssumptions

# Fixed values of the fit.
N_CHANGEPOINTS = 12
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_SCALE = 0.15
FOURIER_ORDER = 4
SEASONAL_PENALTY = 0.01
#: Of the level and the slope: next to none, it keeps the equations solvable.
LINE_PENALTY = 1e-9
INTERVAL_Z = ModelAssumptions().interval_z
REGRESSORS = ("inflation_rate", "interest_rate")

KNOTS = [CHANGEPOINT_RANGE * (k + 1) / N_CHANGEPOINTS for k in range(N_CHANGEPOINTS)]
TREND_PENALTIES = [LINE_PENALTY] * 2 + [1 / CHANGEPOINT_SCALE] * N_CHANGEPOINTS
EFFECT_PENALTIES = [SEASONAL_PENALTY] * (2 * FOURIER_ORDER + len(REGRESSORS))


def _given(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def _indices(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _normal_equations(rows: Column, penalties: list[float]) -> Column:
    """Lower triangle of X'X + diag(penalties), and X'y as one more row; y ends each row of X."""
    n = len(penalties)
    added = F.array(*[F.lit(float(p)) for p in penalties])

    def cell(i: Column, j: Column) -> Column:
        product = F.aggregate(rows, F.lit(0.0), lambda s, r: s + r[i] * r[j])
        return F.when(i == j, product + added[i]).otherwise(product)

    return F.transform(
        _indices(n + 1),
        lambda i: F.transform(F.filter(_indices(n), lambda j: j <= i), lambda j: cell(i, j)),
    )


def _cholesky(lower: Column) -> Column:
    """Factor L of the triangle, row by row; the row of X'y turns into the solution of L z = X'y."""

    def row(done: Column, given: Column) -> Column:
        def entry(found: Column, value: Column) -> Column:
            at = F.size(found)
            above = F.get(done, at)
            return F.concat(
                found,
                F.array(
                    F.when(above.isNull(), F.sqrt(value - _dot(found, found))).otherwise(
                        (value - _dot(found, F.slice(above, 1, at))) / F.get(above, at)
                    )
                ),
            )

        return F.aggregate(given, F.array().cast("array<double>"), entry)

    return F.aggregate(
        lower, F.array().cast("array<array<double>>"), lambda done, given: F.concat(done, F.array(row(done, given)))
    )


def _solved(factor: Column, n: int) -> Column:
    """Weights from the factor, the last one first: L' w = z."""

    def step(found: Column, i: Column) -> Column:
        below = F.transform(F.slice(factor, i + 2, F.size(found)), lambda r: r[i])
        return F.concat(F.array((factor[n][i] - _dot(below, found)) / factor[i][i]), found)

    return F.aggregate(F.reverse(_indices(n)), F.array().cast("array<double>"), step)


def ridge(rows: Column, penalties: list[float]) -> Column:
    """Weights of the ridge regression of each row's last value on the values before it."""
    return _given(_cholesky(_normal_equations(rows, penalties)), lambda f: _solved(f, len(penalties)))


def _trend_row(t: Column) -> Column:
    return F.array(F.lit(1.0), t, *[F.greatest(t - F.lit(k), F.lit(0.0)) for k in KNOTS])


def _season_row(date: Column) -> list[Column]:
    angle = (F.month(date) - 1) * (2 * math.pi / 12)
    return [f(angle * k) for k in range(1, FOURIER_ORDER + 1) for f in (F.sin, F.cos)]


def _fitted(months: Column) -> Column:
    """Months with ``x`` (trend row), ``y`` (scaled revenue, null if not seen), ``effects``."""

    def observed(rows: Column, x: Callable[[Column], Column], y: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter(rows, lambda r: r["y"].isNotNull()), lambda r: F.concat(x(r), F.array(y(r))))

    def with_trend(w: Column) -> Column:
        return F.transform(months, lambda r: F.struct(r["y"].alias("y"), r["effects"].alias("effects"), _dot(r["x"], w).alias("trend")))

    def safe(trend: Column) -> Column:
        return F.when(F.abs(trend) > 1e-9, trend).otherwise(F.lit(1e-9))

    def with_effects(rows: Column, w: Column) -> Column:
        season = F.slice(w, 1, 2 * FOURIER_ORDER)
        return F.transform(
            rows,
            lambda r: F.struct(
                r["y"].alias("y"),
                r["trend"].alias("trend"),
                (r["trend"] * (1 + _dot(r["effects"], w))).alias("forecast"),
                _dot(F.slice(r["effects"], 1, 2 * FOURIER_ORDER), season).alias("seasonal"),
            ),
        )

    return _given(
        _given(ridge(observed(months, lambda r: r["x"], lambda r: r["y"]), TREND_PENALTIES), with_trend),
        lambda rows: _given(
            ridge(observed(rows, lambda r: r["effects"], lambda r: r["y"] / safe(r["trend"]) - 1), EFFECT_PENALTIES),
            lambda w: with_effects(rows, w),
        ),
    )


def _deviation(rows: Column) -> Column:
    """Sample standard deviation of what the fit leaves of the months it has seen."""
    left = F.transform(F.filter(rows, lambda r: r["y"].isNotNull()), lambda r: r["y"] - r["forecast"])

    def spread(x: Column) -> Column:
        return _given(_total(x) / F.size(x), lambda mean: F.sqrt(_total(F.transform(x, lambda v: (v - mean) * (v - mean))) / (F.size(x) - 1)))

    return _given(left, spread)


def forecast_revenue_with_regressors(
    silver: DataFrame, periods: int = 36, until: dt.date | None = None
) -> DataFrame:
    """Same columns as the built-in forecast, fitted with macro regressors.

    ``silver`` has one row per (company, month) with revenue and both regressors. The trend is
    fitted first, then seasonality and regressors on the relative deviation from it. A regressor
    that never changes has no effect; a null one counts as 0. A company with fewer than two known
    revenues keeps its months, with null forecasts.
    """
    wanted = silver.select("company", "date", "revenue", *REGRESSORS)
    past = complete_months(wanted, until=until).drop("is_gap")
    inputs = fill_regressors(extend_months(past, periods), REGRESSORS).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) for c in REGRESSORS}
    )
    seen = (F.col("step") == 0) & F.col("revenue").isNotNull()

    def of_seen(function: Callable, c: str) -> Column:
        return function(F.when(seen, F.col(c)))

    def unit(c: str) -> Column:
        varies = of_seen(F.max, c) > of_seen(F.min, c)
        return F.struct(
            of_seen(F.avg, c).alias("mean"), F.when(varies, of_seen(F.stddev_pop, c)).otherwise(F.lit(1.0)).alias("spread")
        )

    companies = inputs.groupBy("company").agg(
        F.array_sort(F.collect_list(F.struct("date", "step", "revenue", *REGRESSORS))).alias("given"),
        F.greatest(F.count_if(F.col("step") == 0) - 1, F.lit(1)).alias("span"),
        F.count_if(seen).alias("n_seen"),
        F.max(F.when(seen, F.abs("revenue"))).alias("largest"),
        *[unit(c).alias(f"of_{c}") for c in REGRESSORS],
    )
    scale = F.when(F.col("largest") > 0, F.col("largest")).otherwise(F.lit(1.0))

    def month(r: Column, k: Column) -> Column:
        macro = [(r[c] - F.col(f"of_{c}.mean")) / F.col(f"of_{c}.spread") for c in REGRESSORS]
        return F.struct(
            F.when(r["step"] == 0, r["revenue"] / scale).alias("y"),
            _trend_row(k / F.col("span")).alias("x"),
            F.array(*_season_row(r["date"]), *macro).alias("effects"),
        )

    def shown(rows: Column) -> Column:
        def with_band(sigma: Column) -> Column:
            band = sigma * INTERVAL_Z
            return F.zip_with(
                "given",
                rows,
                lambda g, r: F.struct(
                    g["date"].alias("date"),
                    g["step"].alias("step"),
                    g["revenue"].alias("revenue"),
                    (r["forecast"] * scale).alias("revenue_forecast"),
                    ((r["forecast"] - band) * scale).alias("revenue_lower"),
                    ((r["forecast"] + band) * scale).alias("revenue_upper"),
                    (r["trend"] * scale).alias("revenue_trend"),
                    r["seasonal"].alias("revenue_seasonal"),
                ),
            )

        return _given(_deviation(rows), with_band)

    nothing = [F.lit(None).cast("double").alias(c) for c in (
        "revenue_forecast", "revenue_lower", "revenue_upper", "revenue_trend", "revenue_seasonal"
    )]
    unfitted = F.transform("given", lambda g: F.struct(
        g["date"].alias("date"), g["step"].alias("step"), g["revenue"].alias("revenue"), *nothing
    ))
    fitted = _given(F.transform("given", month), lambda months: _given(_fitted(months), shown))
    rows = F.when(F.col("n_seen") >= 2, fitted).otherwise(unfitted)
    return companies.select("company", F.inline(rows))
