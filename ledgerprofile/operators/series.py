"""Monthly series per taxpayer: pivot (A7), min/max (F9), growth slope (M2/M3),
lag-k autocorrelation (M1) and the coefficient histogram (A10).

The series stay in *long form* (one row per taxpayer-month), so there is no pivot width
limit and no dense taxpayer x month grid.  Each statistic is a window over the taxpayer's
own months (at most one row per month of the period) followed by one grouped aggregate on
the same partitioning - a single shuffle by taxpayer.

The month axis is the sorted list of months *present* in the filtered input (not calendar
months); it has at most one row per month of the period.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.functions.scalars import digit_count, period_between, round_half_up
from ledgerprofile.session import checkpoint_dir

GROWTH_DIGITS = 3
CORRELATION_DIGITS = 6
DEFAULT_RIDGE = 0.2
HISTOGRAM_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5)


def in_period(monthly: DataFrame, start: int, end: int, value: str = "xxje") -> DataFrame:
    """(nsrsbh, ny, value) rows of the period with a taxpayer id (NULL ids are dropped)."""
    return (monthly.where(period_between("ny", start, end) & F.col("nsrsbh").isNotNull())
            .select("nsrsbh", "ny", value))


def materialised_period(monthly: DataFrame, start: int, end: int, value: str = "xxje",
                        materialise: bool = True) -> DataFrame:
    """``in_period``, written once to the checkpoint folder when ``materialise``.

    The month list and the statistic both read it, so an expensive upstream (e.g.
    invoices -> monthly totals) runs once and the lineage is cut.  Pass
    ``materialise=False`` when ``monthly`` is already a stored table or a checkpoint.
    """
    rows = in_period(monthly, start, end, value)
    if not materialise:
        return rows
    checkpoint_dir(monthly.sparkSession)
    return rows.checkpoint()


def period_months(series: DataFrame) -> list[int]:
    """The sorted months present in ``series`` (already cut to a period).

    At most one value per month of the period, so the list is bounded by the period length,
    not by the data; one small job (a pruned scan of the month column) computes it.
    """
    return sorted(int(r[0]) for r in series.select("ny").distinct().collect())


def month_index(months: list[int]) -> Column:
    """0-based position of ``ny`` in ``months`` (a literal array: no join, no shuffle)."""
    return F.array_position(F.array(*[F.lit(int(m)) for m in months]), F.col("ny")).cast("int") - 1


def monthly_means(series: DataFrame, value: str = "xxje") -> DataFrame:
    """(nsrsbh, ny, x): mean of ``value`` per taxpayer-month (NULL when all are NULL).

    The input is first hash-partitioned by taxpayer alone: that placement already groups
    (taxpayer, month) for the mean *and* taxpayer for the per-taxpayer windows that
    follow, so the whole statistic costs one shuffle.  A taxpayer holds at most one row per
    month of the period (per industry row), so no partition can be hot.
    """
    return series.repartition("nsrsbh").groupBy("nsrsbh", "ny").agg(F.avg(value).alias("x"))


# A7 -------------------------------------------------------------------------------------
def monthly_pivot(monthly: DataFrame, start: int, end: int, months: list[int] | None = None,
                  value: str = "xxje", materialise: bool = True) -> DataFrame:
    """One row per taxpayer, one column per month (mean of ``value``; NULL if missing).

    Pass ``months`` to skip the value-discovery job; otherwise the distinct months of the
    period are collected (at most one per month of the period).
    """
    if months is None:
        s = materialised_period(monthly, start, end, value, materialise)
        months = period_months(s)
    else:
        s = in_period(monthly, start, end, value)
    return s.groupBy("nsrsbh").pivot("ny", [int(m) for m in months]).agg(F.avg(value))


# F9 -------------------------------------------------------------------------------------
def series_min_max(monthly: DataFrame, start: int, end: int, value: str = "xxje") -> DataFrame:
    """(nsrsbh, x_min, x_max) over each taxpayer's monthly means in the period."""
    m = monthly_means(in_period(monthly, start, end, value), value)
    return m.groupBy("nsrsbh").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))


# M2 / M3 --------------------------------------------------------------------------------
def growth_slope(monthly: DataFrame, start: int, end: int, ridge: float = DEFAULT_RIDGE,
                 value: str = "xxje", materialise: bool = True) -> DataFrame:
    """(nsrsbh, slope) for taxpayers with a non-NULL mean in *every* month of the period.

    Label of month i = round(x_i, 3) / 10^digits(min x); feature = month index.  The slope
    of a least-squares line with intercept and L2 penalty ``ridge`` on standardised
    feature and label is, in closed form,
    ``covar_pop(i, y) / var_pop(i) * s / (s + ridge)`` with ``s = stddev_pop(y)``:
    the same number an iterative fit converges to, without one fit per company.
    ``ridge=0`` is ordinary least squares.  Constant labels or a single month give 0.
    The slope is rounded to 3 digits.
    """
    s = materialised_period(monthly, start, end, value, materialise)
    n_months = len(period_months(s))
    means = monthly_means(s, value)
    by_taxpayer = Window.partitionBy("nsrsbh")
    seq = means.select(
        "nsrsbh", "x",
        F.count("x").over(by_taxpayer).alias("n_x"),
        F.min("x").over(by_taxpayer).alias("x_min"),
        (F.row_number().over(by_taxpayer.orderBy("ny")) - 1).cast("double").alias("i"),
    ).where(F.col("n_x") == F.lit(n_months))
    y = round_half_up("x", GROWTH_DIGITS) / F.pow(F.lit(10.0), digit_count("x_min").cast("double"))
    fit = seq.select("nsrsbh", "i", y.alias("y")).groupBy("nsrsbh").agg(
        F.covar_pop("i", "y").alias("cov"), F.var_pop("i").alias("var_i"),
        F.stddev_pop("y").alias("sd_y"))
    shrink = F.try_divide(F.col("sd_y"), F.col("sd_y") + F.lit(float(ridge)))
    slope = F.coalesce(F.try_divide(F.col("cov"), F.col("var_i")) * shrink, F.lit(0.0))
    return fit.select("nsrsbh", round_half_up(slope, GROWTH_DIGITS).alias("slope"))


# M1 -------------------------------------------------------------------------------------
def autocorrelation(monthly: DataFrame, start: int, end: int, lag: int,
                    value: str = "xxje", materialise: bool = True) -> DataFrame:
    """(nsrsbh, coefficient): lag-``lag`` autocorrelation of each taxpayer's monthly series.

    The series runs over every month present in the period, a missing month (or a NULL
    mean) counting as 0.  With m the mean of all M values and d_t = x_t - m:
    ``sum_{t < M-lag} d_t d_{t+lag} / sum_t d_t^2``, rounded to 6 digits.  A constant series
    gives NaN; ``lag >= M`` gives 0.

    Only the months a taxpayer has are stored; missing months enter in closed form (their
    deviation is -m), so the work is proportional to the stored rows.
    """
    if lag < 1:
        raise ValueError("lag must be >= 1")
    s = materialised_period(monthly, start, end, value, materialise)
    months = period_months(s)
    n_months = len(months)
    k = int(lag)
    if 2 * k > n_months:
        warnings.warn(f"lag {k} exceeds half of the {n_months} months: few pairs enter the sum",
                      stacklevel=2)
    rows = (monthly_means(s, value)
            .select("nsrsbh", month_index(months).alias("idx"),
                    F.coalesce(F.col("x"), F.lit(0.0)).alias("x")))
    by_taxpayer = Window.partitionBy("nsrsbh")
    ordered = by_taxpayer.orderBy("idx")
    mean = F.sum("x").over(by_taxpayer) / F.lit(float(n_months))
    ahead = F.max("x").over(ordered.rangeBetween(k, k))          # x at idx+lag, NULL if absent
    behind = F.count("x").over(ordered.rangeBetween(-k, -k))     # 1 if idx-lag present
    t = rows.select("nsrsbh", "idx", "x", mean.alias("m"), ahead.alias("x_ahead"),
                    behind.alias("has_behind"))
    d = F.col("x") - F.col("m")
    m = F.col("m")
    fwd_ok = F.col("idx") < F.lit(n_months - k)
    bwd_only = (F.col("idx") >= k) & (F.col("has_behind") == 0)
    partner = F.coalesce(F.col("x_ahead") - m, -m)
    agg = t.groupBy("nsrsbh").agg(
        F.first("m").alias("m"),
        F.count(F.lit(1)).alias("n_present"),
        F.sum(d * d).alias("ss_present"),
        F.sum(F.when(fwd_ok, d * partner).otherwise(0.0)).alias("fwd"),
        F.sum(F.when(bwd_only, -m * d).otherwise(0.0)).alias("bwd"),
        F.count_if(fwd_ok).alias("n_fwd"),
        F.count_if(bwd_only).alias("n_bwd"),
    )
    m = F.col("m")
    pairs = F.lit(max(0, n_months - k))
    both_missing = pairs - F.col("n_fwd") - F.col("n_bwd")
    variance = F.col("ss_present") + (F.lit(n_months) - F.col("n_present")) * m * m
    numerator = F.col("fwd") + F.col("bwd") + both_missing * m * m
    coefficient = F.when(variance == 0, F.lit(float("nan"))).otherwise(
        round_half_up(numerator / variance, CORRELATION_DIGITS))
    return agg.select("nsrsbh", coefficient.alias("coefficient"))


# A10 ------------------------------------------------------------------------------------
def coefficient_histogram(coefficients: DataFrame, column: str = "coefficient",
                          thresholds: tuple[float, ...] = HISTOGRAM_THRESHOLDS) -> DataFrame:
    """(threshold, n_rows): rows with ``column > threshold``, all thresholds in one pass.

    NaN compares greater than every number, so NaN rows count in every band.
    """
    c = F.col(column)
    counts = coefficients.agg(*[F.count_if(c > F.lit(t)).alias(f"n{i}") for i, t in enumerate(thresholds)])
    stacked = ", ".join(f"{float(t)!r}D, n{i}" for i, t in enumerate(thresholds))
    return counts.selectExpr(f"stack({len(thresholds)}, {stacked}) as (threshold, n_rows)")
