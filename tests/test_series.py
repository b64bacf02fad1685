import math
import random

import numpy as np
import pytest

from ledgerprofile.operators import series
from tests.conftest import months_frame

# The one literal series of the reference's tests (12 monthly values).
SERIES = [5496536, 200895, 1268418, 401365, 3690017, 1035349, 18183972, 7001843,
          6463026, 16613952, 9170859, 168213522]
MONTHS = list(range(201201, 201213))


def _slope(spark, values, ridge, months=None):
    months = months or MONTHS[: len(values)]
    df = months_frame(spark, [("T", m, v) for m, v in zip(months, values)])
    return series.growth_slope(df, months[0], months[-1], ridge).first().slope


def test_growth_slope_golden(spark):
    # the test path: first value left out, months 1..11, scale from the minimum 200895 (1e6)
    assert _slope(spark, SERIES[1:], 0.2, MONTHS[1:]) == 8.435
    # the job path: all 12 values
    assert _slope(spark, SERIES, 0.2) == 7.085
    assert _slope(spark, SERIES, 0.0) == 7.117


def test_growth_slope_degenerate(spark):
    assert _slope(spark, [5.0] * 6, 0.2) == 0.0          # constant labels
    assert _slope(spark, [5.0] * 6, 0.0) == 0.0
    assert _slope(spark, [42.0], 0.2) == 0.0             # a single month


def test_growth_slope_needs_every_month(spark):
    rows = [("FULL", m, 10.0 * (i + 1)) for i, m in enumerate(MONTHS[:4])]
    rows += [("GAP", m, 5.0) for m in (MONTHS[0], MONTHS[2], MONTHS[3])]
    rows += [("NULLM", m, (None if i == 1 else 1.0)) for i, m in enumerate(MONTHS[:4])]
    got = {r.nsrsbh for r in series.growth_slope(months_frame(spark, rows), MONTHS[0], MONTHS[3]).collect()}
    assert got == {"FULL"}


def test_growth_slope_matches_mllib(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression
    rng = random.Random(7)
    for ridge in (0.2, 0.0):
        for _ in range(3):
            vals = [round(rng.uniform(1e3, 1e7), 2) for _ in range(12)]
            digits = len(str(int(abs(min(vals))))) if int(abs(min(vals))) else 1
            train = spark.createDataFrame(
                [(round(v, 3) / 10.0 ** digits, Vectors.dense([float(i)])) for i, v in enumerate(vals)],
                ["label", "features"])
            model = LinearRegression(maxIter=1000, regParam=ridge, tol=1e-12).fit(train)
            assert _slope(spark, vals, ridge) == round(model.coefficients[0], 3)


def _acf(arr, k):
    arr = np.asarray(arr, dtype=float)
    m = arr.mean()
    var = ((arr - m) ** 2).sum()
    num = sum((arr[i] - m) * (arr[i + k] - m) for i in range(len(arr) - k))
    return float("nan") if var == 0 else round(num / var, 6)


@pytest.mark.parametrize("lag", [1, 3, 6, 12])
def test_autocorrelation_matches_dense_definition(spark, lag):
    rng = random.Random(lag)
    months = [y * 100 + m for y in (2012, 2013) for m in range(1, 13)]
    rows, dense = [], {}
    for t in range(12):
        present = [m for m in months if rng.random() < 0.7]
        vals = {m: round(rng.uniform(0, 1e6), 2) for m in present}
        rows += [(f"T{t:02d}", m, v) for m, v in vals.items()]
        dense[f"T{t:02d}"] = vals
    rows.append(("CONST", months[0], 0.0))                # all-zero series -> NaN
    dense["CONST"] = {months[0]: 0.0}
    df = months_frame(spark, rows)
    axis = sorted({m for v in dense.values() for m in v})
    got = {r.nsrsbh: r.coefficient for r in series.autocorrelation(df, months[0], months[-1], lag).collect()}
    for t, vals in dense.items():
        want = _acf([vals.get(m, 0.0) for m in axis], lag)
        if math.isnan(want):
            assert math.isnan(got[t])
        else:
            assert got[t] == pytest.approx(want, abs=1.5e-6), t


def test_autocorrelation_lag_beyond_series(spark):
    df = months_frame(spark, [("A", m, float(i)) for i, m in enumerate(MONTHS[:4])])
    assert series.autocorrelation(df, MONTHS[0], MONTHS[3], 4).first().coefficient == 0.0
    with pytest.raises(ValueError):
        series.autocorrelation(df, MONTHS[0], MONTHS[3], 0)


def test_histogram_counts_nan_everywhere(spark):
    c = spark.createDataFrame([("a", 0.15), ("b", 0.45), ("c", float("nan")), ("d", -0.2)],
                              "nsrsbh string, coefficient double")
    got = {r.threshold: r.n_rows for r in series.coefficient_histogram(c).collect()}
    assert got == {0.1: 3, 0.2: 2, 0.3: 2, 0.4: 2, 0.5: 1}


def test_pivot_and_min_max(spark):
    df = months_frame(spark, [("A", 201201, 1.0), ("A", 201203, 3.0), ("B", 201202, 2.0)])
    piv = series.monthly_pivot(df, 201201, 201203)
    assert piv.columns == ["nsrsbh", "201201", "201202", "201203"]
    a = piv.where("nsrsbh = 'A'").first()
    assert (a["201201"], a["201202"], a["201203"]) == (1.0, None, 3.0)
    mm = {r.nsrsbh: (r.x_min, r.x_max) for r in series.series_min_max(df, 201201, 201203).collect()}
    assert mm == {"A": (1.0, 3.0), "B": (2.0, 2.0)}


def test_null_ids_and_long_lag_warning(spark):
    df = months_frame(spark, [(None, m, 1.0 + i) for i, m in enumerate(MONTHS[:4])]
                      + [("A", m, float(i * i)) for i, m in enumerate(MONTHS[:4])])
    with pytest.warns(UserWarning):
        got = series.autocorrelation(df, MONTHS[0], MONTHS[3], 3).collect()
    assert [r.nsrsbh for r in got] == ["A"]
    assert [r.nsrsbh for r in series.growth_slope(df, MONTHS[0], MONTHS[3]).collect()] == ["A"]
