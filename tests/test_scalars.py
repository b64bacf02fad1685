import math

from pyspark.sql import functions as F

from ledgerprofile.functions import scalars


def test_invoice_month_strict(spark):
    df = spark.createDataFrame([("20120105123456",), ("bad",), ("20120132000000",), (None,)], "kprq string")
    got = [r[0] for r in df.select(scalars.invoice_month("kprq")).collect()]
    assert got == ["201201", None, None, None]
    got_int = [r[0] for r in df.select(scalars.month_key("kprq")).collect()]
    assert got_int == [201201, None, None, None]


def test_first_token_and_prefix(spark):
    df = spark.createDataFrame([("2012-01-05 12:34:56", "3601234"), ("nospace", "12")], "s string, id string")
    rows = df.select(scalars.first_token("s"), scalars.region_prefix("id")).collect()
    assert [tuple(r) for r in rows] == [("2012-01-05", "36"), ("nospace", "12")]


def test_non_empty_drops_empty_and_null(spark):
    df = spark.createDataFrame([("H1",), ("",), (None,)], "hy_dm string")
    assert [r[0] for r in df.where(scalars.non_empty("hy_dm")).collect()] == ["H1"]


def test_period_between_inclusive(spark):
    df = spark.createDataFrame([(201112,), (201201,), (201312,), (201401,)], "ny int")
    got = sorted(r[0] for r in df.where(scalars.period_between("ny", 201201, 201312)).collect())
    assert got == [201201, 201312]


def test_digit_count(spark):
    vals = [-0.5, 0.0, 9.0, 10.0, 3e9, -123.9, 99999.99]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(scalars.digit_count("x")).collect()]
    assert got == [1, 1, 1, 2, 10, 3, 5]


def test_safe_share(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0), (3.0, None)], "a double, b double")
    got = [r[0] for r in df.select(scalars.safe_share("a", "b")).collect()]
    assert got == [0.25, 0.0, 0.0, 0.0]


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.0005,), (2.6785,), (0.0005,)], "x double")
    got = [r[0] for r in df.select(scalars.round_half_up("x", 3)).collect()]
    assert got == [1.001, 2.679, 0.001]


def test_positive_finite_drops_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (0.3,), (-1.0,)], "c double")
    # NaN compares greater than every number in Spark; the predicate must still drop it
    assert df.where(F.col("c") > 0).count() == 2
    got = [r[0] for r in df.where(scalars.positive_finite("c")).collect()]
    assert got == [0.3] and not any(math.isnan(x) for x in got)
