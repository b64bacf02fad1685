from decimal import Decimal

import pytest

from ledgerprofile.operators import summary

INV = "xf_nsrsbh string, gf_nsrsbh string, je decimal(18,2), kprq string"


def _inv(spark, rows):
    return spark.createDataFrame([(a, b, Decimal(str(c)), d) for a, b, c, d in rows], INV)


def _reg(spark, rows):
    return spark.createDataFrame(rows, "nsrsbh string, hy_dm string")


def test_taxpayer_monthly_both_sides_required(spark):
    reg = _reg(spark, [("A", "H1"), ("B", "H2"), ("C", ""), ("D", None)])
    sales = _inv(spark, [
        ("A", "X", 10.00, "20120105000000"), ("A", "Y", 5.50, "20120120000000"),   # Jan, both sides
        ("A", "X", 7.00, "20120201000000"),                                         # Feb: no purchases
        ("C", "A", 1.00, "20120105000000"), ("D", "A", 1.00, "20120105000000"),     # no industry
        ("A", "X", 99.0, "bad"),                                                    # invalid time
    ])
    purchases = _inv(spark, [
        ("X", "A", 3.25, "20120110000000"), ("Y", "A", 1.00, "20120111000000"),
        ("X", "A", 2.00, "20120305000000"),                                         # Mar: no sales
        ("A", "C", 1.00, "20120105000000"),
    ])
    out = summary.taxpayer_monthly(sales, purchases, reg).collect()
    assert [(r.nsrsbh, r.hy_dm, r.ny, r.xxje, r.jxje, r.lirun) for r in out] == [
        ("A", "H1", 201201, 15.5, 4.25, 11.25)]
    exact = summary.taxpayer_monthly(sales, purchases, reg, as_double=False)
    assert dict(exact.dtypes)["xxje"].startswith("decimal")


def test_industry_monthly_and_pairs(spark):
    reg = _reg(spark, [("A", "H1"), ("B", "H1"), ("X", "H2")])
    sales = _inv(spark, [("A", "X", 1.0, "20120105000000"), ("B", "X", 2.0, "20120106000000"),
                         ("A", "X", 4.0, "20120107000000"), ("X", "A", 8.0, "20120105000000")])
    purchases = _inv(spark, [("X", "A", 1.0, "20120105000000"), ("X", "B", 1.0, "20120105000000"),
                             ("A", "X", 1.0, "20120105000000")])
    hy = {(r.hy_dm, r.ny): (r.hyyxx, r.hyyjx) for r in summary.industry_monthly(sales, purchases, reg).collect()}
    assert hy == {("H1", 201201): (7.0, 2.0), ("H2", 201201): (8.0, 1.0)}
    pairs = {(r.hy_dm, r.xf_nsrsbh, r.gf_nsrsbh, r.ny): r.xxyje
             for r in summary.pair_monthly_sales(sales, reg).collect()}
    assert pairs == {("H1", "A", "X", 201201): 5.0, ("H1", "B", "X", 201201): 2.0, ("H2", "X", "A", 201201): 8.0}
    buys = {(r.hy_dm, r.xf_nsrsbh, r.gf_nsrsbh): r.jxyje
            for r in summary.pair_monthly_purchases(purchases, reg).collect()}
    # the buyer's industry, with seller/buyer columns under their own names
    assert buys == {("H1", "X", "A"): 1.0, ("H1", "X", "B"): 1.0, ("H2", "A", "X"): 1.0}
    totals = summary.pair_totals(summary.pair_monthly_sales(sales, reg))
    assert totals.where("xf_nsrsbh = 'A'").first().xxnje == 5.0


def test_invoices_with_industry_sides(spark):
    reg = _reg(spark, [("A", "H1"), ("X", "")])
    inv = _inv(spark, [("A", "X", 1.0, "20120105000000"), ("X", "A", 2.0, "20120105000000")])
    assert [r.xf_nsrsbh for r in summary.invoices_with_industry(inv, reg, "seller").collect()] == ["A"]
    assert [r.gf_nsrsbh for r in summary.invoices_with_industry(inv, reg, "buyer").collect()] == ["A"]


def test_month_count_and_rows_per_industry(spark):
    m = spark.createDataFrame([("A", 201201), ("B", 201201), ("A", 201202), ("A", 201401)], "nsrsbh string, ny int")
    assert summary.month_count(m, 201201, 201312).first().n_months == 2
    e = spark.createDataFrame([("H1",), ("H1",), ("H2",)], "hy_dm string")
    assert {r.hy_dm: r.n_rows for r in summary.rows_per_industry(e).collect()} == {"H1": 2, "H2": 1}


def test_registry_unique_in_fixture(spark, sf001):
    from ledgerprofile.sources import testdata
    reg = testdata.registry_table(spark, sf001)
    assert reg.count() == reg.select("nsrsbh").distinct().count()


def test_a_repeated_taxpayer_is_refused(spark):
    inv = spark.createDataFrame([("A", "A", Decimal("1.00"), "20120105000000")],
                                "xf_nsrsbh string, gf_nsrsbh string, je decimal(18,2), kprq string")
    once = spark.createDataFrame([("A", "H1"), ("A", ""), ("B", "H2")], "nsrsbh string, hy_dm string")
    assert summary.taxpayer_monthly(inv, inv, once).count() == 1          # a row without an industry is no second one
    twice = once.unionByName(spark.createDataFrame([("A", "H3")], "nsrsbh string, hy_dm string"))
    for job in (lambda: summary.taxpayer_monthly(inv, inv, twice), lambda: summary.pair_monthly_sales(inv, twice),
                lambda: summary.pair_monthly_purchases(inv, twice)):
        with pytest.raises(Exception, match="repeats the taxpayer A"):
            job().collect()
    assert summary.invoices_with_industry(inv, twice).count() == 2         # the plain join gives both
