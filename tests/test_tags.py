from pyspark.sql import functions as F

from ledgerprofile.functions.tagrows import TAG_SCHEMA
from ledgerprofile.plans import tags
from tests.conftest import months_frame


def _industry(spark, rows):
    return spark.createDataFrame([(h, m, x / 2, x / 2, x) for h, m, x in rows],
                                 "hy_dm string, ny int, lr double, jxje double, xxje double")


def _schema_ok(df):
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TAG_SCHEMA]


def test_foreign_trade_no_dedup(spark):
    reg = spark.createDataFrame([("A",), ("A",), (None,)], "nsrsbh string")
    t = tags.tag_foreign_trade(reg, 201201, 201312, "2026-01-01")
    assert _schema_ok(t)
    rows = t.collect()
    assert [(r.nsr_key, r.bq_key, r.bq_value, r.bq_start_time, r.bq_end_time) for r in rows] == \
        [("A", "1", 1.0, "201312", None)] * 2


def test_industry_denominator_covers_taxpayer_months(spark):
    # B is active in one of two months: its denominator is only that month's industry total
    tm = months_frame(spark, [("A", 201201, 30.0), ("A", 201202, 10.0), ("B", 201202, 30.0)])
    hm = _industry(spark, [("H1", 201201, 40.0), ("H1", 201202, 40.0)])
    share = {r.nsrsbh: (r.zxxje, r.hyzxxje, r.xxbl) for r in tags.industry_share(tm, hm, 201201, 201202).collect()}
    assert share == {"A": (40.0, 80.0, 0.5), "B": (30.0, 40.0, 0.75)}
    lead = tags.tag_industry_leader(tm, hm, 201201, 201202, 5, tag_time="t").collect()
    assert [(r.nsr_key, r.bq_key, r.bq_value) for r in lead] == [("B", "6", 0.75)]


def test_zero_industry_total_and_ties(spark):
    tm = months_frame(spark, [("B", 201201, 0.0, "H1"), ("A", 201201, 0.0, "H1"), ("C", 201201, 5.0, "H2")])
    hm = _industry(spark, [("H1", 201201, 0.0), ("H2", 201201, 5.0)])
    lead = {r.nsr_key: r.bq_value for r in tags.tag_industry_leader(tm, hm, 201201, 201201, tag_time="t").collect()}
    assert lead == {"A": 0.0, "C": 1.0}       # share 0.0 without error; tie at rank 1 -> lower id
    top = tags.industry_top_n(tm, hm, 201201, 201201, 2).where("hy_dm = 'H1'").collect()
    assert [(r.nsrsbh, r.rank) for r in top] == [("A", 1), ("B", 2)]


def test_fast_growth_and_periodic_tags(spark):
    months = list(range(201201, 201213))
    rows = []
    for t in range(8):
        rows += [(f"T{t}", m, 100.0 + (t + 1) * i * 10) for i, m in enumerate(months)]   # rising
    rows += [("DOWN", m, 1000.0 - i * 10) for i, m in enumerate(months)]
    df = months_frame(spark, rows)
    g = tags.tag_fast_growth(df, months[0], months[-1], 0.2, tag_time="t")
    assert _schema_ok(g)
    got = [r.nsr_key for r in g.orderBy(F.desc("bq_value")).collect()]
    assert got == ["T7", "T6"]                       # 8 positive -> int(1.6) + 1 = 2
    p = tags.tag_periodic(df, months[0], months[-1], 1, 1.0, tag_time="t")
    assert {r.bq_key for r in p.collect()} == {"4"}


def test_supply_core_tags(spark):
    pairs = spark.createDataFrame(
        [("H1", a, b, 201201, w) for a, b, w in
         [("A", "B", 3.0), ("B", "C", 1.0), ("C", "D", 2.0), ("D", "E", 5.0), ("E", "F", 1.0), ("F", "A", 4.0)]],
        "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, ny int, je double")
    top = tags.tag_supply_core(pairs, 201201, 201212, top=2, tag_time="t").collect()
    low = tags.tag_supply_core(pairs, 201201, 201212, top=2, descending=False, tag_time="t").collect()
    assert len(top) == 2 and len(low) == 2
    assert min(r.bq_value for r in top) > max(r.bq_value for r in low)
    assert {r.bq_key for r in top} == {"5"}


def test_growth_level_bands(spark):
    slopes = spark.createDataFrame(
        [(f"U{i:03d}", 1.0 + i) for i in range(200)] + [(f"S{i}", 0.05) for i in range(3)]
        + [(f"D{i:03d}", -1.0 - i) for i in range(100)], "nsrsbh string, slope double")
    lv = {r.nsrsbh: r.level for r in tags.growth_level(slopes).collect()}
    assert lv["U199"] == 5 and lv["U198"] == 5 and lv["U197"] == 4      # top 1% of 200 = 2
    assert lv["U190"] == 1 and lv["U189"] == 0
    assert lv["D099"] == -5 and lv["D098"] == -4                        # steepest fall first
    assert all(lv[f"S{i}"] == 0 for i in range(3))


def test_profile_union(spark):
    reg = spark.createDataFrame([("A",)], "nsrsbh string")
    one = tags.tag_foreign_trade(reg, 1, 2, "t")
    prof = tags.enterprise_profile(one, one)
    assert prof.count() == 2 and _schema_ok(prof)


def test_growth_level_row_bands(spark):
    slopes = spark.createDataFrame([(f"U{i:03d}", 1.0 + i) for i in range(60)], "nsrsbh string, slope double")
    lv = {r.nsrsbh: r.level for r in tags.growth_level(slopes, band_rows=10).collect()}
    assert lv["U059"] == 5 and lv["U050"] == 5 and lv["U049"] == 4 and lv["U010"] == 1 and lv["U009"] == 0


def test_supply_core_of_a_chain(spark):
    """The middle of a 60-node chain; of the tied N027 and N032 the lower id."""
    pairs = spark.createDataFrame([("H1", f"N{i:03d}", f"N{i + 1:03d}", 201201, 1.0) for i in range(59)],
                                  "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, ny int, je double")
    got = tags.tag_supply_core(pairs, 201201, 201212, digits=6, tag_time="t").collect()
    assert sorted(r.nsr_key for r in got) == ["N027", "N028", "N029", "N030", "N031"]


def test_a_tag_without_a_value_is_an_error(spark):
    import pytest
    from ledgerprofile.functions.tagrows import to_tags
    rows = spark.createDataFrame([("A", None)], "nsrsbh string, v double")
    with pytest.raises(Exception, match="a tag row needs a value"):
        to_tags(rows, "1", "nsrsbh", "v", 201312, "t").collect()
