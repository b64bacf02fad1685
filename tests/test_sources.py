from pyspark.sql import functions as F

from ledgerprofile.functions.tagrows import TAG_SCHEMA, to_tags
from ledgerprofile.sources import loaders, sink, testdata


def _map_registry(spark):
    return spark.createDataFrame(
        [("A", {"hymx_dm": "H1"}, {"nsrdj_no": "E1"}),
         ("B", {"hymx_dm": ""}, {"nsrdj_no": ""}),
         ("C", {}, {}),
         ("D", {"hymx_dm": "H2"}, {"other": "x"})],
        "rowkey string, nsrkz map<string,string>, ckts map<string,string>")


def test_registry_from_maps(spark):
    df = _map_registry(spark)
    with_industry = sorted(tuple(r) for r in loaders.registry_from_maps(df).collect())
    assert with_industry == [("A", "H1"), ("D", "H2")]
    missing = [tuple(r) for r in loaders.registry_from_maps(df, missing_industry=True).collect()]
    assert missing == [("B", "")]          # a missing key is NULL, in neither list


def test_foreign_trade_registry(spark):
    got = [r[0] for r in loaders.foreign_trade_registry(_map_registry(spark)).collect()]
    assert got == ["A"]


def test_warehouse_renames(spark):
    t = spark.createDataFrame([("H1", "A", 201201, 1.0, 2.0, 3.0)],
                              "hy_key string, nsr_key string, date_key int, lr double, jxje double, xxje double")
    assert loaders.taxpayer_monthly_table(t).columns == ["hy_dm", "nsrsbh", "ny", "lr", "jxje", "xxje"]
    p = spark.createDataFrame([("H1", "A", "B", 201201, 5.0)],
                              "hy_key string, nsr_key string, jy_nsrsbh string, date_key int, je double")
    assert loaders.trade_pairs_monthly_table(p).columns == ["hy_dm", "xf_nsrsbh", "gf_nsrsbh", "ny", "je"]


def test_trade_pairs_period_region_and_totals(spark):
    p = spark.createDataFrame(
        [("H1", "36A", "X", 201201, 1.0), ("H1", "36A", "X", 201202, 2.0), ("H1", "36A", "X", 201401, 4.0),
         ("H1", "12B", "36A", 201201, 8.0)],
        "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, ny int, je double")
    region = loaders.trade_pairs_in_period(p, 201201, 201312, "36")
    assert region.count() == 2                      # seller prefix only, period inclusive
    totals = loaders.trade_pair_totals(p, 201201, 201312, "36").collect()
    assert [(r.xf_nsrsbh, r.gf_nsrsbh, r.zje) for r in totals] == [("36A", "X", 3.0)]
    assert loaders.trade_pairs_in_period(p, 201201, 201312).count() == 3


def test_tag_sink_appends(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "nsrsbh string")
    tags = to_tags(rows, "1", "nsrsbh", 1.0, 201312, "2026-01-01")
    assert [(f.name, f.dataType) for f in tags.schema] == [(f.name, f.dataType) for f in TAG_SCHEMA]
    sink.append_tags(tags, "tag_sink_test")
    sink.append_tags(tags, "tag_sink_test")     # appending twice keeps both copies
    back = spark.table("tag_sink_test")
    assert back.count() == 4
    assert sorted(back.columns) == sorted(f.name for f in TAG_SCHEMA.fields)
    r = back.where(F.col("nsr_key") == "A").first()
    assert (r.bq_key, r.bq_value, r.bq_start_time, r.bq_end_time, r.tag_time) == ("1", 1.0, "201312", None, "2026-01-01")
    spark.sql("DROP TABLE tag_sink_test")


def test_testdata_adapter(spark, sf001):
    reg = testdata.taxpayers(spark, sf001)
    assert reg.count() == 10
    ids = [r.nsrsbh for r in reg.collect()]
    assert all(len(i) == 15 for i in ids) and len(set(ids)) == 10
    assert reg.where("hy_dm = ''").count() == reg.where("s_suppkey % 8 = 0").count()
    inv = testdata.invoice_lines(spark, sf001)
    assert inv.count() == 6000
    assert dict(inv.dtypes)["je"] == "decimal(18,2)"
    purchases = testdata.purchase_invoice_table(spark, sf001).count()
    assert purchases == inv.where("rf <> 'R'").count() < 6000
