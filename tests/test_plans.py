"""Plan-shape checks: the properties the scale design relies on, read from executed plans."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerprofile.operators import graph, series
from ledgerprofile.plans.catalog import Inputs
from tests.conftest import months_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_months(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerprofile-plans-"), "months")
    rows = [(f"T{t}", 201200 + m, float(t * m + 1)) for t in range(20) for m in range(1, 13) if (t + m) % 3]
    months_frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def _exchanges(plan):
    return sum(1 for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_series_statistics_shuffle_once(spark, stored_months):
    acf = _plan(series.autocorrelation(stored_months, 201201, 201212, 3))
    slope = _plan(series.growth_slope(stored_months, 201201, 201212))
    # the period's rows are materialised first, then one shuffle by taxpayer
    assert _exchanges(acf) == 1 and _exchanges(slope) == 1
    assert "Subquery" not in acf


def test_period_filter_reaches_the_scan(spark, stored_months):
    plan = _plan(series.in_period(stored_months, 201201, 201206))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for f in ("GreaterThanOrEqual(ny,201201)", "LessThanOrEqual(ny,201206)", "IsNotNull(nsrsbh)"):
        assert f in pushed
    assert "ReadSchema: struct<nsrsbh:string,ny:int,xxje:double>" in plan


def test_second_product_joins_edges_in_place(spark):
    edges = [(f"N{i}", f"N{(i * 7 + 3) % 40}", float(i + 1)) for i in range(40)] + \
            [(f"N{i}", f"N{(i + 1) % 40}", 2.0) for i in range(40)]
    pairs = spark.createDataFrame([("H1", a, b, w) for a, b, w in edges],
                                  "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, zje double")
    adj = graph.adjacency(graph.symmetric_edges(pairs))
    layout = graph._layout(adj, graph.DEFAULT_HOT_DEGREE, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = layout.nodes.select("hy_dm", "node", F.lit(1.0).alias("v"))
        half = graph._multiply(layout, v).withColumnRenamed("u", "v")
        plan = _plan(graph._multiply(layout, half))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        layout.drop()
    # two products: two aggregation shuffles, one shuffle of the initial vector, and no
    # exchange on either edge scan
    assert plan.count("Bucketed: true") == 2
    assert _exchanges(plan) == 3
    assert "ShuffledHashJoin" in plan


def test_period_reaches_the_invoice_scan(spark):
    from ledgerprofile.operators import summary
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerprofile-plans-"), "invoices")
    spark.createDataFrame([("A", "B", 1.0, "19950105000000", "x"), ("A", "B", 2.0, "19970101000000", "x")],
                          "xf_nsrsbh string, gf_nsrsbh string, je double, kprq string, note string").write.parquet(path)
    invoices = spark.read.parquet(path)
    reg = spark.createDataFrame([("A", "H1"), ("B", "H1")], "nsrsbh string, hy_dm string")
    df = summary.pair_monthly_sales(invoices, reg, (199501, 199612))
    pushed = _plan(df).split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(kprq,199501)" in pushed and "LessThan(kprq,199701)" in pushed
    assert "note" not in _plan(df)
    assert [tuple(r) for r in df.collect()] == [("H1", "A", "B", 199501, 1.0)]
    assert summary.pair_monthly_sales(invoices, reg).count() == 2


def test_invoice_queries_read_pruned_parquet(spark, sf001):
    from ledgerprofile.plans.catalog import QUERIES
    plan = _plan(QUERIES["taxpayer_monthly"](spark, sf001))
    assert "Scan ExistingRDD" not in plan and plan.count("FileScan parquet") >= 2
    assert "l_comment" not in plan


def test_industry_months_are_broadcast(spark, stored_months):
    from ledgerprofile.operators import summary
    industry = stored_months.groupBy("hy_dm", "ny").agg(F.sum("xxje").alias("xxje"), F.sum("jxje").alias("jxje"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(summary.taxpayer_vs_industry(stored_months, industry, 201201, 201212))
        beyond = _plan(summary.taxpayer_vs_industry(stored_months, industry, 201201, 201212, broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and _exchanges(plan) == 1      # the aggregation of the industry months
    assert "SortMergeJoin" in beyond


def test_ranked_rows_are_not_shuffled_by_partition(spark, stored_months):
    from ledgerprofile.operators import ranking
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = ranking.with_global_position(stored_months, [F.col("xxje").desc(), F.col("nsrsbh"), F.col("ny")], "pos", 4)
        plan = _plan(ranked)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_part") == 1         # the counts, one row per partition
    assert "SortMergeJoin" not in plan


def test_a_period_reaches_the_scan_of_the_invoices_and_keeps_its_rows(spark, sf001):
    dated = Inputs(spark, sf001, (199502, 199512))
    plan = _plan(dated.pair_months())
    assert "GreaterThanOrEqual(l_shipdate,1995-02-01" in plan and "LessThan(l_shipdate,1996" in plan
    whole = Inputs(spark, sf001).pair_months().where("ny between 199502 and 199512")
    assert whole.count() > 0 and sorted(whole.collect()) == sorted(dated.pair_months().collect())
    assert dated.sales().count() == Inputs(spark, sf001).sales().count()       # only the monthly tables are cut
