"""Query catalogue: every operator of the inventory as a query over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the Parquet tables
in ``sf_dir`` (through the test-data adapter), so its work grows with the tables.  The
parameters of the compared queries are fixed below; derived doubles are rounded where two
engines may sum in a different order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerprofile.functions import scalars
from ledgerprofile.operators import graph, series, summary
from ledgerprofile.plans import tags
from ledgerprofile.session import Scratch, checkpoint_dir
from ledgerprofile.sources import sink
from ledgerprofile.sources import loaders, testdata, warehouse

# Fixed parameters of the compared queries.
START = 199501
END = 199612
LAG = 12
RATIO = 0.2
TOP_N = 5
REGION = "03"
TAG_TIME = "2026-01-01"
TOL = 1e-12
HUB_DEGREE = 3
DIAGONAL = 0.5
MONEY_DIGITS = 2
SHARE_DIGITS = 6
VECTOR_DIGITS = 8
# Centralities and eigenvalues are sums of amounts of about 1e7 in another order on each side:
# whole units are about eight significant digits, as far as two engines agree.
CENTRALITY_DIGITS = 0
PAIRS = 3                 # eigenpairs of the compared queries
PAIR_DIGITS = 6           # their vectors: errors of the first pairs add to the later ones


LATE_FROM = 199606        # month from which the second batch of the warehouse has invoices


def scratch_path(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerprofile_{what}_{uuid.uuid4().hex}"


class Inputs:
    """Lazily built inputs for one test-data folder.

    The monthly tables are materialised once (checkpoint), so the series operators that
    read them are called with ``materialise=False``.  Invoices are read where they lie, each
    side with its own columns; ``period`` restricts the monthly tables to those months.  A job that
    reads them more than twice asks for ``stored`` lines: their joins run once, the lines (of the
    period) are written, and :meth:`drop` deletes them when everything that reads them has been written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None, stored: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.period = period
        self.stored = stored
        self.scratch = Scratch(spark)
        self._stored_lines: DataFrame | None = None
        self._tables: tuple[DataFrame, DataFrame] | None = None

    def lines(self, period: tuple[int, int] | None = None) -> DataFrame:
        """The invoices, or those of a period, which a range of ship times picks in the scan."""
        if not self.stored:
            return testdata.invoice_lines(self.spark, self.sf_dir, period)
        if self._stored_lines is None:
            lines = testdata.invoice_lines(self.spark, self.sf_dir, self.period)
            self._stored_lines = self.scratch.store(
                lines.where(scalars.time_text_between("kprq", *self.period)) if self.period else lines)
        return self._stored_lines

    def drop(self) -> None:
        self.scratch.drop(self._stored_lines)
        self._stored_lines = None

    def sales(self, period: tuple[int, int] | None = None) -> DataFrame:
        return loaders.sales_invoices(self.lines(period))

    def purchases(self, period: tuple[int, int] | None = None) -> DataFrame:
        return loaders.purchase_invoices(self.lines(period).where(F.col("rf") != F.lit(testdata.RETURNED_FLAG)))

    def registry(self) -> DataFrame:
        return loaders.registry(testdata.registry_table(self.spark, self.sf_dir))

    def registry_maps(self) -> DataFrame:
        return testdata.registry_maps_table(self.spark, self.sf_dir)

    def _monthly(self) -> tuple[DataFrame, DataFrame]:
        """Taxpayer and industry months from one materialised A1 pass, read back through
        the warehouse column names (S8, S9)."""
        if self._tables is None:
            t, h = summary.monthly_tables(self.sales(self.period), self.purchases(self.period), self.registry(),
                                          period=self.period)
            tw = t.select(F.col("hy_dm").alias("hy_key"), F.col("nsrsbh").alias("nsr_key"),
                          F.col("ny").alias("date_key"), "lr", "jxje", "xxje")
            hw = h.select(F.col("hy_dm").alias("hy_key"), F.col("ny").alias("date_key"),
                          "lr", "jxje", "xxje")
            self._tables = (loaders.taxpayer_monthly_table(tw), loaders.industry_monthly_table(hw))
        return self._tables

    def taxpayer_months(self) -> DataFrame:
        """(hy_dm, nsrsbh, ny, lr, jxje, xxje)."""
        return self._monthly()[0]

    def industry_months(self) -> DataFrame:
        """(hy_dm, ny, lr, jxje, xxje)."""
        return self._monthly()[1]

    def pair_months(self) -> DataFrame:
        p = summary.pair_monthly_for_tags(self.sales(self.period), self.registry(), self.period)
        warehouse = p.select(F.col("hy_dm").alias("hy_key"), F.col("xf_nsrsbh").alias("nsr_key"),
                             F.col("gf_nsrsbh").alias("jy_nsrsbh"), F.col("ny").alias("date_key"), "je")
        return loaders.trade_pairs_monthly_table(warehouse)

    def warehouse(self) -> warehouse.Warehouse:
        """The invoices loaded in two batches: late invoices touch only the months from ``LATE_FROM``."""
        stored = warehouse.Warehouse(self.spark, scratch_path(self.spark, "warehouse"))
        late = (F.pmod(F.xxhash64("xf_nsrsbh", "gf_nsrsbh", "kprq"), F.lit(10)) == 0) & (F.col("kprq") >= str(LATE_FROM))
        for batch, rows in (("first", ~late), ("late", late)):
            stored.load(batch, self.sales().where(rows), self.purchases().where(rows), self.registry())
        self.drop()
        return stored

    def adjacency(self) -> DataFrame:
        totals = loaders.trade_pair_totals(self.pair_months(), START, END)
        return graph.adjacency(graph.symmetric_edges(totals))


def _money(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), MONEY_DIGITS))
    return df


# --- sources -------------------------------------------------------------------------------
def q_scan_invoices(spark, sf_dir):
    inv = testdata.invoice_lines(spark, sf_dir)
    return inv.select("xf_nsrsbh", "gf_nsrsbh", F.col("je").cast("double").alias("je"), "kprq", "rf")


def q_sales_invoices(spark, sf_dir):
    s = Inputs(spark, sf_dir).sales()
    return s.withColumn("je", F.col("je").cast("double"))


def q_purchase_invoices(spark, sf_dir):
    p = Inputs(spark, sf_dir).purchases()
    return p.withColumn("je", F.col("je").cast("double"))


def q_registry(spark, sf_dir):
    return Inputs(spark, sf_dir).registry()


def q_registry_with_industry(spark, sf_dir):
    return loaders.registry_from_maps(Inputs(spark, sf_dir).registry_maps())


def q_registry_missing_industry(spark, sf_dir):
    return loaders.registry_from_maps(Inputs(spark, sf_dir).registry_maps(), missing_industry=True)


def q_foreign_trade_registry(spark, sf_dir):
    return loaders.foreign_trade_registry(Inputs(spark, sf_dir).registry_maps())


def q_trade_pairs_monthly(spark, sf_dir):
    return Inputs(spark, sf_dir).pair_months()


def q_trade_pairs_region(spark, sf_dir):
    return loaders.trade_pairs_in_period(Inputs(spark, sf_dir).pair_months(), START, END, REGION)


def q_trade_pair_totals(spark, sf_dir):
    t = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    return _money(t, "zje")


def q_scan_stored_table(spark, sf_dir):
    """A stored table by its path."""
    li = loaders.scan_table(spark, f"{sf_dir}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("l_extendedprice"))


def q_catalog_invoices(spark, sf_dir):
    """The invoices as a table of the catalog."""
    testdata.invoice_lines(spark, sf_dir).createOrReplaceTempView("ledgerprofile_invoices")
    inv = loaders.catalog_invoices(spark, "ledgerprofile_invoices")
    return inv.withColumn("je", F.col("je").cast("double"))


def q_tag_table(spark, sf_dir):
    """Two tag jobs appended to one table, and the table read back."""
    table = f"ledgerprofile_tags_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    sink.append_tags(q_tag_foreign_trade(spark, sf_dir), table, path=path)
    sink.append_tags(q_tag_industry_leader(spark, sf_dir), table, path=path)
    rows = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {table}")          # the files stay
    return rows


def q_catalog_invoices_period(spark, sf_dir):
    """The invoices as a catalog table partitioned by month, read for a period."""
    stored = warehouse.Warehouse(spark, scratch_path(spark, "invoices"))
    stored.store_invoices("sales", "all", Inputs(spark, sf_dir).sales())
    name = stored.register("sales", f"ledgerprofile_{uuid.uuid4().hex}")
    inv = loaders.catalog_invoices(spark, name, (START, END))
    return inv.withColumn("je", F.col("je").cast("double"))


def q_warehouse_taxpayer_monthly(spark, sf_dir):
    """The stored taxpayer months of a period, after two incremental loads."""
    return loaders.taxpayer_monthly_table(Inputs(spark, sf_dir, stored=True).warehouse().monthly("taxpayer_months", (START, END)))


def q_warehouse_industry_monthly(spark, sf_dir):
    """The same for the industry months."""
    return loaders.industry_monthly_table(Inputs(spark, sf_dir, stored=True).warehouse().monthly("industry_months", (START, END)))


def q_warehouse_trade_pairs(spark, sf_dir):
    """The same for the trade pairs of a region."""
    pairs = loaders.trade_pairs_monthly_table(Inputs(spark, sf_dir, stored=True).warehouse().monthly("trade_pairs", (START, END)))
    return loaders.trade_pairs_in_period(pairs, START, END, REGION)


def _stored_maps(spark, sf_dir):
    path = scratch_path(spark, "maps")
    testdata.write_registry_maps(spark, sf_dir, path)
    return spark.read.parquet(path)


def q_stored_registry_with_industry(spark, sf_dir):
    """The registry from a stored map column with missing keys and null maps."""
    return loaders.registry_from_maps(_stored_maps(spark, sf_dir))


def q_stored_registry_missing_industry(spark, sf_dir):
    return loaders.registry_from_maps(_stored_maps(spark, sf_dir), missing_industry=True)


def q_stored_foreign_trade_registry(spark, sf_dir):
    """The same for export registrations."""
    return loaders.foreign_trade_registry(_stored_maps(spark, sf_dir))


def q_profile_tags_rerun(spark, sf_dir):
    """All five tags put in place in one commit, twice; one copy stays."""
    path = scratch_path(spark, "tags")
    for _ in range(2):
        warehouse.replace_tags(q_enterprise_profile_all(spark, sf_dir), path, list(tags.PROFILE_KEYS), END)
    return warehouse.read_tags(spark, path)


# --- scalars -------------------------------------------------------------------------------
def q_invoice_month(spark, sf_dir):
    s = Inputs(spark, sf_dir, (START, END)).sales()
    return s.select("xf_nsrsbh", "kprq", scalars.invoice_month("kprq").alias("ny"))


def q_first_token(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = F.col("l_shipdate").cast("string")
    return li.select("l_orderkey", "l_linenumber", scalars.first_token(text).alias("ship_day"))


def q_period_filter(spark, sf_dir):
    t = Inputs(spark, sf_dir).taxpayer_months()
    return t.where(scalars.period_between("ny", START, END))


def q_digit_count(spark, sf_dir):
    t = Inputs(spark, sf_dir).taxpayer_months()
    return t.select("nsrsbh", "ny", "lr",
                    scalars.digit_count("lr").alias("lr_digits"),
                    scalars.digit_count("xxje").alias("xxje_digits"))


def q_series_min_max(spark, sf_dir):
    return series.series_min_max(Inputs(spark, sf_dir).taxpayer_months(), START, END)


# --- joins and summaries -------------------------------------------------------------------
def q_invoices_with_industry(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    j = summary.invoices_with_industry(i.sales(), i.registry(), "seller")
    return j.withColumn("je", F.col("je").cast("double"))


def q_taxpayer_monthly(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return summary.taxpayer_monthly(i.sales(), i.purchases(), i.registry())


def q_industry_monthly(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return summary.industry_monthly(i.sales(), i.purchases(), i.registry())


def q_pair_monthly_sales(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return summary.pair_monthly_sales(i.sales(), i.registry())


def q_pair_monthly_purchases(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return summary.pair_monthly_purchases(i.purchases(), i.registry())


def q_pair_totals(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    t = summary.pair_totals(summary.pair_monthly_sales(i.sales(), i.registry()))
    return _money(t, "xxnje")


def q_month_count(spark, sf_dir):
    return summary.month_count(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END)


def q_edges_per_industry(spark, sf_dir):
    t = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    return summary.rows_per_industry(t)


def q_taxpayer_vs_industry(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END))
    return summary.taxpayer_vs_industry(i.taxpayer_months(), i.industry_months(), START, END)


def q_industry_share(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END))
    s = tags.industry_share(i.taxpayer_months(), i.industry_months(), START, END)
    s = _money(s, "zxxje", "zjxje", "hyzxxje", "hyzjxje")
    return s.withColumn("xxbl", F.round("xxbl", SHARE_DIGITS))


def q_industry_top_n(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END))
    return tags.industry_top_n(i.taxpayer_months(), i.industry_months(), START, END, TOP_N, SHARE_DIGITS)


# --- series --------------------------------------------------------------------------------
def q_monthly_pivot(spark, sf_dir):
    return series.monthly_pivot(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, materialise=False)


def q_growth_slope_ridge(spark, sf_dir):
    return series.growth_slope(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, materialise=False)


def q_growth_slope_ols(spark, sf_dir):
    return series.growth_slope(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, ridge=0.0,
                               materialise=False)


def q_monthly_autocorrelation(spark, sf_dir, lag=LAG):
    return series.autocorrelation(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, lag,
                                  materialise=False)


def q_coefficient_histogram(spark, sf_dir):
    c = series.autocorrelation(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, LAG,
                               materialise=False)
    return series.coefficient_histogram(c)


# --- graph ---------------------------------------------------------------------------------
def q_trade_edges_symmetric(spark, sf_dir):
    t = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    return _money(graph.symmetric_edges(t), "zje")


def q_trade_adjacency(spark, sf_dir):
    return _money(Inputs(spark, sf_dir, (START, END)).adjacency(), "w")


def q_trade_degree(spark, sf_dir):
    return graph.degree(Inputs(spark, sf_dir, (START, END)).adjacency())


def q_trade_nodes(spark, sf_dir):
    t = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    return graph.node_counts(graph.symmetric_edges(t))


def q_trade_eigenvector(spark, sf_dir):
    v = graph.leading_eigenvector(Inputs(spark, sf_dir, (START, END)).adjacency(), TOL)
    return v.select("hy_dm", "nsrsbh", F.round("v", VECTOR_DIGITS).alias("v"),
                    F.round("eigenvalue", CENTRALITY_DIGITS).alias("eigenvalue"))


def q_trade_eigenpairs(spark, sf_dir):
    """M4 with k = 3: the eigenpairs of largest magnitude of the symmetric trade graph."""
    v = graph.leading_eigenpairs(Inputs(spark, sf_dir, (START, END)).adjacency(), PAIRS, TOL)
    return v.select("hy_dm", "rank", "nsrsbh", F.round("v", PAIR_DIGITS).alias("v"),
                    F.round("eigenvalue", CENTRALITY_DIGITS).alias("eigenvalue"))


def q_trade_singular_vectors(spark, sf_dir):
    """M4 on a matrix that is not symmetric: sellers in rows, buyers in columns, k = 3."""
    totals = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    v = graph.gramian_eigenpairs(totals.withColumnRenamed("zje", "w"), PAIRS, TOL)
    return v.select("hy_dm", "rank", "nsrsbh", F.round("v", PAIR_DIGITS).alias("v"),
                    F.round(F.sqrt("eigenvalue"), CENTRALITY_DIGITS).alias("singular_value"))


def q_trade_singular_vectors_iterated(spark, sf_dir):
    """The same by the distributed iteration, as industries beyond one task go."""
    totals = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    v = graph.gramian_eigenpairs(totals.withColumnRenamed("zje", "w"), 1, local_nodes=0)
    return v.select("hy_dm", "rank", "nsrsbh", F.round("v", PAIR_DIGITS).alias("v"),
                    F.round(F.sqrt("eigenvalue"), CENTRALITY_DIGITS).alias("singular_value"))


def q_trade_centrality(spark, sf_dir):
    c = graph.eigenvector_centrality(Inputs(spark, sf_dir, (START, END)).adjacency(), TOL)
    return c.withColumn("centrality", F.round("centrality", CENTRALITY_DIGITS))


def q_trade_centrality_hubs(spark, sf_dir):
    """M5 by the distributed iteration, with almost every node on the hub path."""
    c = graph.eigenvector_centrality(Inputs(spark, sf_dir, (START, END)).adjacency(), hot_degree=HUB_DEGREE,
                                     local_nodes=0)
    return c.withColumn("centrality", F.round("centrality", CENTRALITY_DIGITS))


def q_trade_adjacency_diagonal(spark, sf_dir):
    """A8 with weight on the empty diagonal cells."""
    totals = loaders.trade_pair_totals(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END)
    return _money(graph.adjacency(graph.symmetric_edges(totals), diag_eps=DIAGONAL), "w")


# --- tags ----------------------------------------------------------------------------------
def q_tag_foreign_trade(spark, sf_dir):
    reg = loaders.foreign_trade_registry(Inputs(spark, sf_dir, (START, END)).registry_maps())
    return tags.tag_foreign_trade(reg, START, END, TAG_TIME)


def q_tag_fast_growth(spark, sf_dir):
    return tags.tag_fast_growth(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, RATIO,
                                tag_time=TAG_TIME, materialise=False)


def q_tag_foreign_trade_today(spark, sf_dir):
    """G1 with the current date."""
    reg = loaders.foreign_trade_registry(Inputs(spark, sf_dir).registry_maps())
    return tags.tag_foreign_trade(reg, START, END)


def q_tag_fast_growth_ranked(spark, sf_dir):
    """G2 cut by the distributed ranking, whatever the number of rows kept."""
    return tags.tag_fast_growth(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, RATIO,
                                tag_time=TAG_TIME, bounded_limit=0, materialise=False)


def q_tag_supply_core_least(spark, sf_dir):
    """T4 ascending: the least central companies."""
    return tags.tag_supply_core(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END, RATIO, tol=TOL,
                                descending=False, digits=CENTRALITY_DIGITS, tag_time=TAG_TIME)


def q_tag_fast_growth_ols(spark, sf_dir):
    return tags.tag_fast_growth_ols(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, RATIO,
                                    tag_time=TAG_TIME, materialise=False)


def q_tag_periodic(spark, sf_dir, lag=LAG):
    return tags.tag_periodic(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END, lag, RATIO,
                             tag_time=TAG_TIME, materialise=False)


def q_tag_supply_core(spark, sf_dir):
    return tags.tag_supply_core(Inputs(spark, sf_dir, (START, END)).pair_months(), START, END, RATIO,
                                tol=TOL, digits=CENTRALITY_DIGITS, tag_time=TAG_TIME)


def q_tag_industry_leader(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END))
    return tags.tag_industry_leader(i.taxpayer_months(), i.industry_months(), START, END, 1,
                                    SHARE_DIGITS, TAG_TIME)


def q_growth_level(spark, sf_dir):
    slopes = series.growth_slope(Inputs(spark, sf_dir, (START, END)).taxpayer_months(), START, END,
                                 materialise=False)
    return tags.growth_level(slopes)


def q_enterprise_profile(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END))           # one monthly summary shared by every tag
    months = i.taxpayer_months()
    reg = loaders.foreign_trade_registry(i.registry_maps())
    return tags.enterprise_profile(
        tags.tag_foreign_trade(reg, START, END, TAG_TIME),
        tags.tag_fast_growth(months, START, END, RATIO, tag_time=TAG_TIME, materialise=False),
        tags.tag_periodic(months, START, END, LAG, RATIO, tag_time=TAG_TIME, materialise=False),
        tags.tag_industry_leader(months, i.industry_months(), START, END, 1, SHARE_DIGITS, TAG_TIME),
    )


def q_enterprise_profile_all(spark, sf_dir):
    i = Inputs(spark, sf_dir, (START, END), stored=True)
    months = i.taxpayer_months()
    reg = loaders.foreign_trade_registry(i.registry_maps())
    profile = tags.enterprise_profile(
        tags.tag_foreign_trade(reg, START, END, TAG_TIME),
        tags.tag_fast_growth(months, START, END, RATIO, tag_time=TAG_TIME, materialise=False),
        tags.tag_periodic(months, START, END, LAG, RATIO, tag_time=TAG_TIME, materialise=False),
        tags.tag_supply_core(i.pair_months(), START, END, RATIO, tol=TOL,
                             digits=CENTRALITY_DIGITS, tag_time=TAG_TIME),
        tags.tag_industry_leader(months, i.industry_months(), START, END, 1, SHARE_DIGITS, TAG_TIME),
    )
    i.drop()                        # monthly tables and centralities are written by now
    return profile


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_invoices": q_scan_invoices,
    "scan_stored_table": q_scan_stored_table,
    "catalog_invoices": q_catalog_invoices,
    "catalog_invoices_period": q_catalog_invoices_period,
    "warehouse_taxpayer_monthly": q_warehouse_taxpayer_monthly,
    "warehouse_industry_monthly": q_warehouse_industry_monthly,
    "warehouse_trade_pairs": q_warehouse_trade_pairs,
    "stored_registry_with_industry": q_stored_registry_with_industry,
    "stored_registry_missing_industry": q_stored_registry_missing_industry,
    "stored_foreign_trade_registry": q_stored_foreign_trade_registry,
    "profile_tags_rerun": q_profile_tags_rerun,
    "tag_table": q_tag_table,
    "sales_invoices": q_sales_invoices,
    "purchase_invoices": q_purchase_invoices,
    "registry": q_registry,
    "registry_with_industry": q_registry_with_industry,
    "registry_missing_industry": q_registry_missing_industry,
    "foreign_trade_registry": q_foreign_trade_registry,
    "trade_pairs_monthly": q_trade_pairs_monthly,
    "trade_pairs_region": q_trade_pairs_region,
    "trade_pair_totals": q_trade_pair_totals,
    "invoice_month": q_invoice_month,
    "first_token": q_first_token,
    "period_filter": q_period_filter,
    "digit_count": q_digit_count,
    "series_min_max": q_series_min_max,
    "invoices_with_industry": q_invoices_with_industry,
    "taxpayer_monthly": q_taxpayer_monthly,
    "industry_monthly": q_industry_monthly,
    "pair_monthly_sales": q_pair_monthly_sales,
    "pair_monthly_purchases": q_pair_monthly_purchases,
    "pair_totals": q_pair_totals,
    "month_count": q_month_count,
    "edges_per_industry": q_edges_per_industry,
    "taxpayer_vs_industry": q_taxpayer_vs_industry,
    "industry_share": q_industry_share,
    "industry_top_n": q_industry_top_n,
    "monthly_pivot": q_monthly_pivot,
    "growth_slope_ridge": q_growth_slope_ridge,
    "growth_slope_ols": q_growth_slope_ols,
    "monthly_autocorrelation": q_monthly_autocorrelation,
    "coefficient_histogram": q_coefficient_histogram,
    "trade_edges_symmetric": q_trade_edges_symmetric,
    "trade_adjacency": q_trade_adjacency,
    "trade_degree": q_trade_degree,
    "trade_nodes": q_trade_nodes,
    "trade_eigenvector": q_trade_eigenvector,
    "trade_eigenpairs": q_trade_eigenpairs,
    "trade_singular_vectors": q_trade_singular_vectors,
    "trade_singular_vectors_iterated": q_trade_singular_vectors_iterated,
    "trade_centrality": q_trade_centrality,
    "trade_centrality_hubs": q_trade_centrality_hubs,
    "trade_adjacency_diagonal": q_trade_adjacency_diagonal,
    "tag_foreign_trade": q_tag_foreign_trade,
    "tag_foreign_trade_today": q_tag_foreign_trade_today,
    "tag_fast_growth_ranked": q_tag_fast_growth_ranked,
    "tag_supply_core_least": q_tag_supply_core_least,
    "tag_fast_growth": q_tag_fast_growth,
    "tag_fast_growth_ols": q_tag_fast_growth_ols,
    "tag_periodic": q_tag_periodic,
    "tag_periodic_lag3": partial(q_tag_periodic, lag=3),
    "tag_periodic_lag6": partial(q_tag_periodic, lag=6),
    "tag_supply_core": q_tag_supply_core,
    "tag_industry_leader": q_tag_industry_leader,
    "growth_level": q_growth_level,
    "enterprise_profile": q_enterprise_profile,
    "enterprise_profile_all": q_enterprise_profile_all,
}
