"""Invoice summaries (A1-A6) and the joins they rest on.

Scale notes
-----------
* Invoices are aggregated to (taxpayer, month) / (seller, buyer, month) *before* they meet
  the registry.  Hash aggregation combines map-side, so a seller holding a third of all
  invoices sends at most one partial row per map task to the shuffle; the registry join
  then sees one row per taxpayer-month instead of one per invoice.  Grouping first and
  joining after gives the same rows as the join-then-group order as long as the registry
  holds one row per taxpayer id: every grouping key of the join-then-group form is either
  kept or comes from the registry row.  With a repeated id the orders would differ, so A1-A3 refuse
  such a registry: the registry side is grouped by id (it is far smaller than the invoices) and a
  second row is an error.
* With a period, A1 and A3 test the invoice time as text first (``time_text_between``), so the
  bound is pushed into the scan of stored invoices and other months are never read.
* The registry join is left to Catalyst/AQE: broadcast when the registry's runtime size is
  under the threshold, sort-merge with skew splitting otherwise.
* Money columns are summed in their input type (exact for decimals) and cast to double
  once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerprofile.functions.scalars import month_key, non_empty, period_between, time_text_between
from ledgerprofile.session import Scratch

INDUSTRY_MONTH_BROADCAST_ROWS = 200_000   # industry x month tables up to this size are broadcast
Period = tuple[int, int]                  # first and last month, integers yyyyMM


def _classified(registry: DataFrame, unique: bool = True) -> DataFrame:
    """Registry rows with a usable (non-empty, non-NULL) industry and id.

    With ``unique`` an id that comes twice is an error when the rows are read: the summaries
    aggregate before they meet the registry, which needs one row per taxpayer.
    """
    rows = registry.where(non_empty("hy_dm") & F.col("nsrsbh").isNotNull()).select("nsrsbh", "hy_dm")
    if not unique:
        return rows
    repeated = F.raise_error(F.concat(F.lit("the registry repeats the taxpayer "), F.col("nsrsbh"))).cast("string")
    return (rows.groupBy("nsrsbh").agg(F.min("hy_dm").alias("hy_dm"), F.count(F.lit(1)).alias("n"))
            .select("nsrsbh", F.when(F.col("n") > 1, repeated).otherwise(F.col("hy_dm")).alias("hy_dm")))


def _dated(invoices: DataFrame, period: Period | None, *columns) -> DataFrame:
    """The columns and ``ny`` of the invoices of the period; invalid times are dropped."""
    if period:
        invoices = invoices.where(time_text_between("kprq", *period))
    dated = invoices.select(*columns, month_key("kprq").alias("ny"), "je")
    return dated.where(period_between("ny", *period) if period else F.col("ny").isNotNull())


def _monthly(invoices: DataFrame, id_col: str, amount: str, period: Period | None = None) -> DataFrame:
    """Sum of ``je`` per (id, month); invalid invoice times are dropped."""
    return (_dated(invoices, period, F.col(id_col).alias("nsrsbh"))
            .groupBy("nsrsbh", "ny")
            .agg(F.sum("je").alias(amount)))


# J1 -------------------------------------------------------------------------------------
def invoices_with_industry(invoices: DataFrame, registry: DataFrame, side: str = "seller") -> DataFrame:
    """Invoices joined to the registry on the seller (sales) or buyer (purchases) id.

    Only taxpayers with a non-empty industry remain; the result keeps the invoice columns
    plus ``hy_dm``.
    """
    key = {"seller": "xf_nsrsbh", "buyer": "gf_nsrsbh"}[side]
    reg = _classified(registry, unique=False).withColumnRenamed("nsrsbh", key)
    return invoices.join(reg, key)


# A1 (+ J2) ------------------------------------------------------------------------------
def taxpayer_monthly(sales: DataFrame, purchases: DataFrame, registry: DataFrame,
                     as_double: bool = True, period: Period | None = None) -> DataFrame:
    """Taxpayer-month totals: (nsrsbh, hy_dm, ny, xxje, jxje, lirun).

    ``xxje`` = sales of the month, ``jxje`` = purchases of the month, ``lirun`` = their
    difference.  A month must appear on both sides (inner join on (nsrsbh, ny)).  The
    industry is the sales side's; the registry must hold one row per taxpayer.
    ``as_double=False`` keeps the exact sum type (decimal inputs stay decimal).  ``period``
    (first and last month) reads only invoices of those months.
    """
    xx = _monthly(sales, "xf_nsrsbh", "xxje", period).join(_classified(registry), "nsrsbh")
    # The purchase side needs no registry join of its own: the inner join with the
    # classified sales side already drops every taxpayer without an industry.
    jx = _monthly(purchases, "gf_nsrsbh", "jxje", period)
    out = xx.join(jx, ["nsrsbh", "ny"]).select(
        "nsrsbh", "hy_dm", "ny", "xxje", "jxje", (F.col("xxje") - F.col("jxje")).alias("lirun"))
    if as_double:
        out = out.select("nsrsbh", "hy_dm", "ny",
                         *[F.col(c).cast("double").alias(c) for c in ("xxje", "jxje", "lirun")])
    return out


# A2 -------------------------------------------------------------------------------------
def industry_monthly(sales: DataFrame, purchases: DataFrame, registry: DataFrame,
                     ordered: bool = True) -> DataFrame:
    """Industry-month totals: (hy_dm, ny, hyyxx, hyyjx), ordered by month.

    Summed from the exact taxpayer-month totals, cast to double at the end.
    """
    t = taxpayer_monthly(sales, purchases, registry, as_double=False)
    out = (t.groupBy("hy_dm", "ny")
           .agg(F.sum("xxje").cast("double").alias("hyyxx"),
                F.sum("jxje").cast("double").alias("hyyjx")))
    return out.orderBy("ny") if ordered else out


def monthly_tables(sales: DataFrame, purchases: DataFrame, registry: DataFrame,
                   materialise: bool = True,
                   period: Period | None = None) -> tuple[DataFrame, DataFrame]:
    """(taxpayer months, industry months) under the tag jobs' names, from one A1 pass.

    Both come from the same exact taxpayer-month totals; with ``materialise`` those are
    written once to the checkpoint folder (lineage cut), so every tag job that reads either
    table reuses them instead of re-reading the invoices.
    """
    exact = taxpayer_monthly(sales, purchases, registry, as_double=False, period=period)
    if materialise:
        exact = Scratch(exact.sparkSession).store(exact)      # a checkpoint() would compute it twice
    taxpayers = exact.select(
        "hy_dm", "nsrsbh", "ny", F.col("lirun").cast("double").alias("lr"),
        F.col("jxje").cast("double").alias("jxje"), F.col("xxje").cast("double").alias("xxje"))
    industries = (exact.groupBy("hy_dm", "ny")
                  .agg(F.sum("xxje").alias("xx"), F.sum("jxje").alias("jx"))
                  .select("hy_dm", "ny", (F.col("xx") - F.col("jx")).cast("double").alias("lr"),
                          F.col("jx").cast("double").alias("jxje"), F.col("xx").cast("double").alias("xxje")))
    return taxpayers, industries


# A3 -------------------------------------------------------------------------------------
def pair_monthly_sales(sales: DataFrame, registry: DataFrame, period: Period | None = None) -> DataFrame:
    """Seller->buyer monthly sales: (hy_dm, xf_nsrsbh, gf_nsrsbh, ny, xxyje).

    ``hy_dm`` is the seller's industry; sellers without one are dropped.
    """
    pairs = (_dated(sales, period, "xf_nsrsbh", "gf_nsrsbh")
             .groupBy("xf_nsrsbh", "gf_nsrsbh", "ny")
             .agg(F.sum("je").alias("xxyje")))
    reg = _classified(registry).withColumnRenamed("nsrsbh", "xf_nsrsbh")
    return pairs.join(reg, "xf_nsrsbh").select(
        "hy_dm", "xf_nsrsbh", "gf_nsrsbh", "ny", F.col("xxyje").cast("double").alias("xxyje"))


def pair_monthly_purchases(purchases: DataFrame, registry: DataFrame, period: Period | None = None) -> DataFrame:
    """Buyer-side monthly purchases per pair: (hy_dm, xf_nsrsbh, gf_nsrsbh, ny, jxyje).

    ``hy_dm`` is the *buyer's* industry; buyers without one are dropped.
    """
    pairs = (_dated(purchases, period, "xf_nsrsbh", "gf_nsrsbh")
             .groupBy("xf_nsrsbh", "gf_nsrsbh", "ny")
             .agg(F.sum("je").alias("jxyje")))
    reg = _classified(registry).withColumnRenamed("nsrsbh", "gf_nsrsbh")
    return pairs.join(reg, "gf_nsrsbh").select(
        "hy_dm", "xf_nsrsbh", "gf_nsrsbh", "ny", F.col("jxyje").cast("double").alias("jxyje"))


def pair_monthly_for_tags(sales: DataFrame, registry: DataFrame, period: Period | None = None) -> DataFrame:
    """A3 under the trade-pair table's names: (hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je)."""
    return pair_monthly_sales(sales, registry, period).withColumnRenamed("xxyje", "je")


# A4 -------------------------------------------------------------------------------------
def pair_totals(pair_months: DataFrame) -> DataFrame:
    """Seller->buyer totals over all months: (hy_dm, xf_nsrsbh, gf_nsrsbh, xxnje)."""
    return (pair_months.groupBy("hy_dm", "xf_nsrsbh", "gf_nsrsbh")
            .agg(F.sum("xxyje").alias("xxnje")))


# A5 / A6 --------------------------------------------------------------------------------
def month_count(monthly: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Number of distinct months (in the period, when given) as a one-row frame."""
    if start is not None and end is not None:
        monthly = monthly.where(period_between("ny", start, end))
    return monthly.agg(F.count_distinct("ny").alias("n_months"))


def rows_per_industry(df: DataFrame) -> DataFrame:
    """Row count per industry: (hy_dm, n_rows)."""
    return df.groupBy("hy_dm").agg(F.count(F.lit(1)).alias("n_rows"))


# J3 -------------------------------------------------------------------------------------
def taxpayer_vs_industry(taxpayer_months: DataFrame, industry_months: DataFrame,
                         start: int, end: int,
                         broadcast_rows: int = INDUSTRY_MONTH_BROADCAST_ROWS) -> DataFrame:
    """Taxpayer months next to their industry's month totals, inside the period.

    (hy_dm, nsrsbh, ny, xxje, jxje, hyxxje, hyjxje).  The industry side has one row per
    (industry, month), so the join never multiplies taxpayer rows; it is counted, and up to
    ``broadcast_rows`` rows it is broadcast, so the taxpayer months are not shuffled on the few
    (industry, month) keys.  Beyond that the join is left to Catalyst.
    """
    n = taxpayer_months.where(period_between("ny", start, end) & F.col("nsrsbh").isNotNull()).select(
        "hy_dm", "nsrsbh", "ny", "xxje", "jxje")
    h = industry_months.where(period_between("ny", start, end)).select(
        "hy_dm", "ny", F.col("xxje").alias("hyxxje"), F.col("jxje").alias("hyjxje"))
    if h.limit(broadcast_rows + 1).count() <= broadcast_rows:
        h = F.broadcast(h)
    return n.join(h, ["hy_dm", "ny"])
