"""Tag jobs (G1-G7) and the combined profile.

Each job returns a DataFrame in the tag schema; the caller appends it with
``ledgerprofile.sources.sink.append_tags``.  Inputs use the aggregate tables' column names:

* taxpayer months: (hy_dm, nsrsbh, ny, lr, jxje, xxje)
* industry months: (hy_dm, ny, lr, jxje, xxje)
* trade-pair months: (hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je)

``start``/``end`` are integer ``yyyyMM`` bounds (inclusive).  ``tag_time`` defaults to today;
pin it for reproducible output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerprofile.functions.scalars import round_half_up, safe_share
from ledgerprofile.functions.tagrows import TAG_COLUMNS, TagKey, to_tags
from ledgerprofile.operators import graph, ranking, series
from ledgerprofile.operators.summary import taxpayer_vs_industry
from ledgerprofile.session import checkpoint_dir
from ledgerprofile.sources.loaders import trade_pair_totals

CORE_COMPANIES_PER_INDUSTRY = 5


# G1 -------------------------------------------------------------------------------------
def tag_foreign_trade(foreign_registry: DataFrame, start: int, end: int,
                      tag_time: str | None = None) -> DataFrame:
    """Tag 1 (value 1.0) for every row of the foreign-trade registry (no de-duplication)."""
    return to_tags(foreign_registry, TagKey.FOREIGN_TRADE, "nsrsbh", 1.0, end, tag_time)


# G2 / G3 --------------------------------------------------------------------------------
def tag_fast_growth(taxpayer_months: DataFrame, start: int, end: int, ratio: float = 1.0,
                    ridge: float = series.DEFAULT_RIDGE, tag_time: str | None = None,
                    bounded_limit: int = ranking.BOUNDED_TOPK_LIMIT,
                    materialise: bool = True) -> DataFrame:
    """Tag 2: growth slope of monthly sales for taxpayers active in every month.

    Positive slopes only; of n of them the best floor(n*ratio)+1 are kept (all when n <= 1).
    ``ridge=0`` gives the unregularised variant.  ``materialise=False`` when the monthly
    table is already stored or checkpointed.
    """
    slopes = series.growth_slope(taxpayer_months, start, end, ridge, materialise=materialise)
    best = ranking.top_fraction(slopes, "slope", "nsrsbh", ratio, "growth", bounded_limit)
    return to_tags(best, TagKey.FAST_GROWTH, "nsrsbh", "slope", end, tag_time)


def tag_fast_growth_ols(taxpayer_months: DataFrame, start: int, end: int, ratio: float = 1.0,
                        tag_time: str | None = None, materialise: bool = True) -> DataFrame:
    """Tag 2 with an ordinary least-squares slope."""
    return tag_fast_growth(taxpayer_months, start, end, ratio, 0.0, tag_time,
                           materialise=materialise)


# G4 -------------------------------------------------------------------------------------
def tag_periodic(taxpayer_months: DataFrame, start: int, end: int, lag: int, ratio: float,
                 tag_time: str | None = None,
                 bounded_limit: int = ranking.BOUNDED_TOPK_LIMIT,
                 materialise: bool = True) -> DataFrame:
    """Tag 4: lag-``lag`` autocorrelation of monthly sales (missing months count as 0).

    Positive, non-NaN coefficients only; of n of them the best floor(n*ratio) are kept
    (all when n <= 2).
    """
    coefficients = series.autocorrelation(taxpayer_months, start, end, lag, materialise=materialise)
    best = ranking.top_fraction(coefficients, "coefficient", "nsrsbh", ratio, "periodic", bounded_limit)
    return to_tags(best, TagKey.PERIODIC, "nsrsbh", "coefficient", end, tag_time)


# G5 -------------------------------------------------------------------------------------
def supply_chain_centrality(pair_months: DataFrame, start: int, end: int,
                            prefix: str | None = None, tol: float = graph.DEFAULT_TOL,
                            hot_degree: int = graph.DEFAULT_HOT_DEGREE,
                            diag_eps: float = 0.0,
                            max_steps: int = graph.DEFAULT_MAX_STEPS) -> DataFrame:
    """(hy_dm, nsrsbh, centrality) of every node of every industry with > 5 nodes.

    ``diag_eps`` fills empty diagonal cells of the adjacency (0 by default).  Every
    industry's eigenvector has a relative residual of at most ``tol``; industries that do not get
    there in ``max_steps`` products are left out and named in a warning.
    """
    totals = trade_pair_totals(pair_months, start, end, prefix)
    adj = graph.adjacency(graph.symmetric_edges(totals), diag_eps=diag_eps)
    return graph.eigenvector_centrality(adj, tol, max_steps, hot_degree=hot_degree)


def tag_supply_core(pair_months: DataFrame, start: int, end: int, ratio: float | None = None,
                    prefix: str | None = None, tol: float = graph.DEFAULT_TOL,
                    top: int = CORE_COMPANIES_PER_INDUSTRY, descending: bool = True,
                    digits: int | None = None, tag_time: str | None = None,
                    hot_degree: int = graph.DEFAULT_HOT_DEGREE, diag_eps: float = 0.0,
                    max_steps: int = graph.DEFAULT_MAX_STEPS) -> DataFrame:
    """Tag 5: the ``top`` most central companies of each industry's trade graph.

    ``descending=False`` keeps the least central ones instead.  ``ratio`` is accepted and
    unused.  ``digits`` rounds the centrality.
    """
    c = supply_chain_centrality(pair_months, start, end, prefix, tol, hot_degree, diag_eps, max_steps)
    if digits is not None:
        c = c.withColumn("centrality", round_half_up("centrality", digits))
    best = ranking.top_n_per_group(c, "hy_dm", "centrality", "nsrsbh", top, descending)
    return to_tags(best, TagKey.SUPPLY_CHAIN_CORE, "nsrsbh", "centrality", end, tag_time)


# G6 -------------------------------------------------------------------------------------
def industry_share(taxpayer_months: DataFrame, industry_months: DataFrame,
                   start: int, end: int) -> DataFrame:
    """(nsrsbh, hy_dm, zxxje, zjxje, hyzxxje, hyzjxje, xxbl).

    Totals of the taxpayer and of its industry over the months in which the *taxpayer* has
    a row (so the denominator covers only those months).  ``xxbl`` = share of sales, 0.0
    when the industry total is 0 or NULL.
    """
    joined = taxpayer_vs_industry(taxpayer_months, industry_months, start, end)
    totals = joined.groupBy("nsrsbh", "hy_dm").agg(
        F.sum("xxje").alias("zxxje"), F.sum("jxje").alias("zjxje"),
        F.sum("hyxxje").alias("hyzxxje"), F.sum("hyjxje").alias("hyzjxje"))
    return totals.withColumn("xxbl", safe_share("zxxje", "hyzxxje"))


def industry_top_n(taxpayer_months: DataFrame, industry_months: DataFrame, start: int, end: int,
                   n: int, digits: int | None = None) -> DataFrame:
    """(hy_dm, nsrsbh, xxbl, rank): the ``n`` largest shares per industry."""
    shares = industry_share(taxpayer_months, industry_months, start, end)
    if digits is not None:
        shares = shares.withColumn("xxbl", round_half_up("xxbl", digits))
    return ranking.top_n_per_group(shares.select("hy_dm", "nsrsbh", "xxbl"), "hy_dm", "xxbl",
                                   "nsrsbh", n, rank_col="rank")


def tag_industry_leader(taxpayer_months: DataFrame, industry_months: DataFrame, start: int,
                        end: int, n: int = 1, digits: int | None = None,
                        tag_time: str | None = None) -> DataFrame:
    """Tag 6: the company with the largest share of its industry's sales.

    ``n`` is accepted for compatibility; exactly one leader per industry is tagged (ties:
    lower id).  Use ``industry_top_n`` for the n best.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    leaders = industry_top_n(taxpayer_months, industry_months, start, end, 1, digits)
    return to_tags(leaders, TagKey.INDUSTRY_LEADER, "nsrsbh", "xxbl", end, tag_time)


# G7 -------------------------------------------------------------------------------------
def growth_level(slopes: DataFrame, stable_below: float = 0.1, band: float = 0.01,
                 bands: int = 5, value: str = "slope", band_rows: int | None = None) -> DataFrame:
    """(nsrsbh, slope, level): growth level -5..5 by percentile bands of the slope.

    |slope| < ``stable_below`` is stable (level 0).  Above it, the top ``band`` fraction of
    the rising companies is level 5, the next band 4, ... down to 1; the rest get 0.  The
    falling side mirrors it with negative levels (steepest fall = -5).  With ``band_rows``
    the bands are that many companies each (top 10 -> 5, next 10 -> 4, ...) instead of
    fractions.  Positions come from a distributed global ranking; nothing is collected.
    """
    checkpoint_dir(slopes.sparkSession)
    slopes = slopes.checkpoint()         # both sides and their counts read it
    v = F.col(value)
    rising = slopes.where(v >= stable_below)
    falling = slopes.where(v <= -stable_below)

    def levelled(side: DataFrame, descending: bool, sign: int) -> DataFrame:
        order = [v.desc() if descending else v.asc(), F.col("nsrsbh").asc()]
        ranked = ranking.with_global_position(side.select("nsrsbh", value), order, "_pos")
        if band_rows:
            raw = F.lit(bands) - F.floor((F.col("_pos") - 1) / F.lit(int(band_rows)))
        else:
            n = side.select(F.count(F.lit(1))).scalar()
            fraction = (F.col("_pos") - 1) / n
            raw = F.lit(bands) - F.floor(fraction / F.lit(band))
        lvl = F.when(raw >= 1, raw).otherwise(F.lit(0)).cast("int") * F.lit(sign)
        return ranked.select("nsrsbh", value, lvl.alias("level"))

    stable = slopes.where(F.abs(v) < stable_below).select("nsrsbh", value, F.lit(0).alias("level"))
    return levelled(rising, True, 1).unionByName(levelled(falling, False, -1)).unionByName(stable)


PROFILE_KEYS = (TagKey.FOREIGN_TRADE.value, TagKey.FAST_GROWTH.value, TagKey.PERIODIC.value,
                TagKey.SUPPLY_CHAIN_CORE.value, TagKey.INDUSTRY_LEADER.value)


# U2 -------------------------------------------------------------------------------------
def enterprise_profile(*tag_frames: DataFrame) -> DataFrame:
    """All tag rows together (union by name, no de-duplication)."""
    frames = [f.select(*TAG_COLUMNS) for f in tag_frames]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = [
    "PROFILE_KEYS",
    "enterprise_profile",
    "growth_level",
    "industry_share",
    "industry_top_n",
    "supply_chain_centrality",
    "tag_fast_growth",
    "tag_fast_growth_ols",
    "tag_foreign_trade",
    "tag_industry_leader",
    "tag_periodic",
    "tag_supply_core",
]
