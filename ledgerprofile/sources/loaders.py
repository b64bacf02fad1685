"""Loaders: file and catalog scans plus the narrow projections every job starts from.

All loaders are lazy projections/filters, so Catalyst prunes columns and pushes the period
and region predicates into the Parquet scan (``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerprofile.functions.scalars import non_empty, period_between

INVOICE_COLUMNS = ["xf_nsrsbh", "gf_nsrsbh", "je", "kprq"]


# S1 -------------------------------------------------------------------------------------
def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Load a stored table (Parquet unless ``fmt`` says otherwise)."""
    return spark.read.format(fmt).load(path)


# S2 / S3 / S4 ---------------------------------------------------------------------------
def sales_invoices(df: DataFrame) -> DataFrame:
    """Sales (output) invoices: seller, buyer, amount, invoice time."""
    return df.select(*INVOICE_COLUMNS)


def purchase_invoices(df: DataFrame) -> DataFrame:
    """Purchase (input) invoices: same columns as the sales side."""
    return df.select(*INVOICE_COLUMNS)


def registry(df: DataFrame) -> DataFrame:
    """Taxpayer registry: id and industry code."""
    return df.select("nsrsbh", "hy_dm")


# S5 -------------------------------------------------------------------------------------
def catalog_invoices(spark: SparkSession, table: str, period: tuple[int, int] | None = None,
                     month_col: str = "date_key") -> DataFrame:
    """Invoice fact table from the catalog, narrowed to the four used columns.

    ``period`` (first and last month) prunes a table that is partitioned by ``month_col``.
    """
    invoices = spark.table(table)
    if period:
        invoices = invoices.where(period_between(month_col, *period))
    return invoices.select("gf_nsrsbh", "xf_nsrsbh", "je", "kprq")


# S6 / S7 --------------------------------------------------------------------------------
def registry_from_maps(df: DataFrame, missing_industry: bool = False) -> DataFrame:
    """Registry from a map-typed taxpayer table (``rowkey``, ``nsrkz`` map).

    ``missing_industry=False`` keeps taxpayers whose ``nsrkz['hymx_dm']`` is non-empty (the
    rows downstream summaries can use).  ``missing_industry=True`` keeps the ones whose
    industry is the empty string: a data-quality listing.  A missing key is NULL and is in
    neither list.
    """
    industry = F.col("nsrkz")["hymx_dm"]
    cond = (industry == F.lit("")) if missing_industry else non_empty(industry)
    return df.where(cond).select(F.col("rowkey").alias("nsrsbh"), industry.alias("hy_dm"))


def foreign_trade_registry(df: DataFrame) -> DataFrame:
    """Taxpayers with a non-empty export registration number ``ckts['nsrdj_no']``."""
    return df.where(non_empty(F.col("ckts")["nsrdj_no"])).select(F.col("rowkey").alias("nsrsbh"))


# S8 / S9 / S10 --------------------------------------------------------------------------
def taxpayer_monthly_table(df: DataFrame) -> DataFrame:
    """Warehouse taxpayer-month totals -> (hy_dm, nsrsbh, ny, lr, jxje, xxje)."""
    return df.select(
        F.col("hy_key").alias("hy_dm"), F.col("nsr_key").alias("nsrsbh"),
        F.col("date_key").alias("ny"), "lr", "jxje", "xxje",
    )


def industry_monthly_table(df: DataFrame) -> DataFrame:
    """Warehouse industry-month totals -> (hy_dm, ny, lr, jxje, xxje)."""
    return df.select(
        F.col("hy_key").alias("hy_dm"), F.col("date_key").alias("ny"), "lr", "jxje", "xxje",
    )


def trade_pairs_monthly_table(df: DataFrame) -> DataFrame:
    """Warehouse seller->buyer monthly amounts -> (hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je)."""
    return df.select(
        F.col("hy_key").alias("hy_dm"), F.col("nsr_key").alias("xf_nsrsbh"),
        F.col("jy_nsrsbh").alias("gf_nsrsbh"), F.col("date_key").alias("ny"), "je",
    )


# S11 / S12 ------------------------------------------------------------------------------
def trade_pairs_in_period(pairs: DataFrame, start: int, end: int,
                          prefix: str | None = None) -> DataFrame:
    """Trade-pair months inside ``[start, end]`` whose *seller* id starts with ``prefix``.

    ``prefix=None`` keeps every region.
    """
    cond = period_between("ny", start, end)
    if prefix is not None:
        # same rows as region_prefix(id) == prefix, written as a prefix test so that it is
        # pushed into the Parquet scan (StringStartsWith) and can skip row groups
        cond = cond & F.col("xf_nsrsbh").startswith(prefix)
    return pairs.where(cond)


def trade_pair_totals(pairs: DataFrame, start: int, end: int,
                      prefix: str | None = None) -> DataFrame:
    """Per (industry, seller, buyer): the amount summed over the period, as ``zje``."""
    return (trade_pairs_in_period(pairs, start, end, prefix)
            .groupBy("hy_dm", "xf_nsrsbh", "gf_nsrsbh")
            .agg(F.sum("je").alias("zje")))
