"""Adapter from the TPC-H-like test tables to the invoice data model.

Mapping (same as the DuckDB text in ``ledgerprofile.plans.oracle``):

* supplier = taxpayer.  ``nsrsbh`` = 2-digit nation key + 13-digit supplier key; the
  industry is ``'H' || suppkey % 8`` and empty for every eighth taxpayer; every fifth one
  has an export registration number.
* one line item = one sales invoice: seller = the line's supplier, buyer = the order's
  customer key folded onto the supplier keys, amount = ``extendedprice * (1 - discount)``
  rounded to cents in decimal arithmetic, invoice time = ship time as ``yyyyMMddHHmmss``.
* purchase invoices = the same lines minus returned ones (return flag ``R``).

At scale the two big inputs (lineitem, orders) meet in one shuffle join on the order key;
the registry joins are on the supplier side, which AQE broadcasts when its runtime size is
under the broadcast threshold and sort-merge-joins (with skew splitting) otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test-data mapping.
ID_NATION_WIDTH = 2
ID_KEY_WIDTH = 13
INDUSTRY_MODULUS = 8
EXPORT_MODULUS = 5
RETURNED_FLAG = "R"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def taxpayers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, nsrsbh, hy_dm, nsrdj_no) - one row per supplier."""
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    industry = F.col("s_suppkey") % INDUSTRY_MODULUS
    return s.select(
        "s_suppkey",
        F.concat(
            F.lpad(F.col("s_nationkey").cast("string"), ID_NATION_WIDTH, "0"),
            F.lpad(F.col("s_suppkey").cast("string"), ID_KEY_WIDTH, "0"),
        ).alias("nsrsbh"),
        F.when(industry == 0, F.lit(""))
         .otherwise(F.concat(F.lit("H"), industry.cast("string"))).alias("hy_dm"),
        F.when(F.col("s_suppkey") % EXPORT_MODULUS == 0,
               F.concat(F.lit("E"), F.col("s_suppkey").cast("string")))
         .otherwise(F.lit("")).alias("nsrdj_no"),
    )


def registry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat registry (nsrsbh, hy_dm)."""
    return taxpayers(spark, sf_dir).select("nsrsbh", "hy_dm")


def registry_maps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map-typed registry (rowkey, nsrkz map, ckts map) as a key-value store exports it."""
    t = taxpayers(spark, sf_dir)
    return t.select(
        F.col("nsrsbh").alias("rowkey"),
        F.create_map(F.lit("hymx_dm"), F.col("hy_dm")).alias("nsrkz"),
        F.create_map(F.lit("nsrdj_no"), F.col("nsrdj_no")).alias("ckts"),
    )


def write_registry_maps(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A stored map-typed registry as exports have it: maps with several keys, some without the
    wanted one (every seventh and every third taxpayer), some null (every eleventh)."""
    t = taxpayers(spark, sf_dir)
    key = F.col("s_suppkey")
    industry = F.when(key % 7 == 0, F.create_map(F.lit("mc"), F.col("nsrsbh"))).otherwise(
        F.create_map(F.lit("mc"), F.col("nsrsbh"), F.lit("hymx_dm"), F.col("hy_dm")))
    export = F.when(key % 3 == 0, F.create_map(F.lit("other"), F.lit("x"))).otherwise(
        F.create_map(F.lit("nsrdj_no"), F.col("nsrdj_no"), F.lit("other"), F.lit("x")))
    t.select(F.col("nsrsbh").alias("rowkey"), F.when(key % 11 != 0, industry).alias("nsrkz"),
             F.when(key % 11 != 0, export).alias("ckts")).write.parquet(path)


def _first_day(month: int) -> date:
    return date(month // 100, month % 100, 1)


def invoice_lines(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    """All invoices with the return flag: (xf_nsrsbh, gf_nsrsbh, je, kprq, rf).

    With ``period`` (first and last month, ``yyyyMM``) those of its months: a range of ship times, which the
    scan applies before any time becomes text.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag")
    if period:
        first, last = period
        following = last + (89 if last % 100 == 12 else 1)
        li = li.where((F.col("l_shipdate") >= F.lit(_first_day(first))) & (F.col("l_shipdate") < F.lit(_first_day(following))))
    supplier = _read(spark, sf_dir, "supplier")
    # one number from the Parquet footers; as a literal it keeps the sales and purchase
    # branches identical, so their broadcast exchanges are shared
    n_taxpayers = supplier.count()
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % n_taxpayers).alias("buyer_key"))
    reg = taxpayers(spark, sf_dir).select("s_suppkey", "nsrsbh")
    seller = reg.withColumnRenamed("s_suppkey", "seller_key").withColumnRenamed("nsrsbh", "xf_nsrsbh")
    buyer = reg.withColumnRenamed("s_suppkey", "buyer_key").withColumnRenamed("nsrsbh", "gf_nsrsbh")
    amount = F.round(
        F.col("l_extendedprice").cast("decimal(18,2)")
        * (F.lit(1).cast("decimal(18,2)") - F.col("l_discount").cast("decimal(18,2)")),
        2,
    ).cast("decimal(18,2)")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(seller, F.col("l_suppkey") == F.col("seller_key"))
        .join(buyer, "buyer_key")
        .select(
            "xf_nsrsbh", "gf_nsrsbh", amount.alias("je"),
            F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("kprq"),
            F.col("l_returnflag").alias("rf"),
        )
    )


def sales_invoice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales invoices (xf_nsrsbh, gf_nsrsbh, je, kprq)."""
    return invoice_lines(spark, sf_dir).select("xf_nsrsbh", "gf_nsrsbh", "je", "kprq")


def purchase_invoice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase invoices: the non-returned lines."""
    return (invoice_lines(spark, sf_dir)
            .where(F.col("rf") != F.lit(RETURNED_FLAG))
            .select("xf_nsrsbh", "gf_nsrsbh", "je", "kprq"))
