"""Month-partitioned warehouse: invoices as facts, monthly tables (S8-S10) kept up to date.

Invoices are stored by month and batch.  Loading a batch stores its invoices, finds the months
it touches and aggregates only those again; a monthly table's other partitions are not read or
written.  Every write replaces whole partitions in one commit (dynamic partition overwrite), so a
load that failed half-way, or is run again, leaves the same tables as one that ran once: a batch replaces
what was stored under its name, and the months that it held before count as touched.

Readers take a period, which prunes partitions before any file is opened (``PartitionFilters`` in
``explain``); :func:`invoices_in_periods` prunes by a table of periods at run time.  What reaches
the driver are the months of a batch.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerprofile.functions.scalars import month_key, period_between
from ledgerprofile.functions.tagrows import TAG_COLUMNS, TAG_SCHEMA
from ledgerprofile.operators import summary
from ledgerprofile.session import drop_folder, folder_exists

Period = tuple[int, int]

NO_MONTH = 0                      # the partition of invoices without a valid time


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _DOUBLE, _INT = T.StringType(), T.DoubleType(), T.IntegerType()
INVOICES = _schema(xf_nsrsbh=_TEXT, gf_nsrsbh=_TEXT, je=T.DecimalType(18, 2), kprq=_TEXT, date_key=_INT, batch=_TEXT)
# The column names of the stored monthly tables.
MONTHLY = {
    "taxpayer_months": _schema(hy_key=_TEXT, nsr_key=_TEXT, lr=_DOUBLE, jxje=_DOUBLE, xxje=_DOUBLE, date_key=_INT),
    "industry_months": _schema(hy_key=_TEXT, lr=_DOUBLE, jxje=_DOUBLE, xxje=_DOUBLE, date_key=_INT),
    "trade_pairs": _schema(hy_key=_TEXT, nsr_key=_TEXT, jy_nsrsbh=_TEXT, je=_DOUBLE, date_key=_INT),
}


OUTSIDE = "rows outside the replaced partitions"


def _partition_files(spark: SparkSession, path: str) -> set[str]:
    return set(spark.read.schema("any int").parquet(path).inputFiles()) if folder_exists(spark, path) else set()


def _write_partitions(df: DataFrame, path: str, keys: list[str]) -> set[tuple[str, ...]]:
    """Write ``df`` over the partitions that it has rows for, in one commit; returns those, as texts.

    The rows are computed once and go straight to their files; new files tell which partitions they are in.
    """
    before = _partition_files(df.sparkSession, path)
    (df.repartition(*keys, F.pmod(F.xxhash64(*df.columns), F.lit(8)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
    folders = {tuple(file.split("/")[-len(keys) - 1:-1]) for file in _partition_files(df.sparkSession, path) - before}
    return {tuple(unquote(unquote(part.split("=", 1)[1])) for part in folder) for folder in folders}


def _drop_partitions(spark: SparkSession, path: str, keys: list[str], partitions: set[tuple[str, ...]]) -> None:
    for values in partitions:
        drop_folder(spark, "/".join([path, *(f"{k}={v}" for k, v in zip(keys, values))]))


def replace_partitions(df: DataFrame, path: str, keys: list[str], scope: list[tuple]) -> None:
    """Make ``df`` the content of the partitions ``scope`` (tuples of ``keys``) of the table at ``path``.

    All of ``df`` lies in the scope; a row outside ends the write before its commit.  ``df`` is computed once; the
    new partitions are put in place by one commit, and partitions of the scope that have no rows any more are
    removed after it.
    """
    first, *rest = keys
    inside = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).isin(["/".join(map(str, v)) for v in scope])
    refused = F.raise_error(F.concat_ws(" ", F.lit(f"{OUTSIDE}:"), *[F.col(k).cast("string") for k in keys]))
    checked = df.select(*[F.when(inside, F.col(c)).otherwise(refused.cast(df.schema[c].dataType)).alias(c) if c == first else c
                          for c in df.columns])
    try:
        filled = _write_partitions(checked, path, keys)
    except PySparkException as e:
        if OUTSIDE in str(e):
            raise ValueError(str(e)) from e
        raise
    _drop_partitions(df.sparkSession, path, keys, {tuple(map(str, values)) for values in scope} - filled)


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; no rows if it was never written."""
    return spark.read.schema(schema).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], schema)


class Warehouse:
    """The tables of one warehouse below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.names: list[str] = []

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def invoices(self, side: str, period: Period | None = None) -> DataFrame:
        """The stored ``sales`` or ``purchases`` (xf_nsrsbh, gf_nsrsbh, je, kprq, date_key, batch)."""
        rows = stored(self.spark, self.path(side), INVOICES)
        return rows.where(period_between("date_key", *period)) if period else rows

    def monthly(self, table: str, period: Period | None = None) -> DataFrame:
        """A monthly table under its stored names; only the period's partitions are read."""
        rows = stored(self.spark, self.path(table), MONTHLY[table])
        return rows.where(period_between("date_key", *period)) if period else rows

    def store_invoices(self, side: str, batch: str, invoices: DataFrame) -> list[int]:
        """Replace the batch's invoices of one side (``sales`` or ``purchases``); returns the months it
        holds or held.  The monthly tables stay as they are: see :meth:`load`."""
        if not batch or set(batch) & set("/\\=%:"):
            raise ValueError(f"a batch needs a plain name, not {batch!r}")
        rows = invoices.select("xf_nsrsbh", "gf_nsrsbh", F.col("je").cast("decimal(18,2)").alias("je"), "kprq",
                               F.coalesce(month_key("kprq"), F.lit(NO_MONTH)).alias("date_key"), F.lit(batch).alias("batch"))
        held = {(str(r[0]), r[1]) for r in self.invoices(side).where(F.col("batch") == batch).select("date_key", "batch").distinct().collect()}
        filled = _write_partitions(rows, self.path(side), ["date_key", "batch"])
        _drop_partitions(self.spark, self.path(side), ["date_key", "batch"], held - filled)
        return sorted({int(month) for month, _ in held | filled})

    def load(self, batch: str, sales: DataFrame, purchases: DataFrame, registry: DataFrame) -> list[int]:
        """Store a batch of invoices and bring the touched months of all monthly tables up to date.

        Returns those months.  ``registry`` is the current one; months that no batch touches keep the
        industries they were aggregated with (see :meth:`refresh`).
        """
        months = set(self.store_invoices("sales", batch, sales)) | set(self.store_invoices("purchases", batch, purchases))
        return self.refresh(registry, sorted(months - {NO_MONTH}))

    def refresh(self, registry: DataFrame, months: list[int] | None = None) -> list[int]:
        """Aggregate ``months`` (all stored ones, if not given) again from the stored invoices."""
        if months is None:
            both = self.invoices("sales").select("date_key").union(self.invoices("purchases").select("date_key"))
            months = sorted(r[0] for r in both.where(F.col("date_key") != NO_MONTH).distinct().collect())
        if not months:
            return []
        touched = F.col("date_key").isin(months)
        sales, purchases = self.invoices("sales").where(touched), self.invoices("purchases").where(touched)
        taxpayers, industries = summary.monthly_tables(sales, purchases, registry)
        pairs = summary.pair_monthly_for_tags(sales, registry)
        scope = [(m,) for m in months]
        replace_partitions(taxpayers.selectExpr("hy_dm AS hy_key", "nsrsbh AS nsr_key", "lr", "jxje", "xxje", "ny AS date_key"),
                           self.path("taxpayer_months"), ["date_key"], scope)
        replace_partitions(industries.selectExpr("hy_dm AS hy_key", "lr", "jxje", "xxje", "ny AS date_key"),
                           self.path("industry_months"), ["date_key"], scope)
        replace_partitions(pairs.selectExpr("hy_dm AS hy_key", "xf_nsrsbh AS nsr_key", "gf_nsrsbh AS jy_nsrsbh", "je", "ny AS date_key"),
                           self.path("trade_pairs"), ["date_key"], scope)
        return months

    def register(self, table: str, name: str) -> str:
        """Make a stored table a partitioned table of the catalog, called ``name``.

        Months that are stored later are added by another ``MSCK REPAIR TABLE``.
        """
        schema = MONTHLY.get(table, INVOICES)
        keys = [f.name for f in schema if f.name in ("date_key", "batch")]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{self.path(table)}'")
        self.spark.sql(f"MSCK REPAIR TABLE {name}")         # the catalog lists the partitions itself
        self.names.append(name)
        return name

    def drop(self) -> None:
        """Delete all files and catalog entries; frames of this warehouse must not be read again."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_folder(self.spark, self.folder)


def invoices_in_periods(invoices: DataFrame, periods: DataFrame) -> DataFrame:
    """Invoices of a partitioned table whose month is one of ``periods`` (ny).

    The months are known only at run time; the partitions are pruned by them then (dynamic partition
    pruning), as far as Spark finds the list worth it.
    """
    return invoices.join(periods.select(F.col("ny").alias("date_key")).distinct(), "date_key", "left_semi")


# tags ----------------------------------------------------------------------------------------
_STORED_TAGS = T.StructType([T.StructField(f.name, f.dataType) for f in TAG_SCHEMA
                             if f.name not in ("bq_key", "bq_start_time")]
                            + [T.StructField("bq_key", T.StringType()), T.StructField("bq_start_time", T.StringType())])


def replace_tags(tags: DataFrame, path: str, keys: list[str], period: str | int) -> None:
    """Make ``tags`` the stored rows of the tag keys ``keys`` in one period, in one commit.

    Run twice, it leaves one copy; a key without rows loses its old ones; other keys and periods stay.
    ``sink.append_tags`` appends instead.
    """
    rows = tags.select(*[f.name for f in _STORED_TAGS])
    replace_partitions(rows, path, ["bq_key", "bq_start_time"], [(str(k), str(period)) for k in keys])


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """The stored tag rows, in the columns of the tag schema."""
    return stored(spark, path, _STORED_TAGS).select(*TAG_COLUMNS)
