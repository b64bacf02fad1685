"""The tag row contract: one row per (company, tag) appended to the profile table."""

from __future__ import annotations

import datetime as _dt
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output schema of a tag row.
TAG_SCHEMA = T.StructType([
    T.StructField("nsr_key", T.StringType(), False),
    T.StructField("bq_key", T.StringType(), False),
    T.StructField("bq_value", T.DoubleType(), False),
    T.StructField("bq_start_time", T.StringType(), False),
    T.StructField("bq_end_time", T.StringType(), True),
    T.StructField("tag_time", T.StringType(), False),
])

TAG_COLUMNS = [f.name for f in TAG_SCHEMA.fields]


class TagKey(str, Enum):
    """Tag keys of the profile table (3 is unassigned)."""

    FOREIGN_TRADE = "1"
    FAST_GROWTH = "2"
    PERIODIC = "4"
    SUPPLY_CHAIN_CORE = "5"
    INDUSTRY_LEADER = "6"


def today_text() -> str:
    """Current date as ``yyyy-MM-dd`` (the default ``tag_time``)."""
    return _dt.date.today().strftime("%Y-%m-%d")


def to_tags(df: DataFrame, key: TagKey | str, id_col: str | Column, value: Column | str | float,
            end_time: str | int, tag_time: str | None = None) -> DataFrame:
    """Project ``df`` onto the tag schema.

    ``bq_start_time`` is the period end, ``bq_end_time`` is NULL and ``tag_time`` defaults to
    today (pin it for reproducible output).  Rows with a NULL id are dropped; a NULL value
    breaks the contract and raises an error.
    """
    key_text = key.value if isinstance(key, TagKey) else str(key)
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    if isinstance(value, str):
        val = F.col(value)
    elif isinstance(value, Column):
        val = value
    else:
        val = F.lit(float(value))
    out = df.where(idc.isNotNull()).select(
        idc.cast("string").alias("nsr_key"),
        F.lit(key_text).alias("bq_key"),
        F.coalesce(val.cast("double"), F.raise_error(F.lit("a tag row needs a value")).cast("double")).alias("bq_value"),
        F.lit(str(end_time)).alias("bq_start_time"),
        F.lit(None).cast("string").alias("bq_end_time"),
        F.lit(tag_time or today_text()).alias("tag_time"),
    )
    return out
