"""Proportional stratified interleaving of documents into shards.

Within each stratum (source) the rows are ranked in a seeded shuffle order; row ``r`` of a
stratum of ``n`` has the fractional rank ``(2 r - 1) / 2 n``.  All rows sorted by fractional
rank form a stream in which every stretch holds the strata in proportion, and cutting that
stream into equal runs gives shards that each match the mixture, with row counts at most one
apart (law ``rows``).

At scale: both ranks are two-level.  The shuffle order is cut into ``2**rank_bits`` ranges
per stratum and the fractional ranks into ``cuts`` ranges; rows are numbered inside a range
by a window, and the ranges' row counts give the offsets.  So a source with a third of all
rows is spread over many tasks, and no task or driver sees the whole order.  Texts are not
shuffled: a row travels as id, size, checksum and order key.

Defined results: null source = a stratum of its own; null text = no bytes; rows that repeat
an id are ordered by their text's hash; exactly repeated rows are interchangeable and take
neighbouring places; an empty table gives no rows.  Only the named columns are read, so
further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm.columns import named, text_of
from ledgerprofile.session import Scratch

SEED = 20240229
RANK_BITS = 8
CUTS = 1024


def interleave(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
               stratum_col: str = "source", seed: int = SEED, rank_bits: int = RANK_BITS,
               cuts: int = CUTS) -> DataFrame:
    """(doc_id, stratum, size, text_crc32, position, shard, slot), one row per row of ``docs``.

    ``position`` is the 0-based place in the interleaved stream, ``slot`` the place in the shard.
    """
    scratch = Scratch(docs.sparkSession)
    text = text_of(docs, text_col)
    rows = docs.select(
        named(id_col).alias("doc_id"),
        F.concat(F.when(named(stratum_col).isNull(), "null").otherwise("="),
                 F.coalesce(named(stratum_col).cast("string"), F.lit(""))).alias("stratum"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"))
    rows = rows.withColumn("shuffled", F.xxhash64(F.lit(seed), "doc_id", "text_key"))
    rows = rows.withColumn("part", F.shiftright("shuffled", 64 - rank_bits))
    rows = scratch.store(rows)  # read by the counts and by the ranking

    parts = rows.groupBy("stratum", "part").agg(F.count(F.lit(1)).alias("n_part"))
    per_stratum = Window.partitionBy("stratum")
    before = per_stratum.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("stratum", "part",
                           F.coalesce(F.sum("n_part").over(before), F.lit(0)).alias("before"),
                           F.sum("n_part").over(per_stratum).alias("n"))
    inside = Window.partitionBy("stratum", "part").orderBy("shuffled", "doc_id", "text_key")
    ranked = (rows.withColumn("r", F.row_number().over(inside))
              .join(offsets, ["stratum", "part"])
              .withColumn("r", F.col("r") + F.col("before"))
              .withColumn("cut", F.expr(f"((2 * r - 1) * {cuts}) div (2 * n)"))
              .withColumn("fraction", (2 * F.col("r") - 1) / (2 * F.col("n")))
              .select("doc_id", "stratum", "size", "text_crc32", "r", "cut", "fraction"))
    ranked = scratch.store(ranked)
    scratch.drop(rows)

    # at most `cuts` rows, whatever the table's size
    counted = ranked.groupBy("cut").agg(F.count(F.lit(1)).alias("n_cut"))
    whole = Window.partitionBy(F.lit(0))
    cut_offsets = counted.select(
        "cut", F.coalesce(F.sum("n_cut").over(whole.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0)).alias("before"),
        F.sum("n_cut").over(whole).alias("total"))
    stretch = Window.partitionBy("cut").orderBy("fraction", "stratum", "r")
    placed = (ranked.withColumn("place", F.row_number().over(stretch) - 1)
              .join(F.broadcast(cut_offsets), "cut")
              .withColumn("position", F.col("place") + F.col("before"))
              .withColumn("shard", F.expr(f"cast((position * {n_shards}) div total as int)")))
    return placed.select(
        "doc_id", "stratum", "size", "text_crc32", "position", "shard",
        (F.col("position") - F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")).alias("slot"))
