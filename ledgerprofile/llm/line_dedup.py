"""Line deduplication across documents, with DataFrame functions only.

Lines are exploded with their positions; a line's key is the line without
``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased.  The keys of at least
``min_chars`` code points are hashed (128 bits), documents are counted per hash, and a key
found in at least ``min_docs`` documents loses all its lines except those of the largest
``doc_id`` that holds it.  The other lines are put together again by position.

At scale: only hashes, ids and positions are shuffled for the counts (the distinct count is
two-step, so a line that a third of all documents holds is pre-aggregated in each task);
the join of lines with dropped keys is salted on the line side; texts are shuffled once, to
meet the positions that they lose.

Defined results: null or empty text = one empty line; null ids count as one document that
is smaller than all others; rows that repeat an id with another text are separate texts of
one document; exactly repeated rows each lose the same lines; a text that loses all lines
becomes the empty text; extra columns are carried along whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerprofile.llm.columns import named, packed, text_of

# The white space that a key loses at both ends.
STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
SALTS = 16


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the sorted 0-based positions ``dropped``: the runs between them."""
    def run(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.element_at(dropped, F.greatest(i, F.lit(1))) + 1)
        end = F.when(i == F.size(dropped), F.size(lines)).otherwise(
            F.element_at(dropped, F.least(i + 1, F.size(dropped))))
        return F.slice(lines, begin + 1, end - begin)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), run))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: ``row`` (its columns), ``n_lines``, ``dropped`` (sorted
    0-based positions) and ``kept_text``."""
    text = text_of(docs, text_col)
    base = docs.select(packed(docs).alias("row"), named(id_col).alias("id"), F.xxhash64(text).alias("text_key"))
    key = F.btrim(F.col("line"), F.lit(STRIPPED))
    lines = (docs.select(named(id_col).alias("id"), F.xxhash64(text).alias("text_key"),
                         F.posexplode(_lines(text)).alias("pos", "line"))
             .withColumn("key", key).where(F.length("key") >= min_chars)
             .withColumn("key", F.translate("key", string.ascii_uppercase, string.ascii_lowercase))
             .select("id", "text_key", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))
    n_docs = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    repeated = (lines.groupBy("h1", "h2").agg(n_docs.alias("n_docs"), F.max("id").alias("keeper"))
                .where(F.col("n_docs") >= min_docs)
                .select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    lost = (lines.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
            .join(repeated, ["h1", "h2", "salt"])
            .where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("id").alias("lost_id"), F.col("text_key").alias("lost_key"))
            .agg(F.sort_array(F.collect_set("pos")).alias("dropped")))
    none = F.array().cast("array<int>")
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))   # texts travel in their rows only
    split = _lines(text)
    return (base.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_key")), "left")
            .select("row", F.size(split).alias("n_lines"), F.coalesce("dropped", none).alias("dropped"),
                    F.when(F.col("dropped").isNull(), text)
                     .otherwise(F.array_join(_without(split, F.col("dropped")), "\n")).alias("kept_text")))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """The digest of :func:`dedup_lines` per document."""
    return dedup_lines(docs, **options).select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept_text", 256).alias("kept_sha256"))
