"""From raw documents to packed training sequences, in five stages.

Each stage takes all rows that the one before kept, calls one operator of
``ledgerprofile.llm`` and applies its decisions; a stage's result is written as Parquet and
read again by the next one, so a lost executor costs one stage's tasks at most.  All stages
but the last return the columns of their input (further columns are carried along).

1. ``toxicity``: documents that the CRF scores at 0.7 or more go.
2. ``line_dedup``: lines that at least five documents share stay in one document only;
   ``n_chars`` follows the text.
3. ``near_duplicates``: of each group of near duplicates (five-word shingles, similarity 0.8)
   the document with the smallest id stays.
4. ``decontamination``: documents with a benchmark passage in a twentieth of their words go.
5. ``packing``: the rest is tokenized and packed into sequences of 4096 ids.

Null texts, empty tables, repeated rows and clashing column names are handled as the
operators say.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerprofile.llm import decontamination, line_dedup, minhash, packing, toxicity
from ledgerprofile.llm.columns import named, packed, text_of, unpacked
from ledgerprofile.llm.queries import PACKED_VOCABULARY, table, toxicity_model
from ledgerprofile.session import checkpoint_dir

NEAR = minhash.MinHash(width=5, threshold=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(spark, docs, sf_dir)
    scored = docs.select(packed(docs).alias("row"), toxicity.score_column(docs, model).alias("toxicity"))
    return scored.where(F.col("toxicity.score") < toxicity.THRESHOLD).select(*unpacked("row", docs.columns))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(docs)
    changed = F.size("dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row")["n_chars"])
           if "n_chars" in docs.columns else None}
    return deduped.select(*unpacked("row", docs.columns, {k: v for k, v in new.items() if v is not None}))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = (minhash.near_duplicates(docs, NEAR).where(~F.col("kept"))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct())
    rows = docs.select(packed(docs).alias("row"), named("doc_id").cast("long").alias("id"),
                       F.xxhash64(text_of(docs, "text")).alias("key"))
    return (rows.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left_anti")
            .select(*unpacked("row", docs.columns)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.is_contaminated()).select(*unpacked("row", docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path(PACKED_VOCABULARY))
    return pieces.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The CRF, MinHash components and tokenized packing have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; stage results are written under ``spark.checkpoint.dir``."""
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
