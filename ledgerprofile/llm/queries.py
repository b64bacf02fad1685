"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ledgerprofile.llm import (
    decontamination, fingerprints, hard_negatives, language_id, line_dedup, manifest, minhash, packing, quality,
    sharding, token_counts, topk, toxicity)
from ledgerprofile.llm.columns import fold

SHARDS = 24
TOXICITY_FOLDS, TOXICITY_HELD_OUT = 3, 1
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 4, 2
TOKEN_LIMIT = 4096
COUNTED_VOCABULARY = "piece_bpe_32k.model"
PACKED_VOCABULARY = "word_bpe_49k.json"
NEAR_WIDTH = 2          # words in a shingle of op10
NEAR_THRESHOLD = 80     # percent
QUERY_STEP = 50         # rows whose id is divisible by this are the queries of op12 and op13
TOP = 5
TAMPERED_STEP = 3       # rows whose crc32(doc_id) this divides are tampered with in op11
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: shard sizes are at most one row apart, and each matches the source mixture."""
    placed = sharding.interleave(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "stratum")


def op2_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = quality.quality_scores(table(spark, sf_dir, "documents"))
    return scores.withColumn("keep", F.col("score") >= quality.KEEP)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Crf | None:
    """Fitted on the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels.where(fold("doc_id", TOXICITY_FOLDS) != TOXICITY_HELD_OUT))


def op4_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    scored = docs.select("doc_id", toxicity.score_column(docs, model).alias("t"))
    return scored.select("doc_id", (fold("doc_id", TOXICITY_FOLDS) == TOXICITY_HELD_OUT).alias("held_out"), "t.score",
                         (F.col("t.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.size("t.spans").alias("n_spans"), "t.spans")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256",
                        decontamination.is_contaminated().alias("contaminated"))


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    model = language_id.train(docs.where(~held_out))
    return (language_id.identify(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKED_VOCABULARY))
    return pieces.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED_VOCABULARY))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = minhash.MinHash(width=NEAR_WIDTH, threshold=NEAR_THRESHOLD)
    return (minhash.near_duplicates(table(spark, sf_dir, "documents"), params)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof, verified against the row after tampering."""
    docs = table(spark, sf_dir, "documents")
    tampered = manifest.leaf_digest(changed={"text": F.translate("text", _UPPER, _LOWER)})
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_STEP == 0
    built = manifest.build(docs, carried={"tampered": F.when(hit, tampered)})
    claimed = F.coalesce("tampered", F.unhex("leaf"))
    return (built.proofs()
            .withColumn("folded_root", manifest.folded(claimed, F.col("siblings"), F.col("places")))
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                    F.sha2(manifest.proof_text(F.col("siblings")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op12_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % QUERY_STEP == 0, label=label)


def op13_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(rows, F.col("vec_id") % QUERY_STEP == 0, TOP)


QUERIES = {
    "op1_interleaved_shards": op1_interleaved_shards,
    "op2_merkle_fingerprints": op2_merkle_fingerprints,
    "op3_weak_label_quality": op3_weak_label_quality,
    "op4_crf_toxicity": op4_crf_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_prefix_filtered_decontamination": op6_prefix_filtered_decontamination,
    "op7_ppm_language": op7_ppm_language,
    "op8_sum_of_squares_packing": op8_sum_of_squares_packing,
    "op9_transducer_token_counts": op9_transducer_token_counts,
    "op10_circulant_minhash": op10_circulant_minhash,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_angular_hard_negatives": op12_angular_hard_negatives,
    "op13_bit_sliced_top_k": op13_bit_sliced_top_k,
}

OP5_SQL = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
    FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
    GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.doc_id, pos, line, keeper IS NOT NULL AND keyed.doc_id <> keeper AS lost
    FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP6_SQL = f"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS size FROM item_words WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS passage
    FROM (SELECT item_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS pos FROM sized)),
sizes AS (SELECT DISTINCT size FROM windows),
stretches AS (SELECT doc_id, size, pos, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS passage
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS pos
          FROM doc_words, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, pos, size, item_id FROM stretches JOIN windows USING (size, passage)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(pos, pos + size - 1)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# crc32 bit by bit over the id's ASCII digits; the run of a node is nodes[b + 1 : b + 8]
OP11_SQL = f"""
WITH RECURSIVE bits AS (SELECT *, row_number() OVER () AS id, flatten([[(ascii(ch) >> k) & 1 for k in range(8)]
        for ch in string_split(coalesce(CAST(doc_id AS VARCHAR), ''), '')]) AS bit FROM documents),
summed AS (SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bit),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS crc FROM bits),
leaves AS (SELECT id, doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")}
        END AS tampered FROM summed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
trees(tree, level, nodes) AS (
    SELECT tree, 0, list(leaf ORDER BY pos) FROM ranked GROUP BY tree
    UNION ALL
    SELECT tree, level + 1, [sha256(array_to_string(nodes[i + 1 : i + 8], '')) for i in range(0, len(nodes), 8)]
    FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
    FROM trees WHERE len(nodes) = 1),
tops(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY place) FROM subroots
    UNION ALL
    SELECT level + 1, [sha256(array_to_string(nodes[i + 1 : i + 8], '')) for i in range(0, len(nodes), 8)]
    FROM tops WHERE len(nodes) > 1),
ways(id, tree, level, pos, below, proof) AS (
    SELECT id, tree, 0, pos, coalesce(tampered, leaf), '' FROM ranked
    UNION ALL
    SELECT id, tree, level + 1, pos // 8, sha256(array_to_string(nodes[pos // 8 * 8 + 1 : pos], '') || below
            || array_to_string(nodes[pos + 2 : pos // 8 * 8 + 8], '')),
        proof || array_to_string(nodes[pos // 8 * 8 + 1 : pos], '') || array_to_string(nodes[pos + 2 : pos // 8 * 8 + 8], '')
    FROM ways JOIN trees USING (tree, level) WHERE len(nodes) > 1),
in_groups AS (SELECT id, place, subroot, below, proof FROM ways JOIN trees USING (tree, level) JOIN subroots USING (tree)
    WHERE len(nodes) = 1),
top_ways(id, level, pos, below, proof) AS (
    SELECT id, 0, place, below, proof FROM in_groups
    UNION ALL
    SELECT id, level + 1, pos // 8, sha256(array_to_string(nodes[pos // 8 * 8 + 1 : pos], '') || below
            || array_to_string(nodes[pos + 2 : pos // 8 * 8 + 8], '')),
        proof || array_to_string(nodes[pos // 8 * 8 + 1 : pos], '') || array_to_string(nodes[pos + 2 : pos // 8 * 8 + 8], '')
    FROM top_ways JOIN tops USING (level) WHERE len(nodes) > 1)
SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(top_ways.proof) AS proof_sha256, top_ways.below AS folded_root,
    top_ways.below = nodes[1] AS verified
FROM top_ways JOIN tops USING (level) JOIN in_groups USING (id) JOIN ranked USING (id) WHERE len(nodes) = 1
"""

_INTEGERS = """SELECT row_number() OVER () AS row, vec_id, {label}, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0"""

OP12_SQL = f"""
WITH rows AS ({_INTEGERS.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")}
    AND label IS NOT NULL),
scored AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
        CAST(list_dot_product(a.q, x.q) AS BIGINT) AS score
    FROM rows a JOIN rows x ON a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
    positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 3
"""

OP13_SQL = f"""
WITH rows AS ({_INTEGERS.format(label="label")}),
scored AS (SELECT a.vec_id AS query_id, x.vec_id, CAST(list_dot_product(a.q, x.q) AS BIGINT) AS score
    FROM rows a JOIN rows x ON a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

ORACLE_SQL = {"op5_line_dedup": OP5_SQL, "op6_prefix_filtered_decontamination": OP6_SQL,
              "op11_merkle_manifest": OP11_SQL, "op12_angular_hard_negatives": OP12_SQL,
              "op13_bit_sliced_top_k": OP13_SQL}
