import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ledgerprofile.llm import queries
from ledgerprofile.llm.fingerprints import compare_neighbours, edited_spans, likeness, merkle_tree, splice_half

TEXT = st.text(alphabet="ab é\n\U0001f642", max_size=300)


@given(TEXT, TEXT)
@settings(max_examples=150, deadline=None)
def test_roots_and_likeness(a, b):
    x, y = merkle_tree(a), merkle_tree(b)
    assert (x.root == y.root) == (a == b)
    assert 0.0 <= likeness(x, y) <= 1.0 and likeness(x, x) == 1.0 and likeness(x, y) == likeness(y, x)
    assert x.piece_ends[-1] == len(a.encode()) and x.section_first[-1] == len(x.paragraphs)
    assert x.paragraph_first[-1] == len(x.pieces)
    assert (edited_spans(x, y) == []) or a != b


def test_edit_is_located():
    lines = [f"paragraph {k} says some words about thing number {k * k}" for k in range(200)]
    changed = [*lines[:120], "an entirely new paragraph", *lines[121:]]
    a, b = merkle_tree("\n".join(lines)), merkle_tree("\n".join(changed))
    at = len("\n".join(lines[:120]))
    spans = edited_spans(a, b)
    assert likeness(a, b) > 0.98 and spans and all(at <= lo <= hi <= at + 70 for lo, hi in spans)
    assert len(merkle_tree("x" * 5000).pieces) > 50


def test_query_against_plain_edit(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in queries.op2_merkle_fingerprints(spark, sf001).collect()}
    assert len(got) == len(rows)
    near = 0
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert edited == splice_half(text, following)
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == merkle_tree(text).fingerprint
        assert r["edited_fingerprint"] == merkle_tree(edited).fingerprint
        assert r["near_edited"] == likeness(merkle_tree(text), merkle_tree(edited))
        assert r["near_next"] == likeness(merkle_tree(text), merkle_tree(following))
        near += r["near_edited"] > r["near_next"]
    assert near > 0.95 * len(rows)
    texts = {t: got[i]["fingerprint"] for i, t in rows}
    assert len(set(texts.values())) == len(texts)


def test_many_rows_without_an_id(spark):
    """A third of the ids is null, a third is one id: neither is one block, and no pair is lost."""
    n = 900
    rows = [(None if k % 3 == 0 else -5 if k % 3 == 1 else k, f"text {k} of some words\nline {k * k}") for k in range(n)]
    rows += [(7, "a repeated row")] * 40 + [(-(1 << 63), "the least id"), ((1 << 63) - 1, "the largest id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = sorted(keyed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    want = sorted((repr(r["doc_id"]), merkle_tree(r["text"]).fingerprint,
                   merkle_tree(splice_half(r["text"], after["text"])).fingerprint)
                  for r, after in zip(order, [*order[1:], order[0]]))
    for blocks in (1, 2, 12):
        got = compare_neighbours(docs, n_blocks=blocks)
        assert sorted((repr(r["doc_id"]), r["fingerprint"], r["edited_fingerprint"]) for r in got.collect()) == want
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < n / 4


def test_odd_and_empty(odd):
    rows = compare_neighbours(odd, n_blocks=5).collect()
    assert len(rows) == odd.count()
    no_id = [r for r in rows if r["doc_id"] is None]
    assert sorted(r["n_chars"] for r in no_id) == [0, 10]
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in range(20, 24)}) == 1
    single = compare_neighbours(odd.where("doc_id = 5")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0
    assert compare_neighbours(odd.limit(0)).collect() == []
