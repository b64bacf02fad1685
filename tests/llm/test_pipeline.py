import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerprofile.llm import queries
from tests.llm import brute


def test_stages_against_plain_versions(spark, sf01, tmp_path):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    columns = docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in queries.op4_crf_toxicity(spark, sf01).collect()}
    want = [tuple(r) for r in docs.select("doc_id", "text").collect() if not scores[r["doc_id"]]]
    items = [tuple(r) for r in spark.read.parquet(f"{sf01}/benchmark.parquet").select("item_id", "text").collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf01).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        if name == "line_dedup":
            want = [(i, t) for i, _, _, t in brute.line_dedup(want)]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name == "near_duplicates":
            parts = brute.components(want, 5)
            want = [(i, t) for i, t in want if parts[i][1] == i]
        elif name == "decontamination":
            found = brute.passages(want, items)
            want = [(i, t) for i, t in want if not found[i][-1]]
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(want), name
    pieces = docs.orderBy("doc_id", "start").collect()
    ids = {}
    for r in pieces:
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in want}
    run = corpus_pipeline.run(spark, sf01)
    assert run.columns == docs.columns and run.count() == len(pieces)


def test_odd_and_empty(spark, odd, sf01, tmp_path):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd, sf01)
        rows = out.collect()
        if name != "packing":
            assert out.columns == odd.columns and out.schema.simpleString() == odd.schema.simpleString()
        # six of the texts 10..16 and three of the copies 20..23 are near duplicates
        assert len(rows) >= odd.count() - (9 if name == "near_duplicates" else 0)
        assert stage(spark, odd.limit(0), sf01).collect() == []
