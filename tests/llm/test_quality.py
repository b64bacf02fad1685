import numpy as np

from ledgerprofile.llm import quality as ql
from ledgerprofile.llm import queries


def test_em_recovers_detection_rates():
    rng = np.random.default_rng(6)
    k, n = len(ql.LABELLERS), 40_000
    good = rng.random(n) < 0.8
    finds = rng.uniform(0.2, 0.6, k)
    fires = np.where(good[:, None], rng.random((n, k)) < 0.001, rng.random((n, k)) < finds)
    votes = np.where(rng.random((n, k)) < 0.1, ql.ABSTAIN, np.where(fires, ql.BAD, ql.GOOD)).astype(np.int8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = ql.fit_labels(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02
    assert np.abs((1 - model.table[:, ql.BAD]) - finds).max() < 0.05
    accuracy = np.where(good[:, None], ~fires, fires).mean(axis=0)
    assert np.abs(np.array(list(model.accuracies.values())) - accuracy).max() < 0.03


def test_against_the_labels(spark, sf01):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    rows = queries.op3_weak_label_quality(spark, sf01).collect()
    assert len(rows) == spark.read.parquet(f"{sf01}/documents.parquet").count()
    kept = [r["keep"] for r in rows if labels.get(r["doc_id"]) == 1]
    bad = [r["keep"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert np.mean(kept) > 0.97 and np.mean(bad) < 0.1
    assert all(r["keep"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_statistics():
    texts = ["One two, two two.", "", "A\nA\nb | |", "ÉTÉ été"]
    import pyarrow as pa

    from ledgerprofile.llm import textbytes as tb
    s = ql.statistics(*tb.flat(pa.array(texts)))
    assert s["words"].tolist() == [4, 0, 5, 2]
    assert np.allclose(s["stutter_share"], [0, 0, 0.4, 0])
    assert np.allclose(s["bare_symbol_share"], [0, 0, 0.4, 0])
    assert np.allclose(s["repeated_line_share"], [0, 0, 1 / 3, 0])
    assert s["capital_share"][3] > 0.4 and s["mark_share"][0] == 0.5


def test_odd_and_empty(odd):
    scores, model = ql.quality_scores(odd)
    rows = scores.collect()
    assert len(rows) == odd.count() and model is not None
    assert all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in rows)
    assert len({r["votes"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    scores, model = ql.quality_scores(odd.limit(0))
    assert scores.collect() == [] and model is None
