import itertools
import zlib

import numpy as np
import pytest

from ledgerprofile.llm import queries
from ledgerprofile.llm import toxicity as tx


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    pos = labels == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("lane", [1, 2, 5, 256])
def test_marginals_against_all_taggings(lane, monkeypatch):
    monkeypatch.setattr(tx, "LANE", lane)
    rng = np.random.default_rng(lane)
    model = tx.Crf(np.zeros(1), start=0.4, links=rng.normal(size=(2, 2)))
    sizes = [4, 1, 6, 3]
    begins = np.zeros(sum(sizes), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    odds = np.exp(rng.normal(size=sum(sizes)))
    f, q = tx.forward_backward(model, odds, begins)
    got, at = f * q / (1 + f * q), 0
    for n in sizes:
        total, toxic = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            w = np.exp(model.start * tags[0]) * np.prod(odds[at: at + n] ** tags)
            w *= np.exp(sum(model.links[a, b] for a, b in zip(tags, tags[1:])))
            total += w
            toxic += w * np.array(tags)
        assert np.allclose(got[at: at + n], toxic / total)
        at += n


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op4_crf_toxicity(spark, sf).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    scores, truth, predicted = (np.array(x) for x in zip(*held))
    # in this table about a sixth of the documents labelled toxic are junk without any telling word
    assert _auc(scores, truth) > 0.93
    assert (predicted[truth == 0] == 1).mean() < 0.01 and (predicted[truth == 1] == 1).mean() > 0.75


def test_spans_locate_the_words():
    rng = np.random.default_rng(2)
    words = [f"wort{k}" for k in range(300)] + ["été"]
    texts, toxic = [], []
    for k in range(400):
        own = list(rng.choice(words, 30))
        if k % 4 == 0:
            own[int(rng.integers(30))] = rng.choice(["Vile", "nastyone", "nastier"])
        texts.append(" ".join(own))
        toxic.append(int(k % 4 == 0))
    model = tx.fit(texts, np.array(toxic))
    tagger = tx.Tagger(model)
    text = "été été wort1, VILE! wort2 wort3 nastyone"
    scores, spans = tagger(*_flat([text, "été wort1 wort2", ""]))
    assert [text[s["start"]: s["end"]] for s in spans[0]] == ["VILE", "nastyone"]
    assert spans[1] == spans[2] == [] and scores[0] > 0.7 > max(scores[1], scores[2])


def _flat(texts):
    import pyarrow as pa

    from ledgerprofile.llm import textbytes as tb
    return tb.flat(pa.array(texts))


def test_odd_and_empty(spark, odd):
    labels = spark.createDataFrame([(10, 0, 0), (5, 1, 1), (None, 1, 1), (20, None, None), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = tx.train(odd, labels)
    rows = odd.select("doc_id", tx.score_column(odd, model).alias("t")).collect()
    assert len(rows) == odd.count() and all(0 <= r["t"]["score"] <= 1 for r in rows)
    empty = {r["t"]["score"] for r in rows if r["doc_id"] in (1, 2, 3, 4)}
    assert len(empty) == 1
    assert tx.train(odd, labels.limit(0)) is None
    assert {r["t"]["score"] for r in odd.select(tx.score_column(odd, None).alias("t")).collect()} == {0.0}
    assert odd.limit(0).select(tx.score_column(odd, model).alias("t")).collect() == []


def test_the_sample_is_fitted_in_a_task(spark, monkeypatch):
    """Neither texts nor the fit's arrays come to the driver; the model is that of a fit on the same texts."""
    from pyspark.sql import DataFrame
    rows = [(i, f"schönes haus nummer {i % 7}" + (" blödmann zorgelt" if i % 3 == 0 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    sample = tx.labelled_sample(docs, labels).collect()

    def refused(self):
        raise AssertionError("brought to the driver")
    monkeypatch.setattr(DataFrame, "toArrow", refused)
    model = tx.train(docs, labels)
    want = tx.fit([r.text for r in sample], np.array([r.toxic for r in sample]))
    assert np.allclose(model.emission, want.emission, atol=1e-6) and np.allclose(model.curve, want.curve, atol=1e-4)
    assert tx.train(docs, labels.where("toxic = 1")) is None
    assert tx.train(docs, labels.where("toxic = 5")) is None
