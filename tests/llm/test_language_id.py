import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from ledgerprofile.llm import language_id as li
from ledgerprofile.llm import queries
from ledgerprofile.llm import textbytes as tb


def _plain_fold(raw):
    return li.folded(np.frombuffer(raw, np.uint8)).tobytes() if raw else b""


def _plain_counts(texts, order):
    counts = defaultdict(Counter)
    for text in texts:
        raw = bytes(order) + _plain_fold(text.encode())
        for k in range(order, len(raw)):
            for n in range(order + 1):
                counts[raw[k - n: k]][raw[k]] += 1
    return counts


def _plain_bits(counts, text, order):
    raw, bits = bytes(order) + _plain_fold(text.encode()), 0.0
    for k in range(order, len(raw)):
        for n in range(order, -1, -1):
            seen = counts.get(raw[k - n: k])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if raw[k] in seen:
                bits -= math.log2(seen[raw[k]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_exact_code_lengths():
    order = 3
    training = {"a": ["abracadabra", "ABBA Élan", ""], "b": ["banana bandana", "été"], "c": ["z"]}
    counts = {}
    for lang, texts in training.items():
        data, offsets = tb.flat(pa.array(texts))
        keys, n = np.unique(li.byte_keys(data, offsets, order), return_counts=True)
        counts[lang] = keys, n.astype(float)
    texts = ["abra", "", "banana été", "QUX 9\n", "z" * 30, "Élan ÉLAN élan"]
    want = [[_plain_bits(_plain_counts(training[lang], order), t, order) for lang in sorted(training)] for t in texts]
    for group in (1, 2, 3, 8):
        scorer = li.Scorer(li.fit(sorted(training), counts, order, group))
        scorer.step = 7                                   # texts reach over several steps
        got = scorer.code_lengths(*tb.flat(pa.array(texts)))
        assert np.allclose(got, want, atol=1e-9)


def _languages(n, size):
    """Training counts of ``n`` languages, each with words of its own."""
    counts = {}
    for k in range(n):
        rng = np.random.Generator(np.random.PCG64(k))
        words = ["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 8))) for _ in range(60)]
        data, offsets = tb.flat(pa.array([" ".join(rng.choice(words, size))]))
        keys, seen = np.unique(li.byte_keys(data, offsets, 4), return_counts=True)
        counts[f"l{k:03d}"] = keys, seen.astype(float), " ".join(rng.choice(words, 8))
    return counts


def test_two_hundred_languages():
    """The tables grow with the languages, not with their square, and each text finds its own."""
    counts = _languages(200, 300)
    trained = {lang: c[:2] for lang, c in counts.items()}
    sizes = {}
    for n in (100, 200):
        model = li.fit(sorted(trained)[:n], trained, 4)
        sizes[n] = sum(table.nbytes for g in model.groups for table in (*g.keys, *g.bits, *g.contexts, *g.escapes))
    assert sizes[200] < 2.1 * sizes[100]
    bits = li.Scorer(model).code_lengths(*tb.flat(pa.array([counts[lang][2] for lang in model.langs])))
    assert bits.argmin(axis=1).tolist() == list(range(200))


def test_held_out_accuracy(spark, sf01):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    rows = queries.op7_ppm_language(spark, sf01).collect()
    assert len(rows) == len(docs)
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert len(right) > 200 and sum(right) > 0.98 * len(right)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_fold_is_not_learned(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    import zlib
    for r in queries.op7_ppm_language(spark, sf01).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    spoiled = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz', lang) lang")
    assert "zz" not in li.train(spoiled.where(~queries.fold("doc_id", 4).isin(2))).langs


def test_odd_and_empty(odd):
    model = li.train(odd)
    assert model.langs == ["de", "en"]
    rows = li.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] in range(5, 24):
            assert r["lang_pred"] in ("de", "en")
    assert li.identify(odd.limit(0), model).collect() == []
    nothing = li.train(odd.limit(0))
    assert {r["lang_pred"] for r in li.identify(odd, nothing).collect()} == {"und"}


def test_a_language_of_identical_rows_is_learned(spark):
    """However its rows repeat, each language keeps its share of the sample."""
    from ledgerprofile.llm.columns import bounded_sample
    from pyspark.sql import functions as F
    for seed, text in enumerate(["the same words again", "one more text", "und", "a text of its own"]):
        rows = [(1, "en", text)] * 3000 + [(k, "de", f"ein Satz {k}") for k in range(3000)] + [(9, "fr", "peu")] * 3
        docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
        docs = docs.withColumn("shuffled", F.xxhash64(F.lit(seed), "doc_id", "text"))
        got = {r["lang"]: r["count"] for r in bounded_sample(docs, "lang", ["shuffled"], 100).groupBy("lang").count().collect()}
        assert got == {"en": 100, "de": 100, "fr": 3}
        lowest = docs.where("lang = 'de'").orderBy(F.shiftrightunsigned("shuffled", 1)).limit(100)
        kept = bounded_sample(docs, "lang", ["shuffled"], 100).where("lang = 'de'")
        assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in lowest.select("doc_id").collect()}
    model = li.train(docs)
    assert set(model.langs) == {"en", "de", "fr"}
