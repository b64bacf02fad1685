import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from ledgerprofile.llm import queries, token_counts
from ledgerprofile.llm import textbytes as tb

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(MODEL)


def _counts(machine, texts):
    data, offsets = tb.flat(pa.array(texts, pa.string()))
    return machine.counts(data, offsets).tolist()


def test_odd_texts(machine, library):
    rng = random.Random(3)
    texts = ["", None, " ", "  ", "a" * 700, "▁▁ ▁", "\n\n\t x", "日本語テキスト" * 50, "🙂🙂a🙂", "é́é", "<s></s><0x0A>",
             "x" * 3000 + " " * 2000 + "y", " " * 777, "aaaab" * 100, "0123456789" * 40, "\x00a\x00", "�", "ab▁cd"]
    alphabet = "ab c▁\néя日1.,' the ing tion\t🙂"
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 600))) for _ in range(200)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 200))).replace("▁", " ") for _ in range(200)]
    texts += ["".join(rng.choice(pieces[:3000]).strip("▁") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    assert _counts(machine, texts) == [len(library.encode(t or "")) for t in texts]


def test_chunks_and_forgetting_change_nothing(machine, library, monkeypatch):
    texts = ["the quick brown fox " * 40, "supercalifragilistic" * 60, " " * 900 + "end", "日本" * 300]
    want = [len(library.encode(t)) for t in texts]
    for chunk in (1, 3, 64, 5000):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        assert _counts(machine, texts) == want
    monkeypatch.setattr(token_counts, "MAX_STATES", 1)
    assert _counts(machine, texts) == want and _counts(machine, texts[:1]) == want[:1]


def test_long_runs_without_a_boundary(machine, library):
    """A megabyte of one character, and long texts whose pieces overlap everywhere: composed, not serial."""
    rng = random.Random(5)
    pieces = [p for p in (library.id_to_piece(i) for i in range(259, 6000)) if p.isalpha() and p.isascii() and p.islower()]
    texts = ["a" * 1_000_000, " " * 1_000_000, "-" * 300_000, "ab" * 200_000, "=-" * 5000,
             "".join(rng.choice("aeinorst") for _ in range(60_000)), "".join(rng.choice(pieces) for _ in range(20_000))]
    for text in texts:
        begun = time.process_time()
        assert _counts(machine, [text, "the end", text[:777]]) == [len(library.encode(t)) for t in (text, "the end", text[:777])]
        assert time.process_time() - begun < 20


def test_maps_are_composed(machine, library, monkeypatch):
    """Small chunks, pieces of few maps and no speculation give the same counts."""
    texts = ["aaaa" * 400 + "b" + "a" * 333, " " * 555, "anentionsation" * 60, "0" * 99 + "x"]
    want = [len(library.encode(t)) for t in texts]
    for chunk, held, rounds in ((8, 1, 0), (16, 1 << 22, 1), (5, 200, 4)):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        monkeypatch.setattr(token_counts, "COMPOSED", held)
        monkeypatch.setattr(token_counts, "SPECULATED", rounds)
        assert _counts(machine, texts) == want


def test_query(spark, sf01, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    rows = queries.op9_transducer_token_counts(spark, sf01).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 4096)


def test_odd_and_empty(odd, odd_rows, library):
    got = sorted((repr(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(odd, MODEL).collect())
    assert got == sorted((repr(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in odd_rows)
    assert token_counts.token_counts(odd.limit(0), MODEL).collect() == []
