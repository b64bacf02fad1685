import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerprofile.llm import packing, queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_librarys_ids(library):
    rng = random.Random(3)
    alphabet = "ab c \néя日1.,' the ing's tion\t🙂ΣAΑΣ   　̸́<|endoftext|>ÀÉßÿ×÷!"
    texts = ["", "  ", "\n", "<|endoftext|> x", "a<|startoftext|>b", "Σ ΑΣ", "don't 're x 's", "é é ́x", "≠ ̸", "x" * 5000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(500)]
    encode = packing.WordEncoder(VOCABULARY, table_bytes=50 * 200)
    assert [ids.tolist() for ids in encode(texts)] == [library(t) for t in texts]


def test_table_is_bounded_in_bytes(library):
    """Texts without spaces leave nothing behind; short words are forgotten beyond the bound."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789+/日本語"
    encode = packing.WordEncoder(VOCABULARY, table_bytes=200_000)
    runs = ["".join(rng.choice(letters) for _ in range(20_000)) for _ in range(20)]
    for text, ids in zip(runs, encode(runs)):
        assert ids.tolist() == library(text)
        assert len(encode.index) == 1 and encode.held == 0 and encode.ids.nbytes <= 1 << 19
    most = 0
    mixed = [" ".join("".join(rng.choice(letters) for _ in range(rng.choice([3, 9, 64, 65, 300]))) for _ in range(100))
             + " again Again! " + "x" * 70 for _ in range(60)]
    for text, ids in zip(mixed, encode(mixed)):
        assert ids.tolist() == library(text)
        assert max(map(len, encode.index)) <= packing.KEPT_CHARS
        most = max(most, encode.held)
    assert 200_000 < most < 260_000                       # one text beyond the bound at most


def _plain_level(levels, size, window):
    """Level with the least growth of the sum of squares; of equal ones the fullest."""
    best = None
    for h in range(window - size + 1):
        if h and not levels[h]:
            continue
        after = levels.copy()
        if h:
            after[h] -= 1
        if h + size < window:
            after[h + size] += 1
        cost = int((after[1:window] ** 2).sum())
        if best is None or cost <= best[0]:
            best = cost, h
    return best[1]


def test_levels_follow_the_sum_of_squares():
    rng = random.Random(5)
    packer = packing.SumOfSquaresPacker(16)
    for k in range(3000):
        size = rng.randint(1, 40)
        rest = size % 16
        if rest:
            assert packer.level_for(rest) == _plain_level(packer.levels, rest, 16)
        list(packer.add(k, np.zeros(size, np.uint32)))
        assert packer.levels.sum() == sum(map(len, packer.open.values()))


def _check(pieces, want, window):
    """Pieces of (key, start, ids, total, sequence, offset) hold each id once; windows are gapless."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for key, start, ids, total, sequence, offset in pieces:
        by_doc[key].append((start, list(ids), total))
        by_window[sequence].append((offset, len(ids)))
    assert {k: [x for _, ids, _ in sorted(v, key=lambda p: p[0]) for x in ids] for k, v in by_doc.items()} == want
    for k, v in by_doc.items():
        at = 0
        for start, ids, total in sorted(v, key=lambda p: p[0]):
            assert start == at and ids and total == len(want[k])
            at += len(ids)
    fills = []
    for v in by_window.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= window
        fills.append(at)
    return fills


def test_one_padded_window_a_block():
    rng = random.Random(9)
    for n in (0, 1, 2, 7, 400):
        packer, want, pieces = packing.SumOfSquaresPacker(32), {}, []
        for k in range(n):
            ids = np.array([rng.randint(0, 9) for _ in range(rng.choice([1, 3, 20, 31, 32, 33, 200]))], np.uint32)
            want[k] = ids.tolist()
            pieces += packer.add(k, ids)
        pieces += packer.finish()
        fills = _check(pieces, want, 32)
        assert sum(f < 32 for f in fills) <= 1
        assert len(fills) == -(-sum(map(len, want.values())) // 32)


def test_query(spark, sf01, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    want = {i: [*library(t), 2] for i, t in docs.items()}
    rows = queries.op8_sum_of_squares_packing(spark, sf01).collect()
    pieces = []
    for r in rows:
        ids = want[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["length"] == len(ids)
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        pieces.append((r["doc_id"], r["start"], ids, r["doc_tokens"], r["sequence_id"], r["offset"]))
    fills = _check(pieces, want, 4096)
    blocks = len({r["sequence_id"] >> packing.BLOCK_BITS for r in rows})
    assert sum(f < 4096 for f in fills) <= blocks


def test_odd_and_empty(odd, odd_rows, library):
    rows = packing.pack(odd, VOCABULARY).collect()
    got = sorted((repr(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows
                 if r["doc_id"] != 5)
    assert got == sorted((repr(r[0]), [*library(r[1]), 2]) for r in odd_rows if r[0] != 5)
    long = [r for r in rows if r["doc_id"] == 5]
    assert sum(len(r["ids"]) // 4 for r in long) == long[0]["doc_tokens"] == len(library(odd_rows[4][1])) + 1
    assert packing.pack(odd.limit(0), VOCABULARY).collect() == []


def test_a_new_word_does_not_look_up_the_known_ones_again():
    class Counted(dict):
        n = 0

        def __getitem__(self, word):
            self.n += 1
            return super().__getitem__(word)

    encode = packing.WordEncoder(VOCABULARY)
    text = "eins zwei, drei " * 1000
    before = list(encode([text]))[0]
    encode.index = Counted(encode.index)
    after = list(encode([text + "neuneu Neuneu, neuneu"]))[0]
    assert encode.index.n <= 3 and (after[: len(before)] == before).all()
    assert after.tolist() == encode.tokenizer.encode(text + "neuneu Neuneu, neuneu", add_special_tokens=False).ids
