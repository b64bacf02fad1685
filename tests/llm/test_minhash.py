import random

import numpy as np
import pyarrow as pa

from ledgerprofile.llm import minhash as mh
from ledgerprofile.llm import queries
from ledgerprofile.llm.components import connected_components
from tests.llm import brute


def test_coordinates_are_circular_shifts():
    p = mh.MinHash(bands=4, rows=3, universe_bits=8)
    first, second = mh.permutations(p)
    shingles = np.random.default_rng(1).integers(0, 1 << 63, 40, np.uint64)
    places = first[(shingles >> np.uint64(56)).astype(int)]
    want = [min(second[(v + k) % 256] for v in places) for k in range(12)]
    assert mh.signature(shingles, p).tolist() == want
    assert sorted(first) == list(range(256)) and sorted(second[:256]) == list(range(256))


def test_sets_are_the_shingles():
    texts = ["A b c a b", "one", "", None, "é É x\x0by", "a b c"]
    for width in (2, 5):
        sizes = [len(s) for s in mh.shingle_sets(pa.array(texts), width)]
        assert sizes == [len(brute.shingles(t, width)) for t in texts]


def test_components(spark):
    rng = random.Random(4)
    chain = [(f"{k:03d}", f"{k + 1:03d}") for k in range(60)]
    star = [("x", f"y{k}") for k in range(200)]
    pairs = chain + star + [("p", "q"), ("q", "p"), ("r", "r")]
    rng.shuffle(pairs)
    got = dict(connected_components(spark.createDataFrame(pairs, "a string, b string")).collect())
    want = {f"{k:03d}": "000" for k in range(61)} | {f"y{k}": "x" for k in range(200)} | {"x": "x", "p": "p", "q": "p"}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_against_all_pairs(spark, sf01):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.components(rows, 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_circulant_minhash(spark, sf01).collect()}
    assert got == want


def test_family_near_the_threshold(spark):
    """Edited copies of one text, many of them just under or over 0.8, beside chains of edits."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows, chain = [], list(base)
    for k in range(250):
        words = list(base)
        for _ in range(rng.randint(3, 14)):
            words[rng.randrange(120)] = f"w{rng.randint(0, 60)}"
        rows.append((k, " ".join(words)))
    for k in range(250, 300):
        chain[rng.randrange(120)] = f"c{k}"
        rows.append((k, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (2, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in mh.near_duplicates(docs, mh.MinHash(width=width)).collect()}
        want = brute.components(rows, width)
        assert got == want and len({c for _, c in want.values()}) > 1


def test_intersections_and_spanning_links():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)]
    got = mh.intersections(pa.chunked_array([pa.array(sets[:15]), pa.array(sets[15:])]))
    for a in range(40):
        for b in range(40):
            want = len(np.intersect1d(sets[a], sets[b]))
            assert got[a, b] == want or a == b
    linked = np.triu(rng.random((30, 30)) < 0.06, 1)
    linked |= linked.T
    links = mh.spanning(linked)
    assert all(linked[a, b] for a, b in links)

    def groups(pairs):
        root = list(range(30))
        for a, b in list(pairs) * 30:
            root[a] = root[b] = min(root[a], root[b])
        return root
    assert groups(links) == groups(zip(*np.nonzero(linked))) and len(links) == 30 - len(set(groups(links)))
    assert mh.spanning(np.zeros((3, 3), bool)) == []


def _family(m, edits, seed=6):
    """Copies of a 200-word text with ``edits`` edits each: every two just below or over 0.8."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    rows = []
    for k in range(m):
        words = list(base)
        for at in rng.sample(range(200), edits):
            words[at] = f"x{k}y{at}"
        rows.append((k, " ".join(words)))
    return rows


def test_a_family_below_the_threshold_makes_no_pairs(spark, monkeypatch):
    """Rows grow with the members, not with their square; chunks of 64 members give the same result."""
    rows_made = {}
    plain = mh.Scratch.store

    def counted(self, df, *args):
        out = plain(self, df, *args)
        rows_made.setdefault(tuple(df.columns), []).append(out.count())
        return out
    monkeypatch.setattr(mh.Scratch, "store", counted)
    monkeypatch.setattr(mh, "TILE_MEMBERS", 128)
    made = {}
    for m in (150, 300):
        rows = _family(m, 6)
        rows_made.clear()
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), mh.MinHash(width=2)).collect()}
        assert got == brute.components(rows, 2)
        made[m] = max(sum(rows_made[("a", "b")]), sum(rows_made[("bucket", "node")]))
    assert made[300] <= 2.6 * made[150]


def test_odd_and_empty(odd):
    rows = mh.near_duplicates(odd, mh.MinHash(width=2)).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3, 4):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert {by_id[i]["component_id"] for i in range(20, 24)} == {20}
    assert [by_id[i]["kept"] for i in range(20, 24)] == [True, False, False, False]
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert sum(r["doc_id"] == 6 and r["kept"] for r in rows) == 2
    assert mh.near_duplicates(odd.limit(0), mh.MinHash()).collect() == []
