import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerprofile.llm import hard_negatives as hn
from ledgerprofile.llm import queries, topk, vectors

NAN, INF = float("nan"), float("inf")
SCHEMA = ("vec_id long, label int, embedding array<double>, block int, slot int, no long, score long, q string, norm int, "
          "place int, attribute string")


def integers(rows):
    """(id, label, q) of the rows with an id and a finite vector."""
    out = []
    for i, label, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, label, [math.floor(256 * x) for x in v]))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def plain_top(rows, is_query, k):
    rows = integers(rows)
    out = []
    for i, q in sorted({(i, tuple(q)) for i, _, q in rows if is_query(i)}):
        best = sorted((-dot(q, x), j) for j, _, x in rows if j != i)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def plain_negatives(rows, is_anchor, m=hn.Mining()):
    rows = [r for r in integers(rows) if r[1] is not None]
    out = []
    for i, label, q in sorted({(i, label, tuple(q)) for i, label, q in rows if is_anchor(i)}):
        scored = sorted((-dot(q, x), j, other == label) for j, other, x in rows if j != i)
        for p, j, same in [x for x in scored if x[2]][:m.positives]:
            wanted = [(-s, n) for s, n, own in scored if not own and m.low * -p <= 100 * -s <= m.high * -p][:m.negatives]
            out += [(i, j, r, n, -p, s) for r, (s, n) in enumerate(wanted, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([r + (None,) * 8 for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_vectors():
    """Nulls, non-finite numbers, zeros, ragged vectors, ties, repeated rows and ids, a hot vector."""
    rng = random.Random(3)

    def unit():
        v = [rng.gauss(0, 1) for _ in range(12)]
        return [x / math.hypot(*v) for x in v]
    rows = [(0, 1, unit()), (0, 1, None), (None, 1, unit()), (10, None, unit()), (20, 2, [NAN] + unit()[1:]),
            (30, 2, [INF] + unit()[1:]), (40, 2, [None] + unit()[1:]), (50, 3, [0.0] * 12), (60, 3, []), (70, 3, unit()[:5]),
            (80, 4, unit() + [0.5, -0.5]), (90, 4, [-1000.25, 2000.5] + [0.0] * 10)]
    hot, copy = unit(), unit()
    rows += [(k, k % 3, hot) for k in range(100, 200)]
    rows += [(200, 5, copy), (200, 5, copy), (200, 6, copy), (210, 5, copy)]
    centre = unit()
    rows += [(k, rng.randrange(4), [x + rng.gauss(0, .05) for x in centre]) for k in range(300, 420)]
    rows += [(k, rng.randrange(4), unit()) for k in range(500, 640)]
    return rows


def test_bitmap_sums():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 200, (90, 5))
    bitmaps = [[] for _ in range(8)]
    for d in range(5):
        for b in range(8):
            bits = np.zeros(16, np.uint8)
            packed = np.packbits((values[:, d] >> b & 1).astype(np.uint8), bitorder="little")
            bits[: len(packed)] = packed
            bitmaps[b].append(bits.view(np.uint64))
    sums = topk.added(bitmaps, 2)
    read = [sum(int(s[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << j for j, s in enumerate(sums)) for r in range(90)]
    assert read == values.sum(axis=1).tolist()


@pytest.mark.parametrize("dropped", [0, 2, 5, 40])
def test_descent_and_boundary(dropped):
    """Every k, with ties, against sorting; the slack covers what the dropped slices hold."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.integers(-90, 90, (70, 6)), np.repeat(rng.integers(-90, 90, (1, 6)), 70, axis=0)])
    ids = rng.permutation(140)
    table = pa.Table.from_batches(list(topk._index_rows(iter([pa.RecordBatch.from_pydict(
        {"block": pa.array([3] * 140, pa.int32()), "vec_id": ids, "q": pa.array(values.tolist(), pa.list_(pa.int64()))})]))))
    block = topk.Block(table)
    assert block.values(np.arange(140)).tolist() == values[np.argsort(ids)].tolist()
    for weights in (values[0], values[-1], -values[3], np.zeros(6, np.int64)):
        scores = values @ weights
        for k in (1, 5, 71, 139, 500):
            order = [r for r in np.lexsort((ids, -scores)) if ids[r] != ids[0]][:k]
            got = topk.best_rows(block, weights, int(ids[0]), k, dropped)
            assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == scores[order].tolist()


def test_angles_bound_the_scores():
    rng = np.random.default_rng(9)
    rows = rng.integers(-300, 300, (400, 8))
    rows[50:200] = rows[0] + rng.integers(-2, 3, (150, 8))
    rows[200:210] = -rows[0]
    rows[210:215] = 0
    directions = hn.reference_directions(rows[::3].astype(float), 6)
    assert np.allclose(np.linalg.norm(directions, axis=1), 1)
    norms, angles = hn.angles_to(rows, directions)
    angles = angles.T
    for a in (0, 3, 100, 205, 212):
        lo, hi = hn.score_bounds(norms[a], angles[:, a], norms, angles)
        score = rows @ rows[a]
        assert (lo <= score).all() and (score <= hi).all()
    lo, hi = hn.score_bounds(norms[0], angles[:, 0], norms, angles)
    assert (hi[215:] < hi[50:200].min()).mean() > 0.5               # a cluster is told apart from the rest
    assert len(hn.reference_directions(np.ones((9, 4)), 3)) == 1     # copies give one direction
    assert hn.reference_directions(np.zeros((2, 4)), 3).shape == (0, 4)


def test_only_rows_within_reach_are_scored():
    """Rows whose interval misses the window get no integer score."""
    rng = np.random.default_rng(1)
    near = np.array([400, 0, 0, 0]) + rng.integers(-3, 4, (600, 4))
    rows = np.concatenate([near, rng.integers(-300, 300, (2000, 4))])
    norms, angles = hn.angles_to(rows, hn.reference_directions(rows[::7].astype(float), 12))
    block = hn.Block(pa.table({"vec_id": np.arange(len(rows)), "label": np.zeros(len(rows), np.int64),
                               "q": pa.array(rows.tolist(), pa.list_(pa.int64())), "norm": norms,
                               "angles": pa.array(list(angles), pa.list_(pa.float32()))}))
    anchor = (0, 0, 0, rows[0], norms[0], angles[0])
    want = np.lexsort((np.arange(len(rows)), -(rows @ rows[0])))
    search = hn.Search(block, anchor, np.arange(len(rows)) != 0)
    ids, _ = search.best(5)
    assert ids == [r for r in want if r][:5] and search.scored.mean() < 0.5
    window = (50_000, 60_000)
    search = hn.Search(block, anchor, np.ones(len(rows), bool))
    ids, got = search.best(4, window)
    inside = [r for r in want if window[0] <= rows[r] @ rows[0] <= window[1]][:4]
    assert ids == inside and got == (rows[inside] @ rows[0]).tolist()
    done = search.scored
    assert done.any() and (search.hi[done] >= window[0]).all() and (search.lo[done] <= window[1]).all()


def test_large_products():
    rows = np.array([[(1 << 30), 5], [-(1 << 30), 7]])
    assert vectors.products(rows, rows[0]).tolist() == [(1 << 60) + 25, -(1 << 60) + 35]
    with pytest.raises(OverflowError):
        vectors.products(np.array([[1 << 31] * 4]), np.array([1 << 31] * 4))


def test_top_k_of_odd_rows(spark, odd_vectors):
    docs = frame(spark, odd_vectors)
    want = plain_top(odd_vectors, lambda i: i % 10 == 0, 5)
    for sizes in ({}, {"block_rows": 64, "slot_rows": 7}):
        got = topk.exact_top_k(docs, F.col("vec_id") % 10 == 0, 5, **sizes).collect()
        assert sorted(tuple(r) for r in got) == want
    assert topk.exact_top_k(docs.limit(0), F.lit(True)).collect() == []
    assert topk.exact_top_k(docs, F.col("vec_id") == -1).collect() == []
    assert [tuple(r) for r in topk.exact_top_k(docs.where("vec_id in (50, 90)"), F.col("vec_id") == 50).collect()] == [(50, 1, 90, 0)]
    with pytest.raises(Exception, match="component too large"):
        topk.exact_top_k(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_negatives_of_odd_rows(spark, odd_vectors):
    docs = frame(spark, odd_vectors)
    want = plain_negatives(odd_vectors, lambda i: i % 10 == 0)
    assert len(want) > 100
    for sizes in ({}, {"block_rows": 64, "slot_rows": 7, "references": 3}):
        got = hn.hard_negatives(docs, F.col("vec_id") % 10 == 0, **sizes).collect()
        assert sorted(tuple(r) for r in got) == want
    assert hn.hard_negatives(docs.limit(0), F.lit(True)).collect() == []
    assert hn.hard_negatives(docs, F.col("vec_id") == 30).collect() == []


def test_queries_against_plain_versions(spark, sf01):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf01}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    is_query = lambda i: i % 50 == 0
    assert sorted(tuple(r) for r in queries.op13_bit_sliced_top_k(spark, sf01).collect()) == plain_top(rows, is_query, 5)
    changed = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    got = sorted(tuple(r) for r in queries.op12_angular_hard_negatives(spark, sf01).collect())
    assert got == plain_negatives(changed, is_query)
    assert len({x[:3] for x in got}) == len(got) and all(len(list(g)) <= 3 for _, g in itertools.groupby(got, lambda x: x[:2]))
