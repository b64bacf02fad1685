import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerprofile.operators import graph, spectral


ITERATED = 0        # local_nodes: no industry is solved in one task


@pytest.fixture(params=[graph.LOCAL_NODES, ITERATED], ids=["local", "iterated"])
def local_nodes(request):
    return request.param


def _pairs(spark, edges, hy="H1"):
    return spark.createDataFrame([(hy, a, b, float(w)) for a, b, w in edges],
                                 "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, zje double")


def _adj(spark, edges, hy="H1"):
    return graph.adjacency(graph.symmetric_edges(_pairs(spark, edges, hy)))


def _numpy_centrality(edges):
    """(centrality, vector, adjacency, nodes) from a full eigendecomposition; of several leading
    vectors the projection of the uniform one."""
    nodes = sorted({a for a, _, _ in edges} | {b for _, b, _ in edges})
    idx = {n: i for i, n in enumerate(nodes)}
    a = np.zeros((len(nodes), len(nodes)))
    for x, y, w in edges:
        a[idx[x], idx[y]] += w
        a[idx[y], idx[x]] += w
    values, vectors = np.linalg.eigh(a)
    top = vectors[:, values > values.max() - 1e-9]
    v = top @ (top.T @ np.ones(len(nodes)))
    v /= np.linalg.norm(v)
    c = np.abs(a) @ np.abs(v)
    return {n: c[idx[n]] for n in nodes}, {n: v[idx[n]] for n in nodes}, a, nodes


def test_symmetric_edges_and_adjacency(spark):
    p = _pairs(spark, [("A", "B", 1.0), ("B", "A", 2.0), ("C", "C", 3.0)])
    sym = graph.symmetric_edges(p)
    assert sym.count() == 6
    adj = {(r.xf_nsrsbh, r.gf_nsrsbh): r.w for r in graph.adjacency(sym).collect()}
    assert adj == {("A", "B"): 3.0, ("B", "A"): 3.0, ("C", "C"): 6.0}     # self-loop twice


def test_degree_and_nodes(spark):
    adj = _adj(spark, [("A", "B", 5.0), ("A", "C", 0.4), ("A", "A", 9.0), ("D", "B", 1.0)])
    deg = {r.nsrsbh: r.degree for r in graph.degree(adj).collect()}
    assert deg == {"A": 1, "B": 2, "C": 0, "D": 1}      # |w| < 1 and self-loops do not count
    sym = graph.symmetric_edges(_pairs(spark, [("A", "B", 5.0), ("A", "C", 0.4)]))
    assert sorted(r.nsrsbh for r in graph.nodes(sym).collect()) == ["A", "B", "C"]
    assert graph.node_counts(sym).first().n_nodes == 3


RING6 = [("A", "B", 3.0), ("B", "C", 1.0), ("C", "D", 2.0), ("D", "E", 5.0), ("E", "F", 1.0),
         ("F", "A", 4.0), ("A", "C", 2.0), ("B", "B", 1.5)]


def test_centrality_matches_numpy(spark, local_nodes):
    c = {r.nsrsbh: r.centrality for r in graph.eigenvector_centrality(_adj(spark, RING6), local_nodes=local_nodes).collect()}
    want, _, _, _ = _numpy_centrality(RING6)
    assert c.keys() == want.keys()
    for k in want:
        assert c[k] == pytest.approx(want[k], rel=1e-7)


def test_eigenvector_converges_to_leading(spark, local_nodes):
    v = {r.nsrsbh: r.v for r in graph.leading_eigenvector(_adj(spark, RING6), local_nodes=local_nodes).collect()}
    _, _, a, nodes = _numpy_centrality(RING6)
    vals, vecs = np.linalg.eigh(a)
    lead = np.abs(vecs[:, np.argmax(np.abs(vals))])
    for i, n in enumerate(nodes):
        assert v[n] == pytest.approx(lead[i], abs=1e-6)


def test_small_industries_skipped(spark, local_nodes):
    five = [("A", "B", 1.0), ("B", "C", 1.0), ("C", "D", 1.0), ("D", "E", 1.0)]     # 5 nodes
    six = five + [("E", "F", 1.0)]                                                   # 6 nodes
    both = _pairs(spark, five, "H5").unionByName(_pairs(spark, six, "H6"))
    adj = graph.adjacency(graph.symmetric_edges(both))
    c = graph.eigenvector_centrality(adj, local_nodes=local_nodes)
    assert {r.hy_dm for r in c.collect()} == {"H6"}
    assert c.count() == 6


def test_star_and_two_components(spark, local_nodes):
    star = [("HUB", f"L{i}", 1.0) for i in range(6)]                       # bipartite
    c = {r.nsrsbh: r.centrality for r in graph.eigenvector_centrality(_adj(spark, star), local_nodes=local_nodes).collect()}
    want, _, _, _ = _numpy_centrality(star)
    for k in want:
        assert c[k] == pytest.approx(want[k], rel=1e-7)
    assert c["HUB"] > c["L0"]
    two = [("A", "B", 1.0), ("B", "C", 1.0), ("C", "A", 1.0), ("X", "Y", 5.0), ("Y", "Z", 5.0), ("Z", "X", 5.0)]
    c2 = {r.nsrsbh: r.centrality for r in graph.eigenvector_centrality(_adj(spark, two), local_nodes=local_nodes).collect()}
    want2, _, _, _ = _numpy_centrality(two)
    for k in want2:
        assert c2[k] == pytest.approx(want2[k], rel=1e-7, abs=1e-7)


def test_hub_path_is_exact(spark):
    # one hub trading with every other node: its in-edges go through the broadcast hub path
    edges = [("HUB", f"N{i:02d}", float(i + 1)) for i in range(30)] + \
            [(f"N{i:02d}", f"N{i + 1:02d}", 2.0) for i in range(29)]
    adj = _adj(spark, edges)
    plain = {r.nsrsbh: r.centrality for r in graph.eigenvector_centrality(adj).collect()}
    salted = {r.nsrsbh: r.centrality
              for r in graph.eigenvector_centrality(adj, hot_degree=4, local_nodes=ITERATED).collect()}
    assert plain.keys() == salted.keys()
    for k in plain:
        assert salted[k] == pytest.approx(plain[k], rel=1e-8)


def test_edge_layout_is_read_in_place(spark):
    adj = _adj(spark, RING6)
    layout = graph._layout(adj, 4, 8)
    v = layout.nodes.withColumn("v", F.lit(1.0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph._multiply(layout, v)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        layout.drop()
    assert "Bucketed: true" in plan


def test_hub_list_is_bounded(spark):
    edges = [(f"S{i:02d}", f"T{j}", 1.0) for i in range(12) for j in range(4)]
    adj = _adj(spark, edges)
    # every T node has degree 12 > 2: four hubs, but only two may be broadcast
    layout = graph._layout(adj, 2, 8, hot_broadcast_rows=2)
    try:
        assert layout.hot.count() <= 2
        v = layout.nodes.withColumn("v", F.lit(1.0))
        got = {r.node: r.u for r in graph._multiply(layout, v).collect()}
    finally:
        layout.drop()
    assert got["T0"] == 12.0 and got["S00"] == 4.0


def test_tolerance_stops_at_the_leading_vector(spark):
    v = {r.nsrsbh: r.v for r in graph.leading_eigenvector(_adj(spark, RING6), tol=1e-12, local_nodes=ITERATED).collect()}
    _, _, a, nodes = _numpy_centrality(RING6)
    vals, vecs = np.linalg.eigh(a)
    lead = np.abs(vecs[:, np.argmax(np.abs(vals))])
    for i, n in enumerate(nodes):
        assert v[n] == pytest.approx(lead[i], abs=1e-8)


def _chain(n):
    return [(f"N{i:04d}", f"N{i + 1:04d}", 1.0) for i in range(n - 1)]


def test_iterated_chain_converges(spark):
    """A 30-node chain: plain power iteration needs thousands of steps."""
    v = {r.nsrsbh: r for r in graph.leading_eigenvector(_adj(spark, _chain(30)), partitions=2, local_nodes=ITERATED).collect()}
    want = np.sin(np.pi * np.arange(1, 31) / 31)
    want /= np.linalg.norm(want)
    for i in range(30):
        row = v[f"N{i:04d}"]
        assert row.v == pytest.approx(want[i], abs=1e-6)
        assert row.eigenvalue == pytest.approx(2 * np.cos(np.pi / 31), rel=1e-12) and row.residual <= 1e-9


@pytest.mark.parametrize("n", [500, 2000])
def test_long_chains_at_the_defaults(spark, n):
    """Leading values that differ by a few millionths."""
    rows = graph.leading_eigenvector(_adj(spark, _chain(n))).collect()
    want = np.sin(np.pi * np.arange(1, n + 1) / (n + 1))
    want /= np.linalg.norm(want)
    got = {r.nsrsbh: r.v for r in rows}
    assert [got[f"N{i:04d}"] for i in range(n)] == pytest.approx(want.tolist(), abs=1e-6)
    assert all(r.converged and r.residual <= graph.DEFAULT_TOL for r in rows)
    assert rows[0].eigenvalue == pytest.approx(2 * np.cos(np.pi / (n + 1)), rel=1e-12)


def test_one_bad_industry_does_not_lose_the_others(spark):
    slow = _pairs(spark, _chain(60), "SLOW")
    quick = _pairs(spark, [(f"F{i}", f"F{j}", 1.0) for i in range(7) for j in range(i)], "QUICK")
    adj = graph.adjacency(graph.symmetric_edges(slow.unionByName(quick)))
    v = graph.leading_eigenvector(adj, max_steps=4, partitions=2, local_nodes=ITERATED)
    assert graph.unconverged(v) == ["SLOW"]
    rows = v.collect()
    assert {(r.hy_dm, r.converged) for r in rows} == {("SLOW", False), ("QUICK", True)} and len(rows) == 67
    assert all(r.residual > 1e-9 for r in rows if r.hy_dm == "SLOW")
    with pytest.warns(UserWarning, match="SLOW"):
        c = graph.eigenvector_centrality(adj, max_steps=4, partitions=2, local_nodes=ITERATED).collect()
    assert {r.nsrsbh: round(r.centrality, 6) for r in c} == {f"F{i}": round(6 / 7 ** 0.5, 6) for i in range(7)}


def test_restarted_basis_converges(spark, monkeypatch):
    monkeypatch.setattr(graph, "MAX_BASIS", 10)
    monkeypatch.setattr(graph, "KEPT", 3)
    edges = [(f"N{i:03d}", f"N{i + 1:03d}", 1.0 + i % 3) for i in range(14)]
    got = {r.nsrsbh: r.v for r in graph.leading_eigenvector(_adj(spark, edges), tol=1e-8, partitions=2,
                                                              local_nodes=ITERATED).collect()}
    _, _, a, nodes = _numpy_centrality(edges)
    vals, vecs = np.linalg.eigh(a)
    lead = np.abs(vecs[:, np.argmax(vals)])
    assert [got[n] for n in nodes] == pytest.approx(lead.tolist(), abs=1e-6)


def _by_rank(frame, nodes):
    """{rank: (eigenvalue, vector)} of one industry."""
    out = {}
    for r in frame.collect():
        assert r.converged and r.residual <= 1e-9
        out.setdefault(r["rank"], (r.eigenvalue, np.zeros(len(nodes))))[1][nodes.index(r.nsrsbh)] = r.v
    return out


def _directed(n, seed):
    """A random directed graph without symmetric weights: (edges, matrix, nodes)."""
    rng = np.random.default_rng(seed)
    edges = [(f"A{i:02d}", f"A{j:02d}", float(rng.integers(1, 50))) for i in range(n) for j in range(n) if rng.random() < 0.3]
    nodes = sorted({x for e in edges for x in e[:2]})
    a = np.zeros((len(nodes), len(nodes)))
    for x, y, w in edges:
        a[nodes.index(x), nodes.index(y)] = w
    return edges, a, nodes


def _as_adjacency(spark, edges, hy="H1"):
    return _pairs(spark, edges, hy).withColumnRenamed("zje", "w")


def test_three_eigenpairs(spark, local_nodes):
    rng = np.random.default_rng(6)
    edges = [(f"A{i:02d}", f"A{j:02d}", float(rng.integers(1, 50))) for i in range(9) for j in range(i) if rng.random() < 0.6]
    _, _, a, nodes = _numpy_centrality(edges)
    values, vectors = np.linalg.eigh(a)
    order = np.argsort(-np.abs(values))[:3]
    got = _by_rank(graph.leading_eigenpairs(_adj(spark, edges), 3, local_nodes=local_nodes), nodes)
    assert sorted(got) == [1, 2, 3]
    for rank, k in enumerate(order, 1):
        value, v = got[rank]
        want = vectors[:, k] * (1 if vectors[:, k].sum() >= 0 else -1)
        assert value == pytest.approx(values[k], rel=1e-9) and v == pytest.approx(want, abs=1e-6)


def test_three_singular_vectors_match_a_distributed_svd(spark, local_nodes):
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix
    edges, a, nodes = _directed(9, 5)
    svd = RowMatrix(spark.sparkContext.parallelize([Vectors.dense(r) for r in a])).computeSVD(3)
    got = _by_rank(graph.gramian_eigenpairs(_as_adjacency(spark, edges), 3, local_nodes=local_nodes), nodes)
    for rank in (1, 2, 3):
        value, v = got[rank]
        want = svd.V.toArray()[:, rank - 1]
        assert value == pytest.approx(svd.s[rank - 1] ** 2, rel=1e-8)
        assert v == pytest.approx(want * (1 if want.sum() >= 0 else -1), abs=1e-6)


def test_an_eigenvalue_with_several_vectors(spark, local_nodes):
    """Two equal triangles and a weaker one: the leading value comes twice, and no pair is skipped."""
    edges = [(f"{t}{i}", f"{t}{(i + 1) % 3}", w) for t, w in (("P", 5.0), ("Q", 5.0), ("R", 3.0)) for i in range(3)]
    _, _, a, nodes = _numpy_centrality(edges)
    got = _by_rank(graph.leading_eigenpairs(_adj(spark, edges), 3, local_nodes=local_nodes), nodes)
    assert [got[r][0] for r in (1, 2, 3)] == pytest.approx([10.0, 10.0, 6.0], rel=1e-9)
    vectors = np.array([got[r][1] for r in (1, 2, 3)])
    assert vectors @ vectors.T == pytest.approx(np.eye(3), abs=1e-6)
    assert a @ vectors.T == pytest.approx(vectors.T * [10, 10, 6], abs=1e-6)


def test_fewer_nodes_than_pairs(spark, local_nodes):
    _, _, a, nodes = _numpy_centrality(RING6)
    got = _by_rank(graph.leading_eigenpairs(_adj(spark, RING6), 9, local_nodes=local_nodes), nodes)
    values = np.linalg.eigvalsh(a)
    assert [got[r][0] for r in range(1, 7)] == pytest.approx(values[np.argsort(-np.abs(values))].tolist(), rel=1e-8)
    assert len(got) == 6


def test_an_asymmetric_adjacency_is_refused(spark):
    edges, _, _ = _directed(9, 1)
    adj = _as_adjacency(spark, edges, "ODD").unionByName(_adj(spark, RING6, "EVEN"))
    assert [r[0] for r in graph.asymmetric_industries(adj).collect()] == ["ODD"]
    with pytest.raises(ValueError, match="ODD"):
        graph.leading_eigenvector(adj)
    # two sums of the same amounts in another order are no asymmetry
    close = spark.createDataFrame([("H", "A", "B", 0.1 + 0.2), ("H", "B", "A", 0.3)],
                                  "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, w double")
    assert graph.asymmetric_industries(close).count() == 0


def test_a_step_writes_one_row_per_node(spark, monkeypatch):
    """What a step appends to the basis does not grow with it."""
    from ledgerprofile.session import Scratch
    sizes = []
    plain = Scratch.append

    def counted(self, name, df, *args):
        sizes.append(df.count())
        return plain(self, name, df, *args)
    monkeypatch.setattr(Scratch, "append", counted)
    graph.leading_eigenvector(_adj(spark, _chain(20)), max_steps=8, partitions=2, local_nodes=ITERATED)
    assert sizes == [20] * len(sizes) and len(sizes) >= 4


def test_matches_a_distributed_svd(spark, local_nodes):
    """The leading right singular vector of the adjacency rows, as MLlib computes it."""
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix
    rng = np.random.default_rng(3)
    edges = [(f"A{i}", f"A{j}", float(rng.integers(1, 50))) for i in range(9) for j in range(i) if rng.random() < 0.6]
    _, _, a, nodes = _numpy_centrality(edges)
    svd = RowMatrix(spark.sparkContext.parallelize([Vectors.dense(r) for r in a])).computeSVD(1)
    lead = np.abs(svd.V.toArray()[:, 0])
    got = {r.nsrsbh: r for r in graph.leading_eigenvector(_adj(spark, edges), local_nodes=local_nodes).collect()}
    assert [got[n].v for n in nodes] == pytest.approx(lead.tolist(), abs=1e-6)
    assert got[nodes[0]].eigenvalue == pytest.approx(svd.s[0], rel=1e-8)


def test_industries_finish_one_by_one_and_clean_up(spark):
    import os
    from ledgerprofile.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    fast = _pairs(spark, [(f"F{i}", f"F{j}", 1.0) for i in range(7) for j in range(i)], "H1")
    slow = _pairs(spark, [(f"S{i:02d}", f"S{i + 1:02d}", 1.0) for i in range(11)], "H2")
    adj = graph.adjacency(graph.symmetric_edges(fast.unionByName(slow)))
    before = set(os.listdir(folder))
    rows = graph.leading_eigenvector(adj, partitions=2, local_nodes=ITERATED).collect()
    assert {r.hy_dm for r in rows} == {"H1", "H2"} and len(rows) == 19
    assert {round(r.eigenvalue, 9) for r in rows if r.hy_dm == "H1"} == {6.0}
    left = [d for d in os.listdir(folder) if d not in before]
    assert len(left) <= 2                       # the finished vectors, one frame per step that finished any


def test_null_ids_dropped(spark):
    p = spark.createDataFrame([("H1", "A", None, 1.0), ("H1", None, "B", 1.0), ("H1", "A", "B", 2.0)],
                              "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, zje double")
    assert graph.symmetric_edges(p).count() == 2


def test_diag_eps_fills_empty_diagonal(spark):
    sym = graph.symmetric_edges(_pairs(spark, [("A", "B", 2.0), ("C", "C", 1.0)]))
    adj = {(r.xf_nsrsbh, r.gf_nsrsbh): r.w for r in graph.adjacency(sym, diag_eps=0.001).collect()}
    assert adj == {("A", "B"): 2.0, ("B", "A"): 2.0, ("C", "C"): 2.0, ("A", "A"): 0.001, ("B", "B"): 0.001}
    assert graph.adjacency(sym).count() == 3


# industries solved by their entries ----------------------------------------------------------
@pytest.fixture
def by_entries(monkeypatch):
    """Every industry beyond the dense bound, and none may be iterated by the driver."""
    def refused(*args):
        raise AssertionError("iterated")
    monkeypatch.setattr(graph, "LOCAL_NODES", 0)
    monkeypatch.setattr(graph, "_lanczos", refused)


def test_entries_give_three_eigenpairs_of_several_industries(spark, by_entries):
    rng = np.random.default_rng(8)
    want, adj = {}, None
    for hy in ("H1", "H2"):
        edges = [(f"A{i:02d}", f"A{j:02d}", float(rng.integers(1, 50))) for i in range(60) for j in range(i + 1) if rng.random() < 0.1]
        _, _, a, nodes = _numpy_centrality(edges)
        want[hy] = np.linalg.eigh(a), nodes
        one = _adj(spark, edges, hy)
        adj = one if adj is None else adj.unionByName(one)
    pairs = graph.leading_eigenpairs(adj, 3, tol=1e-12)
    for hy, ((values, vectors), nodes) in want.items():
        got = _by_rank(pairs.where(F.col("hy_dm") == hy), nodes)
        for rank, k in enumerate(np.argsort(-np.abs(values))[:3], 1):
            v = vectors[:, k] * (1 if vectors[:, k].sum() >= 0 else -1)
            assert got[rank][0] == pytest.approx(values[k], rel=1e-10) and got[rank][1] == pytest.approx(v, abs=1e-8)


def test_entries_give_singular_vectors(spark, by_entries):
    edges, a, nodes = _directed(40, 7)
    got = _by_rank(graph.gramian_eigenpairs(_as_adjacency(spark, edges), 3, tol=1e-12), nodes)
    _, sigma, vt = np.linalg.svd(a)
    for rank in (1, 2, 3):
        v = vt[rank - 1] * (1 if vt[rank - 1].sum() >= 0 else -1)
        assert got[rank][0] == pytest.approx(sigma[rank - 1] ** 2, rel=1e-10) and got[rank][1] == pytest.approx(v, abs=1e-7)


def test_entries_give_centrality_and_name_what_is_left(spark, by_entries):
    c = {r.nsrsbh: r.centrality for r in graph.eigenvector_centrality(_adj(spark, RING6), tol=1e-12).collect()}
    want, _, _, _ = _numpy_centrality(RING6)
    assert c == pytest.approx(want, rel=1e-9)
    slow, quick = _pairs(spark, _chain(300), "SLOW"), _pairs(spark, RING6, "QUICK")
    adj = graph.adjacency(graph.symmetric_edges(slow.unionByName(quick)))
    with pytest.warns(UserWarning, match="SLOW"):
        assert {r.hy_dm for r in graph.eigenvector_centrality(adj, max_steps=5).collect()} == {"QUICK"}


def test_tied_vectors_stay_eigenvectors():
    """The uniform vector lies along one of two tied vectors."""
    from ledgerprofile.operators import spectral
    a = np.kron(np.eye(2), np.ones((3, 3)) - np.eye(3))
    for values, vectors in (spectral.eigenpairs(a, 2, False), spectral.eigenpairs(a, 2, True),
                            spectral.krylov(lambda x: a @ x, 6, 2, 1e-12, 50)[:2]):
        assert vectors.T @ vectors == pytest.approx(np.eye(2), abs=1e-9)
        assert a @ (a @ vectors) == pytest.approx(4 * vectors, abs=1e-9)
        assert np.abs(vectors[:, 0]) == pytest.approx(np.full(6, 6 ** -0.5))


@pytest.mark.parametrize("n", [400, 3000])
def test_krylov_restarts_and_repeated_values(n):
    """A spectrum with a close second value, and a leading one that comes twice; the basis starts again."""
    from ledgerprofile.operators import spectral
    d = np.linspace(-1.0, 1.0, n)
    d[-2:] = 1.5
    d[0] = -1.4999
    values, vectors, residuals = spectral.krylov(lambda x: d[:, None] * x, n, 3, 1e-11, 500)
    assert values == pytest.approx([1.5, 1.5, -1.4999], rel=1e-12) and (residuals <= 1e-11).all()
    assert np.abs(vectors[0, 2]) == pytest.approx(1.0) and vectors[:-2, :2] == pytest.approx(np.zeros((n - 2, 2)), abs=1e-8)


def test_an_edge_list_and_its_reverse_read_the_pairs_once(spark, tmp_path):
    _pairs(spark, [("A", "B", 2.0), ("B", "A", 0.5), ("C", "C", 1.0)]).write.parquet(str(tmp_path / "pairs"))
    sym = graph.symmetric_edges(spark.read.parquet(str(tmp_path / "pairs")))
    assert sorted(tuple(r)[1:] for r in sym.collect()) == [
        ("A", "B", 0.5), ("A", "B", 2.0), ("B", "A", 0.5), ("B", "A", 2.0), ("C", "C", 1.0), ("C", "C", 1.0)]
    adj = graph.adjacency(sym)
    assert sorted(tuple(r)[1:] for r in adj.collect()) == [("A", "B", 2.5), ("B", "A", 2.5), ("C", "C", 2.0)]
    assert adj._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2      # initial and final plan


def test_adjacency_keeps_single_directions_nulls_and_repeated_rows(spark):
    rows = [("H1", "A", "B", 1.0), ("H1", "A", "B", 2.0), ("H1", "B", "A", None), ("H1", "D", "C", 4.0), ("H1", None, "A", 7.0),
            ("H1", "A", None, 8.0), (None, "A", "B", 5.0)]
    adj = graph.adjacency(spark.createDataFrame(rows, "hy_dm string, xf_nsrsbh string, gf_nsrsbh string, zje double"))
    assert {tuple(r)[:3]: r.w for r in adj.collect()} == {
        ("H1", "A", "B"): 3.0, ("H1", "B", "A"): None, ("H1", "D", "C"): 4.0, ("H1", None, "A"): 7.0, ("H1", "A", None): 8.0,
        (None, "A", "B"): 5.0}


def test_a_symmetric_adjacency_is_stored_once_per_pair_of_nodes(spark, monkeypatch):
    monkeypatch.setattr(graph, "LOCAL_NODES", 0)
    rows = []
    store = graph.Scratch.store

    def counted(self, df, *args):
        out = store(self, df, *args)
        rows.append((out.columns, out.count(), "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(graph.Scratch, "store", counted)
    edges = [(f"N{i}", f"N{(i + 1) % 12}", float(i + 1)) for i in range(12)] + [("N3", "N3", 2.0)]
    got = {r.nsrsbh: r.v for r in graph.leading_eigenvector(_adj(spark, edges), 1e-12).collect()}
    want = _numpy_centrality(edges)[1]
    sign = np.sign(sum(want.values()))
    assert max(abs(got[n] - sign * want[n]) for n in want) < 1e-9
    assert rows[0][1] == 13                                     # not 25: both directions are one row
    assert not rows[-1][2]                                      # the solver's edges are dealt without another sum per pair


def test_names_are_numbered_together_and_across_flushes(monkeypatch):
    edges = [("H1", f"N{i}", f"N{i + 1}", float(i % 5 + 1)) for i in range(40)] + \
            [("H2", f"N{i}", f"M{i}", float(i + 1)) for i in range(9)]
    schema = ["hy_dm", "src", "dst", "w"]
    table = pa.table(dict(zip(schema, zip(*edges))))

    def solve():
        out = pa.Table.from_batches(spectral.sparse_pairs(iter(table.to_batches(max_chunksize=7)), 1, False, 1e-12, 500))
        return {(r["hy_dm"], r["node"]): r["centrality"] for r in out.to_pylist()}

    whole = solve()
    monkeypatch.setattr(spectral, "WAITING_BYTES", 100)
    assert solve() == pytest.approx(whole)
    for industry in ("H1", "H2"):
        want = _numpy_centrality([e[1:] for e in edges if e[0] == industry])[0]
        assert {n: c for (h, n), c in whole.items() if h == industry} == pytest.approx(want, rel=1e-9, abs=1e-9)
