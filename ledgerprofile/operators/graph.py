"""Trade graph per industry: symmetric edges (U1), adjacency (A8), degree (A11),
node sets (A12), leading eigenpairs (M4) and eigenvector centrality (M5).

An industry with at most ``LOCAL_NODES`` nodes and ``LOCAL_EDGES`` edges is one bounded group: a
task solves it as a whole, as a dense matrix whatever the gaps between its eigenvalues.  One with at most
``SPARSE_NODES`` nodes and ``SPARSE_EDGES`` edges is a bounded group too: its edges go to one task, which
holds them as numbers (about 60 bytes per edge at most while it sorts them) and runs a block Lanczos process
on them.  Larger industries are iterated together, one plan per step, by a restarted Lanczos process.

Lanczos at scale
----------------
A step multiplies the adjacency with the newest basis vector: a join of the edge list with
the vector on the *target* node followed by a sum per *source* node.  The edge list is by far
the largest input, so it is laid out once as a bucketed table on its join key (written into
the session's checkpoint folder), and each step only moves the map-side-combined partial sums
(one row per node).  The bucketed scan needs no exchange on the edge side.  For the
eigenpairs of the Gramian A'A (right singular vectors of a directed graph) a second layout,
bucketed by source, takes the product back.

The basis is one bucketed table (industry, node, j, q, z = A q) to which a step appends its own
rows, so what a step writes does not grow with the basis; it is read in place.  After a step one
aggregation gives, per industry, the inner products of the newest vectors with all others;
a small problem per industry (Rayleigh-Ritz, solved in the tasks that hold those rows) gives
the best vectors of the basis and their values.  The next basis vector is the residual of the first pair
that has not converged, so its length - measured by the next step's aggregation - is that
pair's residual, relative to the largest value.  A pair whose residual is at most ``tol`` stays in the
basis, which deflates it; then a vector of noise comes in, so that further vectors of the same
eigenvalue are found too, and the next pair is aimed at.  A full basis is replaced by its best
vectors (thick restart), which needs no further product.

An industry that has all its pairs leaves the iteration.  Those that are left after ``max_steps``
products come back with ``converged`` false and their last residual, beside the others.

A hub node (one buyer trading with a third of all sellers) would put all of its edges in
one bucket.  Edges into nodes whose degree exceeds ``hot_degree`` are therefore kept
apart and streamed against a broadcast of the hubs' vector entries; the list of hubs is
counted, and the threshold raised if it is too long to broadcast it.  The result is exact;
only the placement changes.

Every step's rows are written to the session's checkpoint folder, so a lost executor recomputes
at most one step; superseded tables and the edge files are deleted.

The start is uniform, so a bipartite graph (eigenvalues +-lambda) still gives the vector of
+lambda, and of several leading vectors the first is the projection of the uniform start.  Vectors have
unit length per industry and the sign of a non-negative sum.
"""

from __future__ import annotations

import warnings

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.operators import spectral
from ledgerprofile.session import Scratch, ship

DEFAULT_TOL = 1e-9               # residual, relative to the largest value, at which a pair is found
DEFAULT_MAX_STEPS = 500          # products before the iteration leaves the rest unconverged
MAX_BASIS = 48                   # basis vectors before a restart
KEPT = 16                        # vectors that a restart keeps
LOCAL_NODES = 2_048              # industries up to these bounds are solved in one task each
LOCAL_EDGES = 1_000_000
SPARSE_NODES = 500_000           # industries up to these bounds are solved in one task each, by their edges
SPARSE_EDGES = 20_000_000        # entries that the task holds: of a Gramian both layouts of the edges count
SYMMETRY_TOL = 1e-9              # relative difference of the two directions of an edge
MIN_NODES_EXCLUSIVE = 5          # industries with at most this many nodes are skipped
DEFAULT_HOT_DEGREE = 1_000_000   # nodes with more in-edges are hubs
HOT_BROADCAST_ROWS = 100_000     # bound on the broadcast hub list
INDUSTRY_BROADCAST_ROWS = 100_000  # industry lists up to this size are broadcast
MAX_SPARSE_TASKS = 2_000         # tasks that the sparse industries are dealt over
EDGES_PER_BUCKET = 2_000_000     # edge-layout sizing (~100 MB per bucket)


# U1 -------------------------------------------------------------------------------------
def symmetric_edges(pair_totals: DataFrame, amount: str = "zje") -> DataFrame:
    """The edge list together with its reverse (all rows of both, so a self-loop appears twice).

    Pairs with a NULL id on either side are dropped.  Each pair gives its two rows where it is
    read, so what makes the pairs runs once and both rows meet in one map-side sum.
    """
    x, y = F.col("xf_nsrsbh"), F.col("gf_nsrsbh")
    both = F.array(F.struct(x.alias("xf_nsrsbh"), y.alias("gf_nsrsbh")), F.struct(y.alias("xf_nsrsbh"), x.alias("gf_nsrsbh")))
    return (pair_totals.where(x.isNotNull() & y.isNotNull())
            .select("hy_dm", F.explode(both).alias("e"), amount)
            .select("hy_dm", "e.xf_nsrsbh", "e.gf_nsrsbh", amount))


def _folded(edges: DataFrame, amount: str = "w") -> DataFrame:
    """(hy_dm, lo, hi, there, back, n_there, n_back): one row per unordered pair of nodes, with the
    sum and the number of the rows lo -> hi (self-loops too) and hi -> lo.

    Both directions of an edge that lie in one partition are one row of the shuffle.  A NULL id
    makes its own pairs.
    """
    x, y = F.col("xf_nsrsbh"), F.col("gf_nsrsbh")
    is_back = F.coalesce(x > y, F.lit(False))
    return (edges.select("hy_dm", F.when(is_back, y).otherwise(x).alias("lo"), F.when(is_back, x).otherwise(y).alias("hi"),
                         F.when(~is_back, F.col(amount)).alias("there"), F.when(is_back, F.col(amount)).alias("back"),
                         is_back.alias("is_back"))
            .groupBy("hy_dm", "lo", "hi")
            .agg(F.sum("there").alias("there"), F.sum("back").alias("back"),
                 F.count_if(~F.col("is_back")).alias("n_there"), F.count_if("is_back").alias("n_back")))


def _unfolded(folded: DataFrame) -> DataFrame:
    """(hy_dm, xf_nsrsbh, gf_nsrsbh, w): the directed edges of ``_folded``, one row per direction that is there."""
    rows = F.array(
        F.struct(F.col("lo").alias("xf_nsrsbh"), F.col("hi").alias("gf_nsrsbh"), F.col("there").alias("w"), F.col("n_there").alias("n")),
        F.struct(F.col("hi").alias("xf_nsrsbh"), F.col("lo").alias("gf_nsrsbh"), F.col("back").alias("w"), F.col("n_back").alias("n")))
    return (folded.select("hy_dm", F.explode(rows).alias("e")).where("e.n > 0")
            .select("hy_dm", "e.xf_nsrsbh", "e.gf_nsrsbh", "e.w"))


# A8 -------------------------------------------------------------------------------------
def adjacency(sym_edges: DataFrame, amount: str = "zje", diag_eps: float = 0.0) -> DataFrame:
    """Sparse adjacency per industry: (hy_dm, xf_nsrsbh, gf_nsrsbh, w) with ``w`` the sum
    of all amounts between the two nodes (both directions, since the input is symmetric).

    ``diag_eps > 0`` puts that weight on the diagonal cell of every node without a
    self-loop (an anti join against the self-loops, one extra row per such node).
    The sums of a pair of nodes are shuffled as one row, whatever the direction.
    """
    adj = _unfolded(_folded(sym_edges, amount))
    if diag_eps:
        loops = adj.where(F.col("xf_nsrsbh") == F.col("gf_nsrsbh")).select("hy_dm", "xf_nsrsbh")
        fill = (adj.select("hy_dm", "xf_nsrsbh").distinct()
                .join(loops, ["hy_dm", "xf_nsrsbh"], "left_anti")
                .select("hy_dm", "xf_nsrsbh", F.col("xf_nsrsbh").alias("gf_nsrsbh"),
                        F.lit(float(diag_eps)).alias("w")))
        adj = adj.unionByName(fill)
    return adj


# A11 ------------------------------------------------------------------------------------
def degree(adj: DataFrame) -> DataFrame:
    """(hy_dm, nsrsbh, degree): neighbours other than itself with |amount| >= 1."""
    connected = (F.col("xf_nsrsbh") != F.col("gf_nsrsbh")) & (F.abs("w") >= 1.0)
    return adj.groupBy("hy_dm", F.col("xf_nsrsbh").alias("nsrsbh")).agg(
        F.count_if(connected).alias("degree"))


# A12 ------------------------------------------------------------------------------------
def nodes(sym_edges: DataFrame) -> DataFrame:
    """(hy_dm, nsrsbh): every id seen as buyer or seller in the industry, once."""
    return sym_edges.select("hy_dm", F.col("xf_nsrsbh").alias("nsrsbh")).distinct()


def node_counts(sym_edges: DataFrame) -> DataFrame:
    """(hy_dm, n_nodes)."""
    return nodes(sym_edges).groupBy("hy_dm").agg(F.count(F.lit(1)).alias("n_nodes"))


def large_industries(sym_edges: DataFrame, min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE) -> DataFrame:
    """(hy_dm, n_nodes) of industries with more than ``min_nodes_exclusive`` nodes."""
    return node_counts(sym_edges).where(F.col("n_nodes") > min_nodes_exclusive)


# M4 -------------------------------------------------------------------------------------
class EdgeLayout:
    """The edge list laid out for repeated multiplication.

    ``edges`` (hy_dm, src, dst, w) holds the edges into ordinary nodes as a bucketed table
    on (hy_dm, dst) with ``buckets`` buckets, written once into the session's checkpoint
    folder: every step joins it where it lies.  ``hot_edges`` (same columns, or None) holds
    the edges into hub nodes, listed in ``hot`` (hy_dm, node); the hub list is small by
    construction and checked, so the hubs' vector entries are broadcast to wherever their
    edges are.  ``nodes`` (hy_dm, node) lists every node.
    """

    def __init__(self, edges: DataFrame, hot_edges: DataFrame | None, hot: DataFrame,
                 degrees: DataFrame, buckets: int, scratch: Scratch, small_industries: bool = True,
                 small_buckets: bool = True):
        self.small_buckets = small_buckets
        self.small_industries = small_industries
        self.degrees = degrees
        self.edges = edges
        self.hot_edges = hot_edges
        self.hot = hot
        self.nodes = degrees.select("hy_dm", "node")
        self.buckets = buckets
        self.scratch = scratch

    def drop(self) -> None:
        """Delete the files of the layout."""
        self.scratch.drop(self.edges, self.hot_edges, self.degrees)


def _bucket_count(spark, n_edges: int) -> int:
    """Buckets for ``n_edges`` edges: about EDGES_PER_BUCKET each, at least one per core, at
    most what the session allows for a table."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect
        cores = shuffle
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(min(shuffle, cores), -(-int(n_edges) // EDGES_PER_BUCKET), 1), most)


def _layout(adj: DataFrame, hot_degree: int, buckets: int | None = None,
            min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE,
            hot_broadcast_rows: int = HOT_BROADCAST_ROWS) -> EdgeLayout:
    spark = adj.sparkSession
    # The adjacency is read several times below (node counts, degrees, the two layout
    # writes): written once, so its upstream runs once, and deleted with the layout done.
    scratch = Scratch(spark)
    base = scratch.store(adj.select("hy_dm", "xf_nsrsbh", "gf_nsrsbh", "w"))
    keep = (base.select("hy_dm", "xf_nsrsbh").distinct()
            .groupBy("hy_dm").agg(F.count(F.lit(1)).alias("n_nodes"))
            .where(F.col("n_nodes") > min_nodes_exclusive).select("hy_dm"))
    # One row per industry code.  Counted before any broadcast: this list and the
    # per-industry norms (same rows) are broadcast only under the limit, and shuffle-joined
    # (AQE may still broadcast them at run time) beyond it.
    small_industries = keep.count() <= INDUSTRY_BROADCAST_ROWS
    edges = base.join(F.broadcast(keep) if small_industries else keep, "hy_dm").select(
        "hy_dm", F.col("xf_nsrsbh").alias("src"), F.col("gf_nsrsbh").alias("dst"), "w")
    deg = scratch.store(edges.groupBy("hy_dm", F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("deg")))
    n_edges = deg.agg(F.sum("deg")).first()[0] or 0
    if buckets is None:
        buckets = _bucket_count(spark, n_edges)
    threshold = hot_degree
    hot = deg.where(F.col("deg") > threshold).select("hy_dm", "node")   # a filter of a stored table
    n_hot = hot.count()
    if n_hot > hot_broadcast_rows:
        # At most #edges / threshold nodes can exceed the threshold: raising it to
        # #edges / limit bounds the hub list by the broadcast limit, whatever the data.
        threshold = max(hot_degree, -(-n_edges // hot_broadcast_rows))
        hot = deg.where(F.col("deg") > threshold).select("hy_dm", "node")
        n_hot = hot.count()
    hot_edges = None
    if n_hot:
        flagged = edges.join(F.broadcast(hot.select("hy_dm", F.col("node").alias("dst"),
                                                    F.lit(True).alias("is_hot"))),
                             ["hy_dm", "dst"], "left")
        hot_edges = scratch.store(flagged.where(F.col("is_hot").isNotNull()).drop("is_hot"))
        edges = flagged.where(F.col("is_hot").isNull()).drop("is_hot")
    stored = scratch.store(edges.repartition(buckets, "hy_dm", "dst"), buckets, ("hy_dm", "dst"))
    scratch.drop(base)
    return EdgeLayout(stored, hot_edges, hot, deg, buckets, scratch, small_industries,
                      n_edges <= 2 * EDGES_PER_BUCKET * buckets)


def _multiply(layout: EdgeLayout, v: DataFrame, absolute: bool = False) -> DataFrame:
    """(hy_dm, node, u) with u_i = sum_j w_ij * v_j (sum_j |w_ij * v_j| when ``absolute``).

    The ordinary edges are read in place from their buckets and joined with ``v`` (hy_dm,
    node, v), which is dealt like them.  A bucket of bounded size needs no sort: its slice of
    ``v``, which has no more entries than the bucket has edges, is a hash map of the task;
    larger buckets (a caller's own ``partitions``) are merged and can spill.  Edges into hubs
    are streamed against the broadcast hub entries of ``v``.  The sums are combined map-side
    before the one shuffle by source node.
    """
    vt = v.select("hy_dm", F.col("node").alias("dst"), "v")
    if int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")) != layout.buckets:
        vt = vt.repartition(layout.buckets, "hy_dm", "dst")
    slices = vt.hint("shuffle_hash") if layout.small_buckets else vt
    term = F.col("w") * F.col("v")
    term = F.abs(term) if absolute else term
    terms = layout.edges.join(slices, ["hy_dm", "dst"]).select("hy_dm", "src", term.alias("t"))
    if layout.hot_edges is not None:
        # at most HOT_BROADCAST_ROWS entries (checked in _layout)
        v_hot = vt.join(F.broadcast(layout.hot.withColumnRenamed("node", "dst")),
                        ["hy_dm", "dst"], "left_semi")
        hot_terms = (layout.hot_edges.join(F.broadcast(v_hot), ["hy_dm", "dst"])
                     .select("hy_dm", "src", term.alias("t")))
        terms = terms.unionByName(hot_terms)
    return terms.groupBy("hy_dm", F.col("src").alias("node")).agg(F.sum("t").alias("u"))


def asymmetric_industries(adj: DataFrame, tol: float = SYMMETRY_TOL) -> DataFrame:
    """(hy_dm): industries in which some edge differs from its reverse."""
    return _asymmetric(_folded(adj), tol)


def _asymmetric(folded: DataFrame, tol: float = SYMMETRY_TOL) -> DataFrame:
    there, back = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("there", "back"))
    return (folded.where((F.col("lo") != F.col("hi")) & (F.abs(there - back) > tol * F.greatest(F.abs(there), F.abs(back))))
            .select("hy_dm").distinct())


_FOUND = "hy_dm string, rank int, node string, v double, eigenvalue double, residual double, converged boolean"


def _dots(basis: DataFrame, newest: DataFrame) -> DataFrame:
    """(hy_dm, qq, qz, zz): per industry the inner products of all q and z with the newest ones.

    One aggregation with map-side sums; three numbers per industry and basis vector.
    """
    new = newest.select("hy_dm", "node", F.col("q").alias("qn"), F.col("z").alias("zn"))
    sums = (basis.join(new, ["hy_dm", "node"]).groupBy("hy_dm", "j")
            .agg(F.sum(F.col("q") * F.col("qn")).alias("qq"), F.sum(F.col("q") * F.col("zn")).alias("qz"),
                 F.sum(F.col("z") * F.col("zn")).alias("zz")))
    in_order = F.array_sort(F.collect_list(F.struct("j", "qq", "qz", "zz")))
    return (sums.groupBy("hy_dm").agg(in_order.alias("s"))
            .select("hy_dm", F.col("s.qq").alias("qq"), F.col("s.qz").alias("qz"), F.col("s.zz").alias("zz")))


def _lanczos(layouts: list[EdgeLayout], k: int, tol: float, max_steps: int) -> DataFrame:
    """The rows of _FOUND of all industries of the layouts, stored.

    One layout multiplies with A; a second one, of the reversed edges, with A'A.
    """
    layout = layouts[0]
    spark, scratch = layout.edges.sparkSession, layout.scratch
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ("hy_dm", "node")
    small = F.broadcast if layout.small_industries else (lambda df: df)
    kept = max(KEPT, k + 4)
    longest = max(MAX_BASIS, 2 * kept)

    def product(v: DataFrame) -> DataFrame:
        for one in layouts:
            v = _multiply(one, v).withColumnRenamed("u", "v")
        return v.withColumnRenamed("v", "z")

    def combined(weights: str):
        """Per node the sum of the basis q, weighted by the industry's array ``weights``."""
        return F.sum(F.col("q") * F.get(F.col(weights), "j"))

    nodes = layout.nodes
    for other in layouts[1:]:
        nodes = nodes.union(other.nodes).distinct()
    sizes = scratch.store(nodes.groupBy("hy_dm").agg(F.count(F.lit(1)).alias("n")))
    fresh = scratch.store(nodes.join(small(sizes), "hy_dm").select(*keys, (1.0 / F.sqrt("n")).alias("q"))
                          .repartition(partitions, *keys), partitions, keys)
    nothing = F.array().cast("array<double>")
    start = sizes.select("hy_dm", "n", F.lit(0).alias("found"), F.lit(None).cast("double").alias("before"),
                         F.lit(0.0).alias("scale"), nothing.alias("residuals"), nothing.alias("gram"),
                         nothing.alias("cross"), nothing.alias("norms"))
    state, last, basis, size = start, None, None, 0
    finished: list[DataFrame] = []
    for step in range(1, max_steps + 1):
        row = (fresh.join(product(fresh.withColumnRenamed("q", "v")), list(keys), "left")
               .select(*keys, F.lit(size).alias("j"), "q", F.coalesce("z", F.lit(0.0)).alias("z"))
               .repartition(partitions, *keys))
        basis = scratch.append(basis, row, partitions, keys)
        size += 1
        vectors = scratch.appended(basis)
        dots = _dots(vectors, vectors.where(F.col("j") == size - 1))
        before, restart = last, size == longest
        last = scratch.store(
            dots.join(small(state.select("hy_dm", "n", "found", "before", "scale", "residuals", "gram", "cross", "norms")), "hy_dm")
            .mapInPandas(lambda b, size=size, full=restart: spectral.solved(b, size, k, tol, full, kept), spectral.SOLVED))
        scratch.drop(before)
        state = last.where("not done")
        n_done, n_left = last.agg(F.count_if("done"), F.count_if(~F.col("done"))).first()
        stop = step == max_steps
        if n_done or stop:
            out = last if stop else last.where("done")
            pairs = vectors.join(small(out.select("hy_dm", "best")), "hy_dm").groupBy(*keys).agg(
                F.array(*[F.sum(F.col("q") * F.get(F.get("best", F.lit(r)), "j")) for r in range(k)]).alias("v"))
            finished.append(scratch.store(
                pairs.select(*keys, F.posexplode("v").alias("r", "v")).where(F.col("v").isNotNull())
                .join(small(out.select("hy_dm", "values", "residuals", "found")), "hy_dm")
                .select("hy_dm", (F.col("r") + 1).cast("int").alias("rank"), "node", "v",
                        F.get("values", "r").alias("eigenvalue"), F.get("residuals", "r").alias("residual"),
                        (F.col("r") < F.col("found")).alias("converged"))))
        if stop or not n_left:
            break
        old = fresh
        noise = (F.xxhash64(F.lit(step), *keys) / float(1 << 63)) * F.sqrt(F.lit(3.0) / F.first("n")) * F.first("noise")
        weights = small(state.select("hy_dm", "n", "noise", "next"))
        fresh = scratch.store(
            vectors.join(weights, "hy_dm").groupBy(*keys)
            .agg((F.sum(F.col("q") * F.get("next", "j") + F.col("z") * F.get("next", F.col("j") + size)) + noise).alias("q"))
            .repartition(partitions, *keys), partitions, keys)
        scratch.drop(old)
        if restart:
            kept_rows = (vectors.join(small(state.select("hy_dm", "kept")), "hy_dm").groupBy(*keys)
                         .agg(F.array(*[F.struct(F.sum(F.col("q") * F.get(F.get("kept", F.lit(r)), "j")).alias("q"),
                                                 F.sum(F.col("z") * F.get(F.get("kept", F.lit(r)), "j")).alias("z"))
                                        for r in range(kept)]).alias("s"))
                         .select(*keys, F.posexplode("s").alias("j", "s")).select(*keys, "j", "s.q", "s.z"))
            full, basis = basis, scratch.append(None, kept_rows.repartition(partitions, *keys), partitions, keys)
            scratch.drop_appended(full)
            size = kept
    scratch.drop(fresh, last, sizes)
    scratch.drop_appended(basis)
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    signs = out.groupBy("hy_dm", "rank").agg(F.when(F.sum("v") < 0, -1.0).otherwise(1.0).alias("sign"))
    return (out.join(small(signs), ["hy_dm", "rank"])
            .select("hy_dm", "rank", "node", (F.col("v") * F.col("sign")).alias("v"), "eigenvalue", "residual", "converged"))


class _Industries:
    """The adjacency, stored, cut into industries that one task solves and larger ones.

    A symmetric adjacency is stored as one row per unordered pair (``_folded``), from which the sizes, the
    test of the symmetry and the edges of every kind of industry are read without another shuffle of the edges.
    """

    def __init__(self, adj: DataFrame, min_nodes_exclusive: int, local_nodes: int, symmetric: bool):
        self.scratch = Scratch(adj.sparkSession)
        self.symmetric = symmetric
        ship(adj.sparkSession)
        edges = adj.select("hy_dm", "xf_nsrsbh", "gf_nsrsbh", "w")
        self.edges = self.scratch.store(_folded(edges) if symmetric else edges)
        if symmetric:                                          # each node with the edges that begin there
            ends = F.array(F.struct(F.col("lo").alias("node"), F.col("n_there").alias("n")),
                           F.struct(F.col("hi").alias("node"), F.col("n_back").alias("n")))
            begun = self.edges.select("hy_dm", F.explode(ends).alias("e")).where("e.n > 0").select("hy_dm", "e.node", "e.n")
        else:
            ends = F.array(F.struct(F.col("xf_nsrsbh").alias("node"), F.lit(1).alias("n")),
                           F.struct(F.col("gf_nsrsbh").alias("node"), F.lit(0).alias("n")))
            begun = self.edges.select("hy_dm", F.explode(ends).alias("e")).select("hy_dm", "e.node", "e.n")
        sizes = (begun.groupBy("hy_dm", "node").agg(F.sum("n").alias("n"))
                 .groupBy("hy_dm").agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("n").alias("n_edges"))
                 .where((F.col("n_nodes") > min_nodes_exclusive) & F.col("hy_dm").isNotNull()))
        is_local = (F.col("n_nodes") <= min(local_nodes, LOCAL_NODES)) & (F.col("n_edges") <= LOCAL_EDGES)
        entries = F.col("n_edges") if symmetric else 2 * F.col("n_edges")
        is_sparse = (F.col("n_nodes") <= local_nodes) & (entries <= SPARSE_EDGES)
        kind = F.when(is_local, "local").when(is_sparse, "sparse").otherwise("large")
        self.sizes = self.scratch.store(sizes.withColumn("kind", kind))
        counts = dict(tuple(r) for r in self.sizes.groupBy("kind").count().collect())
        # one row per industry code, counted before any broadcast
        self.small = F.broadcast if sum(counts.values()) <= INDUSTRY_BROADCAST_ROWS else (lambda df: df)
        self.n_sparse = counts.get("sparse", 0)
        self.local, self.sparse, self.large = (self._edges_of(k) if counts.get(k) else None for k in ("local", "sparse", "large"))

    def _edges_of(self, kind: str) -> DataFrame:
        """The directed edges; of sparse symmetric industries as they are stored."""
        edges = self.edges.join(self.small(self.sizes.where(F.col("kind") == kind).select("hy_dm")), "hy_dm")
        return _unfolded(edges) if self.symmetric and kind != "sparse" else edges

    def asymmetric(self) -> DataFrame:
        return _asymmetric(self.edges)

    def local_pairs(self, k: int, gramian: bool) -> DataFrame:
        def solve(edges: pd.DataFrame) -> pd.DataFrame:
            return spectral.local_pairs(edges, k, gramian)
        return self.scratch.store(
            self.local.select("hy_dm", F.col("xf_nsrsbh").alias("src"), F.col("gf_nsrsbh").alias("dst"), "w")
            .groupBy("hy_dm").applyInPandas(solve, spectral.PAIRS))

    def sparse_pairs(self, k: int, gramian: bool, tol: float, max_steps: int) -> DataFrame:
        """The rows of spectral.SPARSE_PAIRS: each industry is one task's, largest edge lists apart as far as they go."""
        if gramian:
            edges = self.sparse.select("hy_dm", F.col("xf_nsrsbh").alias("src"), F.col("gf_nsrsbh").alias("dst"), "w")
        else:                                                  # both directions of an edge once, with their mean
            there, back = F.col("there"), F.col("back")
            total = F.coalesce(there + back, there, back)
            edges = self.sparse.select("hy_dm", F.col("lo").alias("src"), F.col("hi").alias("dst"),
                                       (total / F.when(F.col("lo") == F.col("hi"), 1).otherwise(2)).alias("w"))
        tasks = min(self.n_sparse, MAX_SPARSE_TASKS)
        nth = F.row_number().over(Window.orderBy(F.desc("n_edges"), "hy_dm")) - 1     # one row per industry
        places = self.sizes.where("kind = 'sparse'").select("hy_dm", F.pmod(nth, F.lit(tasks)).alias("task"))
        dealt = (edges.join(self.small(places), "hy_dm").repartitionById(tasks, F.col("task"))
                 .select("hy_dm", "src", "dst", "w"))
        if tasks < self.n_sparse:                              # otherwise a task's rows are one industry's
            dealt = dealt.sortWithinPartitions("hy_dm")
        return self.scratch.store(dealt.mapInArrow(
            lambda b: spectral.sparse_pairs(b, k, gramian, tol, max_steps), spectral.SPARSE_PAIRS))

    def layouts(self, gramian: bool, hot_degree: int, partitions: int | None) -> list[EdgeLayout]:
        there = _layout(self.large, hot_degree, partitions, 0)
        if not gramian:
            return [there]
        reverse = self.large.select("hy_dm", F.col("gf_nsrsbh").alias("xf_nsrsbh"), F.col("xf_nsrsbh").alias("gf_nsrsbh"), "w")
        return [there, _layout(reverse, hot_degree, partitions, 0)]

    def drop(self) -> None:
        self.scratch.drop(self.edges, self.sizes)


def _eigenpairs(adj: DataFrame, k: int, gramian: bool, tol: float, max_steps: int, min_nodes_exclusive: int,
                hot_degree: int, partitions: int | None, local_nodes: int, check_symmetry: bool = False) -> DataFrame:
    industries = _Industries(adj, min_nodes_exclusive, local_nodes, not gramian)
    if check_symmetry:
        names = [r[0] for r in industries.asymmetric().limit(10).collect()]
        if names:
            industries.drop()
            raise ValueError(f"the adjacency is not symmetric in industries such as {names}: use gramian_eigenpairs")
    parts = []
    if industries.local is not None:
        parts.append(industries.local_pairs(k, gramian).drop("centrality").withColumn("converged", F.lit(True)))
    if industries.sparse is not None:
        parts.append(industries.sparse_pairs(k, gramian, tol, max_steps).drop("centrality"))
    if industries.large is not None:
        layouts = industries.layouts(gramian, hot_degree, partitions)
        parts.append(_lanczos(layouts, k, tol, max_steps))
        for layout in layouts:
            layout.drop()       # the result is a projection of stored vectors: it no longer reads the edges
    industries.drop()
    out = parts[0] if parts else adj.sparkSession.createDataFrame([], _FOUND)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("node", "nsrsbh")


def unconverged(pairs: DataFrame, limit: int = 10) -> list[str]:
    """Names of (at most ``limit``) industries with a pair that has not converged."""
    return [r[0] for r in pairs.where("not converged").select("hy_dm").distinct().orderBy("hy_dm").limit(limit).collect()]


def leading_eigenpairs(adj: DataFrame, k: int = 1, tol: float = DEFAULT_TOL, max_steps: int = DEFAULT_MAX_STEPS,
                       min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE, hot_degree: int = DEFAULT_HOT_DEGREE,
                       partitions: int | None = None, local_nodes: int = SPARSE_NODES,
                       check_symmetry: bool = True) -> DataFrame:
    """(hy_dm, rank, nsrsbh, v, eigenvalue, residual, converged): the ``k`` eigenpairs of largest magnitude
    of every industry's symmetric adjacency (all, if it has fewer nodes).

    ``residual`` is ``||A v - lambda v||`` over the largest magnitude, at most ``tol`` where
    ``converged``.  Industries with at most ``min_nodes_exclusive`` nodes are skipped.  An adjacency
    that is not symmetric is refused; its singular vectors are :func:`gramian_eigenpairs`.
    """
    return _eigenpairs(adj, k, False, tol, max_steps, min_nodes_exclusive, hot_degree, partitions, local_nodes, check_symmetry)


def gramian_eigenpairs(adj: DataFrame, k: int = 1, tol: float = DEFAULT_TOL, max_steps: int = DEFAULT_MAX_STEPS,
                       min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE, hot_degree: int = DEFAULT_HOT_DEGREE,
                       partitions: int | None = None, local_nodes: int = SPARSE_NODES) -> DataFrame:
    """The same for the Gramian A'A of every industry's adjacency A (rows ``xf_nsrsbh``, columns
    ``gf_nsrsbh``), which need not be symmetric: ``v`` are the right singular vectors and
    ``eigenvalue`` the squared singular values.
    """
    return _eigenpairs(adj, k, True, tol, max_steps, min_nodes_exclusive, hot_degree, partitions, local_nodes)


def leading_eigenvector(adj: DataFrame, tol: float = DEFAULT_TOL, max_steps: int = DEFAULT_MAX_STEPS,
                        min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE, hot_degree: int = DEFAULT_HOT_DEGREE,
                        partitions: int | None = None, local_nodes: int = SPARSE_NODES,
                        check_symmetry: bool = True) -> DataFrame:
    """(hy_dm, nsrsbh, v, eigenvalue, residual, converged): :func:`leading_eigenpairs` with k = 1."""
    return leading_eigenpairs(adj, 1, tol, max_steps, min_nodes_exclusive, hot_degree, partitions, local_nodes,
                              check_symmetry).drop("rank")


def _warn_unconverged(pairs: DataFrame, tol: float, max_steps: int) -> None:
    names = unconverged(pairs)
    if names:
        warnings.warn(f"no centrality for industries such as {names}: not converged to {tol} after {max_steps} products")


# M5 -------------------------------------------------------------------------------------
def eigenvector_centrality(adj: DataFrame, tol: float = DEFAULT_TOL, max_steps: int = DEFAULT_MAX_STEPS,
                           min_nodes_exclusive: int = MIN_NODES_EXCLUSIVE,
                           hot_degree: int = DEFAULT_HOT_DEGREE, partitions: int | None = None,
                           local_nodes: int = SPARSE_NODES) -> DataFrame:
    """(hy_dm, nsrsbh, centrality) with centrality_i = sum_j |w_ij * v_j|; ``adj`` is symmetric.

    Only industries with more than ``min_nodes_exclusive`` nodes; self-loops count.  Industries
    whose vector has not converged after ``max_steps`` products are left out, and a warning names them.
    """
    industries = _Industries(adj, min_nodes_exclusive, local_nodes, True)
    parts = []
    if industries.local is not None:
        parts.append(industries.local_pairs(1, False).select("hy_dm", "node", "centrality"))
    if industries.sparse is not None:
        v = industries.sparse_pairs(1, False, tol, max_steps)
        _warn_unconverged(v, tol, max_steps)
        parts.append(v.where("converged").select("hy_dm", "node", "centrality"))
    if industries.large is not None:
        layout, = industries.layouts(False, hot_degree, partitions)
        v = _lanczos([layout], 1, tol, max_steps)
        _warn_unconverged(v, tol, max_steps)
        found = _multiply(layout, v.where("converged").select("hy_dm", "node", "v"), absolute=True)
        parts.append(layout.scratch.store(found.withColumnRenamed("u", "centrality")).select("hy_dm", "node", "centrality"))
        layout.drop()
    industries.drop()
    out = parts[0] if parts else adj.sparkSession.createDataFrame([], "hy_dm string, node string, centrality double")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("node", "nsrsbh")
