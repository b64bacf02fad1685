"""Hard negatives of anchors by angular triangle filtering.

Components are integers (``floor(256 x)``) and a score is the integer inner product.  Each
anchor has positives, its best rows of the same label; for each positive the hard negatives are
the best rows of other labels whose score lies in a window below the positive's score.

Each row stores its norm and its angles to a few reference directions.  For an anchor at the
angles ``t_j`` and a row at ``u_j`` the triangle inequality on the sphere bounds the angle between
them from below by every ``|t_j - u_j|`` and from above by every ``t_j + u_j`` (or what is left
to the full turn).  The tightest of them give an interval of the cosine, and times both norms
an interval of the score, widened by more than rounding can cost.  A row is scored in integers
only if its interval overlaps the wanted window: at least the k-th best score found so far, and
inside the positive's window.  Rows come in the order of their upper bounds, in waves, so the
search ends as soon as the next upper bound cannot reach the k-th best.  Bounds decide only
what is scored: the result is exact.

At scale: rows are dealt into blocks and anchors into slots (see ``vectors``); a block returns
``positives`` rows per anchor in the first pass and ``negatives`` per positive in the second,
and a window merges them.  The reference directions are fitted on at most
``SAMPLE_ROWS`` rows; every row takes part in the search.  How much the bounds save depends on
the data: rows of tight clusters are told apart, rows at random in many dimensions hardly.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no
part; in vectors of different lengths the missing components count as 0, a vector of zeros scores
0 with all; rows that repeat an id are candidates of their own, but not of anchors with that id;
rows that repeat id, label and vector are one anchor; anchors without positives or without
negatives give no rows; an empty table gives no rows.  Only the named columns are read, so
further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import vectors
from ledgerprofile.llm.columns import named
from ledgerprofile.session import Scratch, ship

BLOCK_ROWS = 16_384
SLOT_ROWS = 256
REFERENCES = 24
SAMPLE_ROWS = 2_048          # bound of the sample that the reference directions are fitted on
WAVE = 256                   # rows scored first; each further wave is twice as long
ANGLE_SLACK = np.float32(4e-6)    # more than single-precision angles and their sums can be off
COSINE_SLACK = 1e-6          # more than single-precision cosines can be off

ROWS = "block int, vec_id long, label long, q array<long>, norm double, angles array<float>"
POSITIVES = "no long, anchor_id long, positive_id long, positive_score long"
FOUND = "no long, anchor_id long, place int, positive_id long, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Mining:
    """What is mined: negatives with ``low * positive <= 100 * negative <= high * positive``."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def window(self, positive: int) -> tuple[int, int]:
        """The least and the greatest wanted score."""
        return -(-self.low * positive // 100), self.high * positive // 100


# angles and bounds -----------------------------------------------------------------------------
def reference_directions(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors [references, components]: sample rows far from each other, the first one first."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    chosen: list[np.ndarray] = []
    nearest = np.full(len(units), -np.inf)
    while len(chosen) < count and len(units):
        at = int(np.argmin(nearest)) if chosen else 0
        if chosen and nearest[at] > 1 - 1e-9:            # only copies are left
            break
        chosen.append(units[at])
        nearest = np.maximum(nearest, units @ units[at])
    return np.array(chosen).reshape(len(chosen), sample.shape[1])


def angles_to(rows: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the angles to the references; a vector of zeros is given the angle pi / 2."""
    width = max(rows.shape[1], references.shape[1])
    rows = np.pad(rows.astype(np.float64), ((0, 0), (0, width - rows.shape[1])))
    references = np.pad(references, ((0, 0), (0, width - references.shape[1])))
    norms = np.linalg.norm(rows, axis=1)
    cosines = rows @ references.T / np.where(norms > 0, norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0)).astype(np.float32)


def score_bounds(norm: float, angles: np.ndarray, norms: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers (lo, hi) with lo <= score <= hi for each row; ``rows`` has its angles [references, rows]."""
    least = np.zeros(len(norms), np.float32)
    most = np.full(len(norms), np.pi, np.float32)
    for own, angle in zip(rows, angles):
        np.maximum(least, np.abs(own - angle), out=least)
        total = own + angle
        np.minimum(most, total, out=most)
        np.minimum(most, np.float32(2 * np.pi) - total, out=most)
    both = norm * norms
    slack = 1 + COSINE_SLACK * both
    hi = np.ceil(both * np.cos(np.maximum(least - ANGLE_SLACK, 0)) + slack)
    lo = np.floor(both * np.cos(np.minimum(most + ANGLE_SLACK, np.float32(np.pi))) - slack)
    return lo, hi


# one block against one slot ---------------------------------------------------------------------
class Block:
    def __init__(self, rows: pa.Table):
        self.ids = rows.column("vec_id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.values = vectors.matrix(rows.column("q"))
        self.norms = rows.column("norm").to_numpy()
        self.angles = np.ascontiguousarray(vectors.matrix(rows.column("angles")).T)
        self.products = vectors.Products(self.values)


class Search:
    """One anchor's search in a block: rows in the order of their upper bounds, each scored once at most."""

    def __init__(self, block: Block, anchor: tuple, wanted: np.ndarray):
        _, _, _, weights, norm, angles = anchor
        self.block, self.weights = block, weights
        self.rows = np.flatnonzero(wanted)
        self.lo, hi = score_bounds(norm, angles, block.norms[self.rows], block.angles[:, self.rows])
        order = np.argsort(-hi, kind="stable")
        self.rows, self.lo, self.hi = self.rows[order], self.lo[order], hi[order]
        self.scores = np.zeros(len(order), np.int64)
        self.scored = np.zeros(len(order), bool)

    def score(self, places: np.ndarray) -> None:
        new = places[~self.scored[places]]
        if len(new):
            self.scores[new] = self.block.products(self.rows[new], self.weights)
            self.scored[new] = True

    def best(self, k: int, window: tuple[int, int] | None = None) -> tuple[list[int], list[int]]:
        """(ids, scores) of the k best rows (with a score inside the window), by score and smaller id."""
        places = np.arange(len(self.rows))
        if window:
            places = places[: np.searchsorted(-self.hi, -window[0], side="right")]     # hi >= window[0]
            places = places[self.lo[places] <= window[1]]
        best = np.empty(0, np.int64)                         # places, kept small
        at, wave = 0, WAVE
        while at < len(places) and (len(best) < k or self.hi[places[at]] >= self.scores[best].min()):
            part = places[at: at + wave]
            self.score(part)
            if window:
                part = part[(self.scores[part] >= window[0]) & (self.scores[part] <= window[1])]
            best = np.concatenate((best, part))
            if len(best) > k:
                least = np.partition(self.scores[best], len(best) - k)[len(best) - k]
                best = best[self.scores[best] >= least]      # ties of the k-th stay
            at, wave = at + wave, 2 * wave
        ids, scores = self.block.ids[self.rows[best]], self.scores[best]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order].tolist(), scores[order].tolist()


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32() if f.endswith("int") else pa.int64() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _anchors(right: pa.Table) -> Iterator[tuple]:
    """(no, id, label, values, norm, angles) of each anchor."""
    columns = [right.column(c).to_numpy().tolist() for c in ("no", "vec_id", "label")]
    yield from zip(*columns, vectors.matrix(right.column("q")), right.column("norm").to_numpy(),
                   vectors.matrix(right.column("angles")))


def _positives(left: pa.Table, right: pa.Table, m: Mining) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        block = Block(left)
        for anchor in _anchors(right):
            no, own, label = anchor[:3]
            search = Search(block, anchor, (block.labels == label) & (block.ids != own))
            out += [(no, own, i, s) for i, s in zip(*search.best(m.positives))]
    return _table(out, POSITIVES)


def _negatives(left: pa.Table, right: pa.Table, m: Mining) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        block = Block(left)
        for anchor, positives in zip(_anchors(right), right.column("positives").to_pylist()):
            no, own, label = anchor[:3]
            search = Search(block, anchor, (block.labels != label) & (block.ids != own))
            found = {}                                   # positives of one score share their negatives
            for p in positives:
                score = p["positive_score"]
                if score not in found:
                    found[score] = search.best(m.negatives, m.window(score))
                out += [(no, own, p["place"], p["positive_id"], i, score, s) for i, s in zip(*found[score])]
    return _table(out, FOUND)


# the operator --------------------------------------------------------------------------------------
def _with_angles(batches: Iterator[pa.RecordBatch], references: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms, angles = angles_to(vectors.matrix(batch.column("q")), references)
        kept = {c: batch.column(c) for c in ("vec_id", "label", "q")}
        yield pa.RecordBatch.from_pydict(kept | {"norm": norms, "angles": pa.array(list(angles), pa.list_(pa.float32())),
                                                 "is_anchor": batch.column("is_anchor")})


def hard_negatives(rows: DataFrame, is_anchor: Column, mining: Mining = Mining(), id_col: str = "vec_id",
                   vector_col: str = "embedding", label: Column | None = None, references: int = REFERENCES,
                   block_rows: int = BLOCK_ROWS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``label`` is an integer column (the column ``label`` if not given).
    """
    spark = rows.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    m = mining
    label = (named("label") if label is None else label).cast("long")
    integers = scratch.store(vectors.integer_rows(rows.where(label.isNotNull()), id_col, vector_col,
                                                  label.alias("label"), is_anchor.alias("is_anchor")))
    n = integers.count()
    sample = (integers.select("q", F.xxhash64("vec_id", "q").alias("h"), "vec_id").orderBy("h", "vec_id", "q")
              .limit(SAMPLE_ROWS).select("q").toArrow())
    directions = reference_directions(vectors.matrix(sample.column("q")).astype(np.float64), references)
    stored = scratch.store(integers.repartition(vectors.block_count(n, block_rows)).mapInArrow(
        lambda batches: _with_angles(batches, directions),
        ROWS.replace("block int, ", "") + ", is_anchor boolean").withColumn("block", F.spark_partition_id()))
    blocks, n_blocks = stored.drop("is_anchor"), vectors.block_count(n, block_rows)
    anchors, slots = vectors.slotted(stored.where("is_anchor").select("vec_id", "label", "q", "norm", "angles"),
                                     scratch, slot_rows)
    scratch.drop(integers)
    if not slots:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")

    first = Window.partitionBy("no").orderBy(F.desc("positive_score"), "positive_id")
    positives = scratch.store(
        vectors.on_grid(blocks, n_blocks, anchors, slots, lambda left, right: _positives(left, right, m), POSITIVES)
        .withColumn("place", F.row_number().over(first)).where(F.col("place") <= m.positives)
        .groupBy("no").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives")))
    found = scratch.store(vectors.on_grid(
        blocks, n_blocks, anchors.join(positives, "no"), slots, lambda left, right: _negatives(left, right, m), FOUND))
    scratch.drop(stored, positives)
    best = Window.partitionBy("no", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= m.negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
