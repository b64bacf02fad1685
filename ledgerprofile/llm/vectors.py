"""Quantised vectors and the grid of blocks that the vector operators share.

A search takes a stated set of query rows against all rows.  The rows are dealt into blocks of
about ``block_rows`` rows and the queries into slots of about ``slot_rows``; each (block, slot)
is one group with a bounded number of rows on either side, and it returns a bounded number of
rows per query.  Neither side is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerprofile.llm.columns import named
from ledgerprofile.session import Scratch

SCALE = 256
MAX_COMPONENT = 1 << 31      # quantised components are smaller than that


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as longs; an error beyond ``MAX_COMPONENT``."""
    def cell(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        return (F.when(F.abs(scaled) >= MAX_COMPONENT, F.raise_error(F.lit("component too large")).cast("bigint"))
                .otherwise(F.floor(scaled)))
    return F.transform(vector, cell)


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def integer_rows(rows: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """(vec_id, q, *more) of the rows with an id and a finite vector."""
    return (rows.where(named(id_col).isNotNull() & takes_part(named(vector_col)))
            .select(named(id_col).cast("long").alias("vec_id"), quantised(named(vector_col)).alias("q"), *more))


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """[rows, components] of a list column; a missing component counts as 0."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = max([width, *lengths.tolist()]) if len(lengths) else width
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


class Products:
    """Exact integer inner products with rows of one matrix.

    Floating point holds integers exactly up to its mantissa, and multiplies them faster; it is
    used where no sum can be larger.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows.astype(np.int64)
        self.most = float(np.abs(self.rows).max(initial=0))
        self.as_float: dict[type, np.ndarray] = {}

    def __call__(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The products of the rows numbered ``rows``; a component that one side lacks counts as 0."""
        width = self.rows.shape[1]
        weights = np.pad(weights, (0, max(0, width - len(weights))))[:width].astype(np.int64)
        most = self.most * float(np.abs(weights).sum())
        if most >= 2 ** 63:
            raise OverflowError("inner products beyond 64 bits")
        if most >= 2 ** 53:
            return self.rows[rows] @ weights
        kind = np.float32 if most < 2 ** 24 else np.float64
        if kind not in self.as_float:
            self.as_float[kind] = self.rows.astype(kind)
        return (self.as_float[kind][rows] @ weights.astype(kind)).astype(np.int64)


def products(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all ``rows`` with ``weights``."""
    return Products(rows)(np.arange(len(rows)), weights)


def block_count(n_rows: int, block_rows: int) -> int:
    return max(1, -(-n_rows // block_rows))


def slotted(queries: DataFrame, scratch: Scratch, slot_rows: int) -> tuple[DataFrame, int]:
    """The distinct queries, stored, with a number ``no`` and a slot each; and the slots' count."""
    stored = scratch.store(queries.distinct().withColumn("no", F.monotonically_increasing_id()))
    n = stored.count()
    slots = -(-n // slot_rows)
    return stored.withColumn("slot", F.pmod(F.xxhash64("no"), F.lit(max(1, slots))).cast("int")), slots


def on_grid(blocks: DataFrame, n_blocks: int, queries: DataFrame, n_slots: int,
            search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search`` over each (block, slot): the rows of ``blocks`` against those of ``queries``."""
    left = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n_slots - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    return left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot")).applyInArrow(search, schema)
