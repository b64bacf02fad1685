"""Exact top-k search by inner product on a bit-sliced index.

Components are integers (``floor(256 x)``).  The index holds, for each block of rows and each
component ("attribute"), the block's smallest value and the bit slices of the values above it:
slice ``b`` is a bitmap with bit ``b`` of every row.  A query's score is the sum of its weights
times the attributes:

1. The attributes without their ``dropped`` lowest slices are added with bitmap arithmetic: a
   weight adds the attribute's slices once for each of its set bits, shifted to that bit;
   a negative weight adds the complemented slices, which differs by a constant.  Carry-save
   adders leave one bitmap per significance: the slices of all rows' coarse sums.
2. From the most significant slice downward the k-th largest coarse sum is found by counting
   bits.  The slices left out change a score by at most ``(2**dropped - 1) * sum |weight|``, so
   every row of the top k has a coarse sum of at least that k-th one less the slack; those rows
   are selected with one more descent.
3. These boundary rows are resolved exactly: their whole values are read from all slices,
   scored in integers, and ordered by score and smaller id.

Each block returns its k best rows per query and a window merges them.  Nothing is approximate.

At scale: the index is one table, about as large as the integers' significant bits; blocks meet
the query slots in a grid (see ``vectors``), so the work is queries times rows, as the task
demands, in tasks of bounded size.  Superseded tables are deleted.

Defined results: rows with a null id, a null vector, or a null or non-finite component take no
part; in vectors of different lengths the missing components count as 0; rows that repeat an id
are candidates of their own, but not of queries with that id; rows that repeat id and vector
are one query; with fewer than k candidates all are returned; an empty table gives no rows.  Only
the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import vectors
from ledgerprofile.session import Scratch, ship

BLOCK_ROWS = 32_768
SLOT_ROWS = 256
DROPPED = 2
EXACT_ROWS = 4_096           # boundary rows that are read from the slices at a time
IDS = -1                     # the attribute number of a block's ids

INDEX = "block int, attribute int, n_rows int, low long, bits int, slices binary"
FOUND = "no long, query_id long, vec_id long, score long"


# the index --------------------------------------------------------------------------------
def sliced(values: np.ndarray) -> tuple[int, np.ndarray]:
    """The smallest value, and the bit slices [bits, words] of the values above it."""
    low = int(values.min(initial=0)) if len(values) == 0 else int(values.min())
    above = (values - low).astype(np.uint64)
    bits = int(above.max(initial=0)).bit_length()
    words = -(-len(values) // 64)
    out = np.zeros((bits, words), np.uint64)
    for b in range(bits):
        packed = np.packbits(((above >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[b].view(np.uint8)[: len(packed)] = packed
    return low, out


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, vec_id, q) of one block -> its index rows, attribute by attribute."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    ids = rows.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    values, ids = vectors.matrix(rows.column("q"))[order], ids[order]
    block, n = rows.column("block")[0].as_py(), len(ids)
    out = [(block, IDS, n, 0, 0, ids.astype(np.int64).tobytes())]
    for d in range(values.shape[1]):
        low, slices = sliced(values[:, d])
        out.append((block, d, n, low, len(slices), slices.tobytes()))
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


class Block:
    """The index of one block, as arrays."""

    def __init__(self, rows: pa.Table):
        parts = sorted(rows.to_pylist(), key=lambda r: r["attribute"])
        self.ids = np.frombuffer(parts[0]["slices"], np.int64)
        self.n = len(self.ids)
        self.words = -(-self.n // 64)
        self.low = np.array([r["low"] for r in parts[1:]], np.int64)
        self.slices = [np.frombuffer(r["slices"], np.uint64).reshape(r["bits"], self.words) for r in parts[1:]]
        self.all = np.full(self.words, ~np.uint64(0))
        if self.n % 64:
            self.all[-1] = (np.uint64(1) << np.uint64(self.n % 64)) - np.uint64(1)

    def others(self, own: int) -> np.ndarray:
        """The bitmap of all rows but those with the id ``own`` (the ids are sorted)."""
        live = self.all.copy()
        for r in range(*np.searchsorted(self.ids, [own, own + 1])):
            live[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        return live

    def values(self, rows: np.ndarray) -> np.ndarray:
        """[rows, attributes]: the whole values, read from all slices."""
        out = np.repeat(self.low[None, :], len(rows), axis=0)
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        for d, slices in enumerate(self.slices):
            if len(slices):
                own = (slices[:, word] >> bit) & np.uint64(1)
                out[:, d] += (own << np.arange(len(slices), dtype=np.uint64)[:, None]).sum(axis=0).astype(np.int64)
        return out


# bitmap arithmetic --------------------------------------------------------------------------
def added(bitmaps: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The slices of the sum of all rows' bits; ``bitmaps[j]`` count ``2**j`` each (emptied here)."""
    out, j = [], 0
    while j < len(bitmaps):
        level = bitmaps[j]
        if len(level) > 1 and j + 1 == len(bitmaps):
            bitmaps.append([])
        while len(level) > 2:
            a, b, c = level.pop(), level.pop(), level.pop()
            x = a ^ b
            carry = a & b
            carry |= x & c
            x ^= c
            level.append(x)
            bitmaps[j + 1].append(carry)
        if len(level) == 2:
            a, b = level
            bitmaps[j + 1].append(a & b)
            level[:] = [a ^ b]
        out.append(level[0] if level else np.zeros(words, np.uint64))
        level.clear()
        j += 1
    return out


def coarse_sums(block: Block, weights: np.ndarray, dropped: int) -> list[np.ndarray]:
    """The slices of sum |weight| * (attribute without its lowest slices, complemented below 0)."""
    bitmaps: list[list[np.ndarray]] = [[]]
    for d in np.flatnonzero(weights):
        weight, slices = abs(int(weights[d])), block.slices[d][dropped:]
        if weights[d] < 0:
            slices = ~slices
        for s in range(weight.bit_length()):
            if weight >> s & 1:
                while len(bitmaps) < s + len(slices):
                    bitmaps.append([])
                for b, bitmap in enumerate(slices):
                    bitmaps[s + b].append(bitmap)
    return added(bitmaps, block.words)


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_largest(sums: list[np.ndarray], live: np.ndarray, k: int) -> int:
    """The k-th largest sum of the live rows (0 if there are fewer), most significant slice first."""
    value, rows = 0, live
    if count(live) < k:
        return 0
    for j in range(len(sums) - 1, -1, -1):
        with_bit = rows & sums[j]
        n = count(with_bit)
        if n >= k:
            value, rows = value | 1 << j, with_bit
        else:
            k, rows = k - n, rows & ~sums[j]
    return value


def at_least(sums: list[np.ndarray], live: np.ndarray, least: int) -> np.ndarray:
    """The bitmap of the live rows whose sum is ``least`` or more."""
    if least <= 0:
        return live
    above, equal = np.zeros_like(live), live
    for j in range(len(sums) - 1, -1, -1):
        if least >> j & 1:
            equal = equal & sums[j]
        else:
            above |= equal & sums[j]
            equal = equal & ~sums[j]
    return above | equal


def best_rows(block: Block, weights: np.ndarray, own: int, k: int, dropped: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the block's k best rows, by score and smaller id."""
    live = block.others(own)
    weights = np.pad(weights, (0, max(0, len(block.low) - len(weights))))[: len(block.low)]    # lacking ones are 0
    sums = coarse_sums(block, weights, dropped)
    slack = ((1 << dropped) - 1) * int(np.abs(weights).sum()) >> dropped
    boundary = at_least(sums, live, kth_largest(sums, live, k) - slack)
    rows = np.flatnonzero(np.unpackbits(boundary.view(np.uint8), bitorder="little"))
    ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(rows), EXACT_ROWS):
        part = rows[at: at + EXACT_ROWS]
        ids = np.concatenate((ids, block.ids[part]))
        scores = np.concatenate((scores, vectors.products(block.values(part), weights)))
        order = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[order], scores[order]
    return ids, scores


def _search(left: pa.Table, right: pa.Table, k: int, dropped: int) -> pa.Table:
    columns = [np.empty(0, np.int64)] * 4
    if left.num_rows and right.num_rows:
        block, found = Block(left), []
        for no, own, q in zip(right.column("no").to_numpy(), right.column("vec_id").to_numpy(),
                              vectors.matrix(right.column("q"))):
            ids, scores = best_rows(block, q, int(own), k, dropped)
            found.append((np.full(len(ids), no), np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found)]
    return pa.table(dict(zip(("no", "query_id", "vec_id", "score"), columns)))


# the operator --------------------------------------------------------------------------------
def bit_sliced_index(rows: DataFrame, n_rows: int, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The stored index of ``rows`` (vec_id, q) and its number of blocks."""
    ship(rows.sparkSession)
    blocks = vectors.block_count(n_rows, block_rows)
    dealt = rows.repartition(blocks).withColumn("block", F.spark_partition_id())
    return scratch.store(dealt.mapInArrow(_index_rows, INDEX)), blocks


def exact_top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                dropped: int = DROPPED, block_rows: int = BLOCK_ROWS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row where ``is_query`` holds."""
    scratch = Scratch(rows.sparkSession)
    stored = scratch.store(vectors.integer_rows(rows, id_col, vector_col, is_query.alias("is_query")))
    index, blocks = bit_sliced_index(stored.select("vec_id", "q"), stored.count(), scratch, block_rows)
    queries, slots = vectors.slotted(stored.where("is_query").select("vec_id", "q"), scratch, slot_rows)
    found = scratch.store(vectors.on_grid(
        index, blocks, queries, slots, lambda left, right: _search(left, right, k, dropped), FOUND)
        if slots else rows.sparkSession.createDataFrame([], FOUND))
    scratch.drop(stored, index)
    best = Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
