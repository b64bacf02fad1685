"""Near-duplicate documents by circulant MinHash.

A document's set holds the distinct hashes of its word shingles.  The hashes fall into a
universe of ``2**universe_bits`` places; a first permutation reorders the places, and
coordinate ``k`` of the signature is the smallest value of a second permutation shifted
circularly by ``k``.  Two permutations so make all coordinates, and the values that one
shingle contributes are a contiguous stretch of the second permutation.

Signatures are cut into bands.  Documents of equal sets form one class; classes that share a
band are candidates, and a link needs ``100 * |A & B| >= threshold * |A | B|`` on the full
sets.  The work goes in three steps:

1. In each band bucket the smallest class key is the pivot; every member is verified against
   its pivot, and the links give components.  A bucket of ``m`` members costs ``m`` pairs, so
   a large group of near copies is no quadratic group.
2. In buckets that still hold several components, members of different components are
   compared (pairs inside a component could not change it), in tiles of bounded size.  First on
   sketches of ``sketch_bits`` further coordinates (one bit each), which must agree as far as a linked
   pair's do, up to 4.5 standard deviations: members that pass with some other one, in the
   first band the two share, are kept.  Then on the full sets of those: a tile counts all its
   intersections at once and returns links that span what it found linked, fewer than it has
   members.  So no pair becomes a row: a large family just below the threshold costs
   comparisons, but no rows.
3. The links of both steps give the final components; a document's ``component_id`` is the
   smallest id that it reaches.

No partner or candidate is capped.  What can be missed: with 40 bands of 6 rows a pair of
similarity exactly 0.8 shares no band with probability 5e-6, and its sketches disagree too
much with probability 3e-6; more similar pairs are missed less.

At scale: tasks read texts and emit bands; classes, bands, ids and sizes are shuffled, with
buckets and classes pre-aggregated and salted.  Sets are computed for classes in shared
buckets alone; the texts are shuffled once for that.  A pivot's set meets its members in up
to ``PIVOT_SALTS`` tasks.  Lineage is cut by tables
written under ``spark.checkpoint.dir``; superseded ones are deleted.  A bucket beyond
``TILE_MEMBERS`` members is cut into chunks, and two chunks of different components are one tile.

Defined results: null or blank texts have an empty set, ``n_shingles`` 0 and no links; rows
with a null id are never linked (``component_id`` null, ``kept`` true); rows that repeat an
id are separate texts, each linked by its own set; exactly repeated rows get equal results;
an empty table gives no rows.  Only the named columns are read, so further columns may have
any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import named, text_of
from ledgerprofile.llm.components import connected_components, every_salt, salt_of
from ledgerprofile.session import Scratch, ship

WORD_SEED = 101
PIVOT_SALTS = 32
TILE_MEMBERS = 512            # members of a chunk of a bucket; a tile holds two chunks at most
TILE_SHINGLES = 1 << 20       # shingles of a chunk, about
SLAB = 8192                   # shingles that are counted at a time
ROWS_AT_ONCE = 64             # rows of sketches that are compared at a time


@dataclass(frozen=True)
class MinHash:
    """Parameters of the signatures."""

    width: int = 5                # words in a shingle
    threshold: int = 80           # percent
    bands: int = 40
    rows: int = 6
    sketch_bits: int = 4096       # a multiple of 64
    universe_bits: int = 20
    seed: int = 7

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def differing_bits(self) -> int:
        """Most differing sketch bits of a linked pair: mean and 4.5 standard deviations."""
        share = (1 - self.threshold / 100) / 2
        return math.ceil(self.sketch_bits * share + 4.5 * math.sqrt(self.sketch_bits * share * (1 - share)))


_TABLES: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def permutations(p: MinHash) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second one continued circularly (kept per process)."""
    key = (p.universe_bits, p.seed, max(p.coordinates, p.sketch_bits))
    if key not in _TABLES:
        rng = np.random.Generator(np.random.PCG64(p.seed))
        first = rng.permutation(1 << p.universe_bits).astype(np.int32)
        second = rng.permutation(1 << p.universe_bits).astype(np.int32)
        _TABLES[key] = first, np.concatenate((second, second[: key[2]]))
    return _TABLES[key]


def signature(shingles: np.ndarray, p: MinHash, coordinates: int | None = None) -> np.ndarray:
    """The first ``coordinates`` (all of the bands') of one non-empty set."""
    coordinates = coordinates or p.coordinates
    first, second = permutations(p)
    places = first[(shingles >> np.uint64(64 - p.universe_bits)).astype(np.int64)]
    stretches = np.lib.stride_tricks.sliding_window_view(second, coordinates)
    out = np.full(coordinates, 1 << p.universe_bits, np.int32)
    step = max(1, (1 << 18) // coordinates)
    for lo in range(0, len(places), step):
        np.minimum(out, stretches[places[lo: lo + step]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, p: MinHash) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of the key)."""
    rows = sig.astype(np.uint64).reshape(p.bands, p.rows)
    key = np.arange(1, p.bands + 1, dtype=np.uint64)
    for k in range(p.rows):
        key = tb.mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def sketch(sig: np.ndarray, p: MinHash) -> np.ndarray:
    """The lowest bit of ``sketch_bits`` coordinates, as 64-bit numbers."""
    bits = sig[: p.sketch_bits] & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    values = tb.byte_values(WORD_SEED)
    data, offsets = tb.flat(texts)
    for lo, hi in tb.slices(offsets):
        part, off = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        starts, ends, first = tb.word_spans(part, off, tb.SPACE_SEPARATED)
        words = tb.run_hashes(part, starts, ends, values)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(tb.shingle_hashes(words[a:b], width))


def _lists(rows: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _signed(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, text_key, n_shingles, set_key, bands)."""
    for batch in batches:
        sizes, keys, bands = [], [], []
        for shingles in shingle_sets(batch.column("text"), p.width):
            sizes.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            bands.append(band_keys(signature(shingles, p), p) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.binary()), _lists(bands, pa.int64())],
            names=["doc_id", "text_key", "n_shingles", "set_key", "bands"])


def _with_sets(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, shingles, bands, sketch); a row that repeats its predecessor is left out."""
    last = None
    for batch in batches:
        nodes = batch.column("node").to_pylist()
        new = [k for k, node in enumerate(nodes) if node != (nodes[k - 1] if k else last)]
        last = nodes[-1] if nodes else last
        sets = list(shingle_sets(batch.column("text").take(pa.array(new, pa.int64())), p.width))
        longest = max(p.coordinates, p.sketch_bits)
        sigs = [signature(s, p, longest) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(pa.array(new, pa.int64())), _lists([s.view(np.int64) for s in sets], pa.int64()),
             _lists([band_keys(s[: p.coordinates], p) for s in sigs], pa.int64()),
             _lists([sketch(s, p) for s in sigs], pa.int64())], names=["node", "shingles", "bands", "sketch"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that are linked on their full sets.

    Members are dealt over salts, and a set ``a`` goes only to the salts that its members use.
    """
    pairs = pairs.withColumn("salt", salt_of("b", salts=PIVOT_SALTS))
    left = (pairs.select("a", "salt").distinct()
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a"))
    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    whole = F.size("set_a") + F.size("set_b") - shared
    return left.join(right, ["a", "salt"]).where(100 * shared >= threshold * whole).select("a", "b")


# step 2: tiles ------------------------------------------------------------------------------
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each tile (bucket, lo, hi), of rows sorted by that."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "lo", "hi")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if held and tuple(keys[0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip([0, *cuts], [*cuts, len(keys)]):
            if start:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
        last = tuple(keys[-1])
    if held:
        yield pa.Table.from_batches(held)


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """[rows, numbers] of a list column of equal lengths."""
    flat = lists.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _may_pair(tile: pa.Table, threshold: int) -> np.ndarray:
    """[members, members] above the diagonal: of different components, of sizes that allow a link and,
    in a tile of two chunks, of different chunks."""
    n, roots, chunks = (tile.column(c).to_numpy() for c in ("n", "root_key", "chunk"))
    lo, hi = tile.column("lo")[0].as_py(), tile.column("hi")[0].as_py()
    out = np.triu(roots[:, None] != roots[None, :], 1)
    out &= (100 * n[:, None] >= threshold * n[None, :]) & (100 * n[None, :] >= threshold * n[:, None])
    if lo != hi:
        out &= chunks[:, None] != chunks[None, :]
    return out


def _alike(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """Tiles with sketches -> (bucket, node) of members that some other one may be linked with."""
    for tile in _runs(batches):
        may = _may_pair(tile, p.threshold)
        if not may.any():
            continue
        sketches, bands = _matrix(tile.column("sketch")).view(np.uint64), _matrix(tile.column("bands"))
        bucket, found = tile.column("bucket")[0].as_py(), np.zeros(tile.num_rows, bool)
        for lo in range(0, tile.num_rows, ROWS_AT_ONCE):
            x, y = np.nonzero(may[lo: lo + ROWS_AT_ONCE])
            x += lo
            close = np.bitwise_count(sketches[x] ^ sketches[y]).sum(axis=1) <= p.differing_bits
            x, y = x[close], y[close]
            first = (bands[x] == bands[y]).argmax(axis=1)
            here = bands[x, first] == bucket
            found[x[here]] = found[y[here]] = True
        kept = tile.column("node").filter(pa.array(found))
        if len(kept):
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(kept), pa.int64()), kept.combine_chunks()],
                                             names=["bucket", "node"])


def intersections(sets: pa.ChunkedArray) -> np.ndarray:
    """[members, members]: how many shingles each two sets share."""
    flat = sets.combine_chunks()
    rows = np.repeat(np.arange(len(flat)), flat.value_lengths().to_numpy())
    _, codes, counts = np.unique(flat.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = counts > 1
    order = np.argsort(codes[shared[codes]], kind="stable")
    rows, codes = rows[shared[codes]][order], (np.cumsum(shared) - 1)[codes[shared[codes]][order]]
    out = np.zeros((len(flat), len(flat)), np.int64)
    for slab in range(0, int(shared.sum()), SLAB):
        a, b = np.searchsorted(codes, [slab, slab + SLAB])
        dense = np.zeros((len(flat), min(SLAB, int(shared.sum()) - slab)), np.float32)
        dense[rows[a:b], codes[a:b] - slab] = 1
        out += (dense @ dense.T).astype(np.int64)
    return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix ``linked`` connects, fewer than its rows."""
    out, fresh = [], linked.any(axis=1)
    for start in np.flatnonzero(fresh):
        queue = [int(start)] if fresh[start] else []
        fresh[start] = False
        while queue:
            x = queue.pop()
            new = np.flatnonzero(linked[x] & fresh)
            fresh[new] = False
            out += [(x, int(y)) for y in new]
            queue += new.tolist()
    return out


def _links(batches: Iterator[pa.RecordBatch], p: MinHash) -> Iterator[pa.RecordBatch]:
    """Tiles with full sets -> links (a, b) that span their linked members."""
    for tile in _runs(batches):
        may = _may_pair(tile, p.threshold)
        if not may.any():
            continue
        n, both = tile.column("n").to_numpy(), intersections(tile.column("shingles"))
        linked = may & (100 * both >= p.threshold * (n[:, None] + n[None, :] - both))
        pairs = spanning(linked | linked.T)
        if pairs:
            nodes = tile.column("node").combine_chunks()
            a, b = (nodes.take(pa.array(c, pa.int64())) for c in zip(*pairs))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def _tiled(members: DataFrame, sets: DataFrame, column: list[str], most_shingles: int | None = None) -> DataFrame:
    """``members`` (bucket, node, n, root_key; stored) dealt into tiles with columns of ``sets``, tile by tile.

    A component of more than a chunk's members has chunks of its own, which never meet each other;
    all smaller ones share the bucket's first chunks, which meet all.  So a bucket of one large
    component and few others costs few more rows than it has members.
    """
    def chunks(count: str, total: str):
        by_rows = F.ceil(F.col(count) / TILE_MEMBERS)
        return F.greatest(by_rows, F.ceil(F.col(total) / most_shingles)) if most_shingles else by_rows
    sizes = (members.groupBy("bucket", "root_key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("t"))
             .withColumn("parts", chunks("c", "t")))
    shared = (sizes.groupBy("bucket").agg(*[F.sum(F.when(F.col("parts") == 1, F.col(x)).otherwise(0)).alias(x) for x in ("c", "t")],
                                          F.sum(F.when(F.col("parts") > 1, F.col("parts")).otherwise(0)).alias("own"))
              .select("bucket", chunks("c", "t").alias("pool"), "own"))
    # most buckets are one tile: their members are not copied
    salted, wanted = members.withColumn("salt", salt_of("node")), sets.select("node", *column)
    single = (salted.join(shared.where("pool + own = 1").select("bucket", every_salt().alias("salt")), ["bucket", "salt"])
              .join(wanted, "node")
              .select("bucket", *[F.lit(0).alias(c) for c in ("lo", "hi", "chunk")], "node", "n", "root_key", *column))
    before = Window.partitionBy("bucket").orderBy("root_key").rowsBetween(Window.unboundedPreceding, -1)
    large = (sizes.where("parts > 1").select("bucket", "root_key", "parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first"),
                                             every_salt().alias("salt")))
    dealt = (salted.join(shared.where("pool + own > 1").withColumn("salt", every_salt()), ["bucket", "salt"])
             .join(large, ["bucket", "root_key", "salt"], "left")
             .withColumn("first", F.when(F.col("parts").isNull(), 0).otherwise(F.col("pool") + F.col("first")))
             .withColumn("own_parts", F.coalesce("parts", "pool"))
             .withColumn("chunk", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("own_parts"))).cast("int")))
    met = F.filter(F.sequence(F.lit(0), (F.col("pool") + F.col("own") - 1).cast("int")), lambda k: F.col("parts").isNull()
                   | (k < F.col("first")) | (k >= F.col("first") + F.col("parts")))
    tile = F.explode(F.transform(met, lambda k: F.struct(F.least(k, F.col("chunk")).alias("lo"),
                                                         F.greatest(k, F.col("chunk")).alias("hi"))))
    copied = (dealt.join(wanted, "node").withColumn("tile", tile)
              .select("bucket", "tile.lo", "tile.hi", "chunk", "node", "n", "root_key", *column))
    keys = ["bucket", "lo", "hi"]
    return single.unionByName(copied).repartition(*keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, params: MinHash = MinHash(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    p = params
    texts = docs.select(named(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    signed = scratch.store(texts.mapInArrow(
        lambda batches: _signed(batches, p),
        "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>"))

    # classes of equal sets; `short` stands for a class where 64 bits do, in the bands
    classes = scratch.store(
        signed.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("set_key").alias("node"))
        .agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("n_docs"),
             F.first("n_shingles").alias("n"))
        .select("node", F.xxhash64("node").alias("short"), F.col("first.doc_id").alias("rep"),
                F.col("first.text_key").alias("rep_key"), "n_docs", "n"))
    in_band = (signed.where(F.col("doc_id").isNotNull())
               .select(F.xxhash64("set_key").alias("short"), F.explode("bands").alias("bucket")))
    shared = (in_band.groupBy("bucket").agg(F.min("short").alias("lo"), F.max("short").alias("hi"))
              .where("lo != hi").select("bucket", every_salt().alias("salt")))
    members = scratch.store(
        in_band.withColumn("salt", salt_of("short")).join(shared, ["bucket", "salt"])
        .select("bucket", "short").distinct()
        .join(classes, "short").select("bucket", "node", "n", "rep", "rep_key"))

    # the full sets (and sketches) of the classes in shared buckets
    wanted = members.select("node", F.col("rep").alias("doc_id"), F.col("rep_key").alias("text_key")).distinct()
    sets = scratch.store(
        texts.join(wanted, ["doc_id", "text_key"]).select("node", "text")
        .mapInArrow(lambda batches: _with_sets(batches, p),
                    "node binary, shingles array<long>, bands array<long>, sketch array<long>"))

    def sizes_allow(x: str, y: str):
        return (100 * F.col(x) >= p.threshold * F.col(y)) & (100 * F.col(y) >= p.threshold * F.col(x))

    # step 1: each member against the pivot of its bucket
    pivots = (members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("pivot"))
              .select("bucket", F.col("pivot.node").alias("a"), F.col("pivot.n").alias("a_n"),
                      every_salt().alias("salt")))
    stars = (members.withColumn("salt", salt_of("node")).join(pivots, ["bucket", "salt"])
             .where((F.col("node") != F.col("a")) & sizes_allow("n", "a_n"))
             .select("a", F.col("node").alias("b")).distinct())
    star_links = scratch.store(_verified(stars, sets, p.threshold))
    roots = connected_components(star_links, scratch)

    # step 2: buckets that hold several components
    rooted = (members.select("bucket", "node", "n").join(roots, "node", "left")
              .select("bucket", "node", "n", F.xxhash64(F.coalesce("root", "node")).alias("root_key")))
    mixed = (rooted.groupBy("bucket").agg(F.min("root_key").alias("lo"), F.max("root_key").alias("hi"))
             .where("lo != hi").select("bucket", every_salt().alias("salt")))
    across = scratch.store(rooted.withColumn("salt", salt_of("node")).join(mixed, ["bucket", "salt"]).drop("salt"))
    alike = scratch.store(_tiled(across, sets, ["sketch", "bands"])
                          .mapInArrow(lambda batches: _alike(batches, p), "bucket long, node binary").distinct())
    kept = scratch.store(across.join(alike, ["bucket", "node"]))
    crossing = scratch.store(_tiled(kept, sets, ["shingles"], TILE_SHINGLES)
                             .mapInArrow(lambda batches: _links(batches, p), "a binary, b binary"))
    links = star_links.union(crossing)
    roots = connected_components(links, scratch)
    scratch.drop(members, sets, across, alike, kept, crossing, star_links)

    # the smallest id of each component, then of each class that has more than one document
    least = (roots.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("component_id"))
             .withColumn("salt", every_salt()))
    linked = (roots.withColumn("salt", salt_of("node")).join(least, ["root", "salt"])
              .select("node", "component_id"))
    grouped = (classes.select("node", "rep", "n_docs").join(linked, "node", "left")
               .where("n_docs > 1 or component_id is not null")
               .select(F.col("node").alias("set_key"), F.coalesce("component_id", "rep").alias("component_id"),
                       every_salt().alias("salt")))
    return (signed.withColumn("salt", salt_of("doc_id")).join(grouped, ["set_key", "salt"], "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
            .select("doc_id", "text_key", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
