"""Benchmark passages in documents, by a prefix-filtered set join.

Every ``window`` consecutive words of a benchmark item make a window (an item of fewer words
is one window).  A window is the set of its word shingles; a text holds the window only if
it holds all of them, so of each window's shingles, ordered by rarity in the documents, one
prefix token - the rarest - must occur.  The join is on that token; its place in the window
and in the text gives the only stretch of words that can match, the stretch must lie inside
the text (length and positional bounds), and the words of the stretch are compared one by
one.  All words inside any occurrence are hit.

Windows that several items share are one window with a list of items.

At scale: one pass counts the items' shingles in all documents (task sums, then a sum per
shingle), a second pass joins.  The benchmark is handled in blocks of about ``block_bytes``
of text; each is broadcast by itself, applied to all documents and released, and what it finds is
stored by the text's digest, so a large benchmark costs more passes and no more memory.  The
stored finds (texts with a passage only) meet the documents at the end.  A single block needs no
such table.  Documents are not shuffled for the search and a task holds one slice of texts,
whatever the number of copies or frequent passages.

Words are compared as 64-bit hashes of their lower-cased bytes.

Defined results: null or wordless texts have no words and no hits; null or wordless items
make no windows; a null item id counts as the empty string, items that repeat an id count
as one; rows that repeat are treated one by one; empty tables give no rows or no hits; extra
columns are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import named, packed, text_of
from ledgerprofile.llm.components import SALTS, every_salt
from ledgerprofile.session import Scratch, ship

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 1 << 20        # its windows are about 20 times as large
WORD_SEED = 613


def words_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word hashes, index of each text's first word) of consecutive slices of texts."""
    values = tb.byte_values(WORD_SEED)
    data, offsets = tb.flat(texts)
    for lo, hi in tb.slices(offsets):
        part, off = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        starts, ends, first = tb.word_spans(part, off, tb.ALPHANUMERIC)
        yield tb.run_hashes(part, starts, ends, values), first


@dataclass
class Block:
    """Distinct windows of some items; ``words[w, :sizes[w]]`` are the words of window ``w``."""

    words: np.ndarray
    sizes: np.ndarray
    names: list[str]          # distinct item ids
    first: np.ndarray         # the items of window w are items[first[w]: first[w + 1]], numbers of names
    items: np.ndarray
    shingles: np.ndarray      # distinct shingle hashes of all windows
    widths: np.ndarray        # the shingle widths that occur (short items have shorter ones)
    prefix: np.ndarray | None = None   # prefix token of each window, an index of `shingles`
    place: np.ndarray | None = None    # its place in the window


def _width(size: int) -> int:
    return min(SHINGLE, size)


def _stretch_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (too few words left: none)."""
    return tb.shingle_hashes(words, width) if len(words) >= width else words[:0]


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """[windows, shingles]: the shingle hashes of windows of ``size`` words."""
    width = _width(size)
    ends = np.zeros(width - 1, np.uint64)                     # so that each word begins a stretch
    hashes = _stretch_hashes(np.concatenate((words[:, :size].ravel(), ends)), width)
    return hashes.reshape(-1, size)[:, : size - width + 1]


def make_block(item_ids: list[str], texts: list[str], window: int) -> Block:
    names = sorted(set(item_ids))
    number = {name: k for k, name in enumerate(names)}
    tables, sizes, items, at = [np.zeros((0, window), np.uint64)], [], [], 0
    for words, first in words_of(pa.array(texts, pa.string())):
        for a, b in zip(first[:-1], first[1:]):
            size = min(window, int(b - a))
            if size:
                rows = np.lib.stride_tricks.sliding_window_view(words[a:b], size)
                tables.append(np.pad(rows, ((0, 0), (0, window - size))))
                sizes += [size] * len(rows)
                items += [number[item_ids[at]]] * len(rows)
            at += 1
    keyed = np.column_stack((np.concatenate(tables), np.array(sizes, np.uint64)))
    distinct, which = np.unique(keyed, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack((which.ravel(), np.array(items, np.int64))), axis=0)
    table, sizes = distinct[:, :window], distinct[:, window].astype(np.int64)
    kinds = np.unique(sizes)
    hashes = [np.unique(_window_hashes(table[sizes == size], int(size))) for size in kinds]
    return Block(table, sizes, names, np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)), pairs[:, 1],
                 np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64),
                 np.unique([_width(int(s)) for s in kinds]).astype(np.int64))


def choose_prefixes(block: Block, counts: np.ndarray) -> Block:
    """Order shingles by rarity (then hash) and keep each window's first one."""
    rank = np.empty(len(counts), np.int64)
    rank[np.lexsort((block.shingles, counts))] = np.arange(len(counts))
    prefix, place = np.zeros(len(block.sizes), np.int64), np.zeros(len(block.sizes), np.int64)
    for size in np.unique(block.sizes):
        some = np.flatnonzero(block.sizes == size)
        at = np.searchsorted(block.shingles, _window_hashes(block.words[some], int(size)))
        place[some] = np.argmin(rank[at], axis=1)
        prefix[some] = at[np.arange(len(some)), place[some]]
    block.prefix, block.place = prefix, place
    return block


def _token_places(words: np.ndarray, width: int, index: tb.HashIndex) -> tuple[np.ndarray, np.ndarray]:
    """(word index, shingle index) of every stretch of ``width`` words that is in the index."""
    rows = index.find(_stretch_hashes(words, width))
    at = np.flatnonzero(rows >= 0)
    return at, rows[at]


def _counted(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    index, counts = tb.HashIndex(block.shingles), np.zeros(len(block.shingles), np.int64)
    for batch in batches:
        for words, _ in words_of(batch.column("text")):
            for width in block.widths:
                counts += np.bincount(_token_places(words, int(width), index)[1], minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())],
                                     names=["shingle", "n"])


class Matcher:
    """Finds a block's windows in slices of texts."""

    def __init__(self, block: Block):
        self.block = block
        order = np.argsort(block.prefix, kind="stable")       # windows by prefix token
        self.by_prefix = order
        tokens, self.first = np.unique(block.prefix[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.index = tb.HashIndex(block.shingles[tokens])

    def occurrences(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word index, window) of all occurrences in the texts that begin at ``first``."""
        block, found = self.block, []
        for width in block.widths:
            at, token = _token_places(words, int(width), self.index)
            n = self.first[token + 1] - self.first[token]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = self.by_prefix[np.repeat(self.first[token], n) + nth]
            here = np.repeat(at, n)
            text = np.searchsorted(first, here, "right") - 1
            start = here - block.place[window]
            fits = (start >= first[text]) & (start + block.sizes[window] <= first[text + 1])
            start, window = start[fits], window[fits]
            for k in range(block.words.shape[1]):             # word by word, only what still agrees
                longer = block.sizes[window] > k
                same = ~longer
                same[longer] = words[start[longer] + k] == block.words[window[longer], k]
                start, window = start[same], window[same]
            found.append(np.stack([start, window]))
        both = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return both[0], both[1]

    def spans(self, words: np.ndarray, first: np.ndarray) -> list[list[dict]]:
        """Per text the hit stretches of each item, overlapping ones merged."""
        start, window = self.occurrences(words, first)
        text = np.searchsorted(first, start, "right") - 1
        out: list[list[dict]] = [[] for _ in range(len(first) - 1)]
        last: dict[tuple[int, int], dict] = {}
        block = self.block
        for t, s, w in zip(text.tolist(), start.tolist(), window.tolist()):
            lo = s - int(first[t])
            hi = lo + int(block.sizes[w])
            for item in block.items[block.first[w]: block.first[w + 1]].tolist():
                span = last.get((t, item))
                if span is not None and lo <= span["end"]:
                    span["end"] = max(span["end"], hi)
                else:
                    span = last[(t, item)] = {"item": block.names[item], "start": lo, "end": hi}
                    out[t].append(span)
        return out


SPANS = "array<struct<item: string, start: int, end: int>>"
_SPANS = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _finder(block) -> Column:
    """Column function: text -> struct(n_words, spans) for the block in a broadcast."""
    @F.arrow_udf(f"struct<n_words: long, spans: {SPANS}>")
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(block.value) if len(block.value.sizes) else None
        for texts in columns:
            n_words, spans = [], []
            for words, first in words_of(texts):
                n_words.append(np.diff(first))
                spans.extend(matcher.spans(words, first) if matcher else [[] for _ in range(len(first) - 1)])
            n_words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(spans, _SPANS)],
                                             ["n_words", "spans"])
    return find


def _hit_words(spans: Column) -> Column:
    """Number of words in the union of the spans."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        ordered, start,
        lambda t, s: F.struct((t["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(t["reach"], s["start"]))).alias("n"),
                              F.greatest(t["reach"], s["end"]).alias("reach")),
        lambda t: t["n"])


def _blocks(items: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> tuple[int, Iterator[Block]]:
    """How many blocks the items make, and the blocks one after the other."""
    rows = items.select(F.coalesce(named(item_col).cast("string"), F.lit("")).alias("item"),
                        text_of(items, text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))

    def blocks() -> Iterator[Block]:
        for k in range(n):
            part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).distinct().collect()
            yield make_block([r["item"] for r in part], [r["text"] for r in part], window)
    return n, blocks()


def _ranked(texts: DataFrame, block: Block) -> Block:
    """The block with its prefix tokens, by the counts of its shingles in all texts."""
    if not len(block.sizes):
        return block
    unranked = texts.sparkSession.sparkContext.broadcast(block)
    sums = (texts.mapInArrow(lambda b: _counted(b, unranked.value), "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).toArrow())         # the block's shingles at most
    unranked.unpersist()
    counts = np.zeros(len(block.shingles), np.int64)
    counts[sums.column("shingle").to_numpy()] = sums.column("n").to_numpy()
    return choose_prefixes(block, counts)


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``row`` (its columns), ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` and ``spans`` (item, first word, end) of the benchmark passages in it."""
    spark = docs.sparkSession
    ship(spark)
    context = spark.sparkContext
    texts = docs.select(text_of(docs, text_col).alias("text"))
    out = docs.select(packed(docs).alias("row"), text_of(docs, text_col).alias("text"))
    n_blocks, blocks = _blocks(items, item_col, item_text_col, window, block_bytes)
    if n_blocks == 1:
        out = out.withColumn("found", _finder(context.broadcast(_ranked(texts, next(blocks))))("text"))
    else:
        scratch, parts = Scratch(spark), []
        for block in blocks:
            held = context.broadcast(_ranked(texts, block))
            found = texts.select(F.md5("text").alias("digest"), _finder(held)("text").alias("found"))
            parts.append(scratch.store(found.where(F.size("found.spans") > 0)
                                       .groupBy("digest").agg(F.first("found.spans").alias("spans"))))
            held.unpersist()
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        gathered = every.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("more"))
        gathered = scratch.store(gathered)
        scratch.drop(*parts)
        nothing = _finder(context.broadcast(make_block([], [], window)))      # counts the words
        out = (out.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).withColumn("digest", F.md5("text"))
               .join(gathered.withColumn("salt", every_salt()), ["digest", "salt"], "left")
               .withColumn("found", nothing("text"))
               .select("row", F.struct(F.col("found.n_words").alias("n_words"),
                                       F.coalesce("more", F.col("found.spans")).alias("spans")).alias("found")))
    out = out.select("row", F.col("found.n_words").alias("n_words"), F.col("found.spans").alias("spans"))
    items = F.array_sort(F.array_distinct(F.col("spans.item")))
    return out.select("row", "n_words", _hit_words(F.col("spans")).alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "spans")


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words", one_in: int = 20) -> Column:
    """At least one word in ``one_in`` is hit."""
    return (F.col(n_hit) > 0) & (one_in * F.col(n_hit) >= F.col(n_words))
