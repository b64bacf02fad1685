"""Merkle-tree fingerprints of documents.

A text is a tree: the root covers sections, a section covers paragraphs (lines), and a
paragraph covers pieces of some words.  Piece and section ends are chosen by content (a hash
of the bytes before a space; a paragraph's own hash), so an edit changes the hashes on its
own branch and leaves the other branches as they are.  Hashes are BLAKE2b over the children's
hashes with a level tag; equal texts have equal roots, and unequal roots mean unequal texts.

The fingerprint of a text is the root hash; :func:`likeness` descends two trees from the
root and passes over equal branches, so only differing branches are opened, and
:func:`edited_spans` gives the character spans that have no counterpart.

``compare_neighbours`` fingerprints every text, its successor's text and a caller's edit of
the two.  At scale: texts are shuffled once, into blocks of consecutive order keys (id, then the
text's hash, so null ids or one repeated id are many blocks too; only equal rows stay together).
A block begins at a row drawn from a sample of keys, found for each row by bisection, and is one
task's partition.  The first row of a block is also sent to the block before it, so each task
sees every pair it needs while it streams its sorted rows: it holds one Arrow batch of texts
(``spark.sql.execution.arrow.maxRecordsPerBatch``) and the trees of two of them at a time.

Defined results: null text = empty text (one empty paragraph); null ids come last in the
descending order; rows that repeat an id are ordered by their text's hash; the last row's
successor is the first row (a single row is its own); an empty table gives no rows.  Only
the named columns are read, so further columns may have any name.  The table is read three times
(count, sample, texts), so write an input first that can change between reads.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerprofile.llm.columns import named, text_of
from ledgerprofile.session import ship
from ledgerprofile.llm.textbytes import byte_values

PIECE_MASK = 3       # one piece end in 4 spaces on average
PIECE_BYTES = 64     # a longer run without such an end is cut at multiples of this
SAMPLED_KEYS = 64    # order keys sampled for each block
SECTION_MASK = 3     # one section end in 4 paragraphs on average
_VALUES = (byte_values(11, fold_ascii=False) >> np.uint64(40)).astype(np.uint32)


def _hash(tag: bytes, content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16, person=tag).digest()


@dataclass(slots=True)
class Tree:
    """Node hashes by level; ``*_first`` give the index of a node's first child (and an end)."""

    root: bytes
    sections: list[bytes]
    section_first: list[int]      # first paragraph of each section, and the end
    paragraphs: list[bytes]
    paragraph_first: list[int]    # first piece of each paragraph, and the end
    pieces: list[bytes]
    piece_ends: list[int]         # byte end of each piece; pieces follow one another

    @property
    def fingerprint(self) -> str:
        return self.root.hex()


def merkle_tree(text: str) -> Tree:
    """The tree of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    n = len(data)
    # a paragraph ends after each newline (and at the end of the text); pieces end there too,
    # and after a space if a hash of the four bytes before it says so
    newline = data == 10
    ends = newline.copy()
    if n > 4:
        v = _VALUES[data]
        mixed = v[3:-1] * np.uint32(0x9E3779B1) + v[2:-2] * np.uint32(0x85EBCA6B) \
            + v[1:-3] * np.uint32(0xC2B2AE35) + v[:-4] * np.uint32(0x27D4EB2F)
        ends[4:] |= (data[4:] == 32) & ((mixed >> np.uint32(15)) & np.uint32(PIECE_MASK) == 0)
    piece_ends = np.append(np.flatnonzero(ends) + 1, n)   # after a last newline: an empty piece
    if n and ends[-1] and raw[-1] != 10:
        piece_ends = piece_ends[:-1]
    lines = np.append(np.flatnonzero(newline) + 1, n)
    begins = np.concatenate(([0], piece_ends[:-1]))
    more = np.maximum(piece_ends - begins - 1, 0) // PIECE_BYTES
    if more.any():
        nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        piece_ends = np.sort(np.concatenate((piece_ends, np.repeat(begins, more) + nth * PIECE_BYTES)))
    piece_ends = piece_ends.tolist()
    pieces, at = [], 0
    for end in piece_ends:
        pieces.append(hashlib.blake2b(raw[at:end], digest_size=16, person=b"piece").digest())
        at = end
    joined = b"".join(pieces)
    paragraph_first = [0, *np.searchsorted(piece_ends, lines, "right").tolist()]
    paragraph_first[-1] = len(pieces)
    paragraphs = [_hash(b"paragraph", joined[16 * a: 16 * b])
                  for a, b in zip(paragraph_first, paragraph_first[1:])]
    section_first = [0, *(k + 1 for k, h in enumerate(paragraphs[:-1]) if h[0] & SECTION_MASK == 0), len(paragraphs)]
    sections = [_hash(b"section", b"".join(paragraphs[a:b])) for a, b in zip(section_first, section_first[1:])]
    return Tree(_hash(b"root", b"".join(sections)), sections, section_first, paragraphs, paragraph_first,
                pieces, piece_ends)


def _unmatched(mine: list[bytes], theirs: list[bytes]) -> list[int]:
    """Indices of ``mine`` that remain when equal hashes of both are paired off."""
    left = Counter(theirs)
    out = []
    for k, h in enumerate(mine):
        if left.get(h, 0):
            left[h] -= 1
        else:
            out.append(k)
    return out


def _differing(a: Tree, b: Tree) -> tuple[list[int], list[int]]:
    """Pieces of a and of b without a counterpart, found by descending from the roots."""
    if a.root == b.root:
        return [], []
    sa, sb = _unmatched(a.sections, b.sections), _unmatched(b.sections, a.sections)
    pa_ = [p for s in sa for p in range(a.section_first[s], a.section_first[s + 1])]
    pb_ = [p for s in sb for p in range(b.section_first[s], b.section_first[s + 1])]
    ha, hb = [a.paragraphs[p] for p in pa_], [b.paragraphs[p] for p in pb_]
    pa_, pb_ = [pa_[k] for k in _unmatched(ha, hb)], [pb_[k] for k in _unmatched(hb, ha)]
    la = [x for p in pa_ for x in range(a.paragraph_first[p], a.paragraph_first[p + 1])]
    lb = [x for p in pb_ for x in range(b.paragraph_first[p], b.paragraph_first[p + 1])]
    ha, hb = [a.pieces[x] for x in la], [b.pieces[x] for x in lb]
    return [la[k] for k in _unmatched(ha, hb)], [lb[k] for k in _unmatched(hb, ha)]


def _bytes(tree: Tree, pieces: list[int]) -> int:
    return sum(tree.piece_ends[k] - (tree.piece_ends[k - 1] if k else 0) for k in pieces)


def likeness(a: Tree, b: Tree) -> float:
    """Share of both texts' bytes that lies in branches found in both (1.0: equal roots)."""
    if a.root == b.root:
        return 1.0
    total = a.piece_ends[-1] + b.piece_ends[-1]
    da, db = _differing(a, b)
    return max(0.0, 1.0 - (_bytes(a, da) + _bytes(b, db)) / total) if total else 0.0


def edited_spans(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Byte spans of ``a`` in branches that ``b`` lacks, neighbours merged."""
    out: list[tuple[int, int]] = []
    for k in _differing(a, b)[0]:
        lo, hi = (a.piece_ends[k - 1] if k else 0), a.piece_ends[k]
        if out and out[-1][1] == lo:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def splice_half(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_sections int, n_paragraphs int, n_edited_spans int")


def _compared(batches: Iterator[pa.RecordBatch], edit: Callable[[str, str], str]) -> Iterator[pa.RecordBatch]:
    """Stream of sorted rows (block, ahead, doc_id, text): each own row meets the row after it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_sections", pa.int32()),
                        ("n_paragraphs", pa.int32()), ("n_edited_spans", pa.int32())])
    waiting = None   # (block, doc_id, text, tree) of the row whose successor comes next
    for batch in batches:
        out = []
        for block, ahead, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if waiting is None and ahead:
                continue
            tree = merkle_tree(text)
            if waiting is not None and waiting[0] == block:
                _, own_id, own, own_tree = waiting
                edited = edit(own, text)
                edited_tree = merkle_tree(edited)
                out.append((own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            own_tree.fingerprint, edited_tree.fingerprint, likeness(own_tree, edited_tree),
                            likeness(own_tree, tree), len(own_tree.sections), len(own_tree.paragraphs),
                            len(edited_spans(own_tree, edited_tree))))
            waiting = None if ahead else (block, doc_id, text, tree)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
            list(zip(*out)) if out else [[]] * len(schema), schema)], schema=schema)


def _order_key(text_key: Column) -> Column:
    """Ascending order of the rows: ids from the largest, null ids last, then the text's hash."""
    doc_id = F.col("doc_id")
    return F.struct(doc_id.isNull().alias("no_id"), F.coalesce(F.bitwise_not(doc_id), F.lit(0).cast("long")).alias("down"),
                    text_key.alias("text_key"))


def _literal(key: tuple) -> Column:
    no_id, down, text_key = key
    return F.struct(F.lit(no_id).alias("no_id"), F.lit(down).cast("long").alias("down"),
                    F.lit(text_key).cast("long").alias("text_key"))


def _cuts(keys: DataFrame, n_blocks: int) -> tuple[tuple | None, list[tuple]]:
    """The first key, and the keys at which blocks 1, 2, ... begin: evenly spaced ones of a sample."""
    n, first = keys.agg(F.count(F.lit(1)), F.min("key")).first()
    if not n:
        return None, []
    sample = keys.sample(min(1.0, SAMPLED_KEYS * n_blocks / n), 17).select("key.*").collect()
    drawn = sorted(tuple(r) for r in sample)
    wanted = {drawn[k * len(drawn) // n_blocks] for k in range(1, n_blocks)} if drawn else set()
    return tuple(first), sorted(wanted - {tuple(first)})


def _target(block: Column, ahead: bool) -> Column:
    return F.struct(block.cast("int").alias("block"), F.lit(ahead).alias("ahead"))


def _bisected(key: Column, bounds: Column, n: int) -> Column:
    """How many of the ``n`` ascending bounds are at most ``key``."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(bounds, at + step - 1) <= key, at + step).otherwise(at))


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       edit: Callable[[str, str], str] = splice_half, n_blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text and of ``edit(text, next text)``, next in descending id order.

    ``near_edited`` and ``near_next`` are the likeness of the text's tree to the edited
    text's and to the next document's.  ``n_blocks`` defaults to the session's shuffle
    partitions; ``SAMPLED_KEYS`` keys for each of them come to the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    n_blocks = n_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    rows = rows.select("doc_id", "text", _order_key(F.xxhash64("text")).alias("key"))
    first, cuts = _cuts(rows.select("key"), n_blocks)
    last, block, key = len(cuts), F.lit(0), F.col("key")
    targets = [F.when(key == _literal(first), _target(F.lit(last), True))] if first else []
    if cuts:
        bounds = F.array(*[_literal(c) for c in cuts])
        block = _bisected(key, bounds, last)
        targets.append(F.when(F.get(bounds, F.col("own") - 1) == key, _target(F.col("own") - 1, True)))
    rows = rows.withColumn("own", block)
    dealt = (rows.withColumn("to", F.explode(F.array_compact(F.array(_target(F.col("own"), False), *targets))))
             .select("to.block", "to.ahead", "doc_id", "key", "text")
             .repartitionById(last + 1, F.col("block"))
             .sortWithinPartitions("ahead", "key"))
    return dealt.select("block", "ahead", "doc_id", "text").mapInArrow(lambda b: _compared(b, edit), SCHEMA)
