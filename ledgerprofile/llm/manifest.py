"""Merkle manifest of a table, with proofs by checkpoint and recompute.

Each row's digest is a leaf.  The leaves of a group (language), in the order of their ids, carry
a tree of ``fanout`` children a node; the groups' subroots, in the order of the groups, carry
one more tree of the same kind, whose root stands for the whole table.  The last node of a level
may have fewer children, even one; a level of one node is the (sub)root.

Checkpoint and recompute: of the levels only the leaves and every ``stride``-th one are stored,
so the stored interior nodes are one in ``fanout ** stride`` leaves.  A stored node and the stored
nodes ``stride`` levels below it span an aligned subtree of bounded size.  Proofs are extracted
from the top: each aligned subtree's interior nodes are regenerated from its stored
descendants, the siblings on the way of each descendant are emitted in front of those of its
stored ancestor, and the interior nodes are discarded.

At scale: leaves are ranked inside their group by range partitions, with the partitions'
row counts as offsets, so a language with a third of all rows is spread over many tasks.  A task
holds one aligned subtree at a time.  Texts are read once and never shuffled.  The stored levels
stay in the checkpoint folder until :meth:`Manifest.drop`.

A digest is the lowercase hex sha256 of a text; nodes hash their children's hex digests one after
the other.  A leaf hashes its columns one after the other: ``-`` for null, otherwise the number
of UTF-8 bytes, ``:`` and the value as text.

Defined results: null groups are a group of their own, before all others; null ids come first;
rows that repeat an id stand in the order of their digests, exactly repeated rows are leaves of
their own; a group of one row has that leaf as subroot, a table of one group that subroot as
root; an empty table has no rows and no root.  Only the named columns are read, so further
columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm.columns import named
from ledgerprofile.session import Scratch, ship

FANOUT = 8
STRIDE = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# digests as columns ------------------------------------------------------------------------------
def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: tuple[str, ...] = COLUMNS, changed: dict[str, Column] | None = None) -> Column:
    """The digest of a row (binary); ``changed`` has other values of some columns."""
    changed = changed or {}
    return F.unhex(F.sha2(F.concat(*[encoded(changed.get(c, named(c))) for c in columns]), 256))


def hex_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_text(siblings: Column) -> Column:
    """All siblings of a proof, as hex, one after the other."""
    return F.array_join(F.transform(siblings, hex_digest), "")


def folded(leaf: Column, siblings: Column, places: Column) -> Column:
    """The root (hex) that a leaf digest and its proof give."""
    def up(below: Column, level: Column) -> Column:
        others, place = hex_digest(level["s"]), level["p"]
        return F.sha2(F.concat(F.substring(others, F.lit(1), place * 64), below,
                               F.substr(others, place * 64 + 1)), 256)
    levels = F.zip_with(siblings, places, lambda s, p: F.struct(s.alias("s"), p.alias("p")))
    return F.aggregate(levels, hex_digest(leaf), up)


# one aligned subtree -------------------------------------------------------------------------------
def parents(digests: list[bytes], fanout: int) -> list[bytes]:
    return [hashlib.sha256("".join(d.hex() for d in digests[k: k + fanout]).encode()).digest()
            for k in range(0, len(digests), fanout)]


def regenerated(digests: list[bytes], levels: int, fanout: int) -> list[list[bytes]]:
    """The subtree's levels, the stored descendants first, ``levels`` above them."""
    out = [digests]
    for _ in range(levels):
        out.append(parents(out[-1], fanout))
    return out


def way(levels: list[list[bytes]], at: int, fanout: int) -> tuple[list[bytes], list[int]]:
    """(siblings of each level, place among them) of descendant ``at``, below the subtree's top."""
    siblings, places = [], []
    for level in levels[:-1]:
        first = at - at % fanout
        siblings.append(b"".join(level[first: at]) + b"".join(level[at + 1: first + fanout]))
        places.append(at - first)
        at //= fanout
    return siblings, places


@dataclass(frozen=True)
class Shape:
    fanout: int = FANOUT
    stride: int = STRIDE

    @property
    def span(self) -> int:
        """Stored descendants of a stored node."""
        return self.fanout ** self.stride

    def height(self, n: Column) -> Column:
        """Levels above the leaves of a group of ``n``: the powers of the fanout below ``n``."""
        powers = [self.fanout ** k for k in range(64) if self.fanout ** k < 1 << 63]
        return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < n))


def _sorted(rows: pa.Table) -> pa.Table:
    return rows.sort_by("pos")


def _to_top(base: int, shape: Shape) -> Callable[[pa.Table], pa.Table]:
    return lambda rows: _top(rows, base, shape)


def _to_ways(base: int, shape: Shape) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda rows, ancestor: _ways(rows, ancestor, base, shape)


def _top(rows: pa.Table, base: int, shape: Shape) -> pa.Table:
    """The stored node above the stored nodes of one aligned subtree (level ``base``)."""
    rows = _sorted(rows)
    height = rows.column("height")[0].as_py()
    levels = regenerated(rows.column("digest").to_pylist(), min(shape.stride, height - base), shape.fanout)
    return pa.table({"grp": rows.column("grp").slice(0, 1), "pos": pa.array([rows.column("pos")[0].as_py() // shape.span]),
                     "height": pa.array([height], pa.int32()), "digest": pa.array(levels[-1], pa.binary())})


def _ways(rows: pa.Table, ancestor: pa.Table, base: int, shape: Shape) -> pa.Table:
    """The rows of one aligned subtree with their proofs, given that of the stored node above."""
    rows = _sorted(rows)
    siblings, places = [], []
    if rows.num_rows:
        above = ancestor.slice(0, 1).to_pylist()[0]
        height = rows.column("height")[0].as_py()
        levels = regenerated(rows.column("digest").to_pylist(), min(shape.stride, height - base), shape.fanout)
        for at in range(rows.num_rows):
            own, place = way(levels, at, shape.fanout)
            siblings.append(own + above["siblings"])
            places.append(place + above["places"])
    return (rows.drop_columns(["block"]).append_column("siblings", pa.array(siblings, pa.list_(pa.binary())))
            .append_column("places", pa.array(places, pa.list_(pa.int32()))))


# trees -------------------------------------------------------------------------------------------
def _placed(rows: DataFrame, order: list[str], scratch: Scratch, shape: Shape) -> DataFrame:
    """``rows`` (grp, ...), stored, with their 0-based ``pos`` in the group and the group's ``height``."""
    ordered = scratch.store(rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
                            .withColumn("at", F.monotonically_increasing_id())
                            .withColumn("part", F.shiftright("at", 33)))
    stretches = ordered.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n_part"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select("grp", "part", shape.height(F.sum("n_part").over(group)).alias("height"),
                               (F.coalesce(F.sum("n_part").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = scratch.store(ordered.join(offsets, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
                           .drop("at", "part", "shift"))
    scratch.drop(ordered)
    return placed


def _stored_levels(leaves: DataFrame, scratch: Scratch, shape: Shape) -> list[DataFrame]:
    """The leaves and every ``stride``-th level above, up to the tallest group's top."""
    levels = [leaves]
    height = leaves.agg(F.max("height")).first()[0] or 0
    for base in range(0, height, shape.stride):
        below = levels[-1].where(F.col("height") > base).select("grp", "pos", "height", "digest")
        levels.append(scratch.store(
            below.withColumn("block", F.expr(f"pos div {shape.span}")).groupBy("grp", "block")
            .applyInArrow(_to_top(base, shape), "grp string, pos long, height int, digest binary")))
    return levels


def _tops(levels: list[DataFrame], shape: Shape) -> DataFrame:
    """(grp, digest): each group's top, taken from the stored level at or above its height."""
    out = None
    for k, level in enumerate(levels):
        top = level.where((F.col("height") <= k * shape.stride) & (F.col("height") > (k - 1) * shape.stride)).select("grp", "digest")
        out = top if out is None else out.unionByName(top)
    return out


def _proofs(levels: list[DataFrame], tops: DataFrame, scratch: Scratch, shape: Shape) -> DataFrame:
    """The leaves with ``siblings`` and ``places``; ``tops`` has those of each group's top."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        base = k * shape.stride
        level = levels[k]
        is_top = F.col("height") <= base
        rows = level.where(is_top).join(tops.select("grp", "siblings", "places"), "grp").select(*level.columns, "siblings", "places")
        if above is not None:
            fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in level.schema)
            below = level.where(~is_top).withColumn("block", F.expr(f"pos div {shape.span}"))
            ancestors = above.select("grp", F.col("pos").alias("block"), "siblings", "places")
            rows = rows.unionByName(
                below.groupBy("grp", "block").cogroup(ancestors.groupBy("grp", "block"))
                .applyInArrow(_to_ways(base, shape), f"{fields}, siblings array<binary>, places array<int>"))
        above = scratch.store(rows) if k else rows
    return above


class Manifest:
    """The stored levels of a table's trees: of its groups and of the tree above them."""

    def __init__(self, levels: list[DataFrame], top_levels: list[DataFrame], scratch: Scratch, shape: Shape):
        self.levels, self.top_levels, self.scratch, self.shape = levels, top_levels, scratch, shape
        root = _tops(top_levels, shape).select(hex_digest(F.col("digest"))).first()
        self.root: str | None = root[0] if root else None

    def subroots(self) -> DataFrame:
        """(grp, place, subroot): ``grp`` is ``=`` and the group's text, or nothing for null."""
        return self.top_levels[0].select(F.col("name").alias("grp"), F.col("pos").alias("place"), hex_digest(F.col("digest")).alias("subroot"))

    def proofs(self) -> DataFrame:
        """(id, carried columns, leaf, subroot, root, siblings, places) of every row.

        ``siblings`` has a binary for each level, from the leaf's to the root's children: the
        digests of the run's other nodes, left to right; ``places`` are the own places in the runs.
        """
        nothing = self.top_levels[0].sparkSession.createDataFrame([("", [], [])], "grp string, siblings array<binary>, places array<int>")
        tops = (_proofs(self.top_levels, nothing, self.scratch, self.shape)
                .select(F.col("name").alias("grp"), "digest", "siblings", "places"))
        tops = self.scratch.store(tops)
        rows = _proofs(self.levels, tops, self.scratch, self.shape)
        subroots = tops.select("grp", hex_digest(F.col("digest")).alias("subroot"))
        return (rows.join(subroots, "grp").withColumn("leaf", hex_digest(F.col("digest")))
                .withColumn("root", F.lit(self.root)).drop("grp", "pos", "height", "digest", "seq"))

    def drop(self) -> None:
        """Delete the stored levels; frames of this manifest must not be read again."""
        self.scratch.drop(*self.levels, *self.top_levels)


def build(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group_col: str = "lang", id_col: str = "doc_id",
          carried: dict[str, Column] | None = None, shape: Shape = Shape()) -> Manifest:
    """The manifest of ``docs``; ``carried`` columns come back with each row's proof."""
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    group = named(group_col).cast("string")
    leaves = scratch.store(docs.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("grp"),
        named(id_col).alias("id"), leaf_digest(columns).alias("digest"),
        F.monotonically_increasing_id().alias("seq"), *[c.alias(name) for name, c in (carried or {}).items()]))
    levels = _stored_levels(_placed(leaves, ["id", "digest", "seq"], scratch, shape), scratch, shape)
    scratch.drop(leaves)
    subroots = _tops(levels, shape).select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    top_levels = _stored_levels(_placed(subroots, ["name"], scratch, shape), scratch, shape)
    return Manifest(levels, top_levels, scratch, shape)
