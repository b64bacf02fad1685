"""Column helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name of theirs can clash."""
    return F.struct(*[named(c).alias(c) for c in docs.columns])


def unpacked(row: str, columns: list[str], replaced: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a packed row again, some of them replaced."""
    replaced = replaced or {}
    return [replaced.get(c, F.col(row)[c]).alias(c) for c in columns]


def text_of(docs: DataFrame, text_col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(named(text_col).cast("string"), F.lit(""))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id has the fold 0)."""
    return F.coalesce(F.crc32(named(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def hash_octave(order: str) -> Column:
    """How low a 64-bit hash is: 0 in the upper part, two more for each halving (0 to 120)."""
    place = F.shiftrightunsigned(order, 11) / F.lit(float(1 << 53))          # the hash as a number in [0, 1)
    return F.floor(-2 * F.log2(F.greatest(place, F.lit(2.0 ** -60)))).cast("int")


def bounded_sample(rows: DataFrame, by: str, order: list[str], limit: int,
                   counts: dict | None = None) -> DataFrame:
    """At most ``limit`` rows of each value of ``by``, the first ones in ``order``.

    ``order`` begins with a 64-bit hash.  Only the lowest octaves of the hash that hold ``limit``
    rows of a value are ranked: about ``limit`` rows however large the table is, or all copies of a
    row that is repeated more often (of which each task passes on ``limit`` at most).  So each value keeps
    ``limit`` rows, or all it has, however its rows repeat.
    ``counts`` are the rows of each (value, octave); they are counted if not given (``by`` is a class
    label with few values).
    """
    if counts is None:
        counts = {(r[0], r[1]): r[2] for r in rows.groupBy(by, hash_octave(order[0]).alias("_octave")).count().collect()}
    least: dict = {}
    held: dict = {}
    for (value, octave), n in sorted(((k, n) for k, n in counts.items() if k[0] is not None), key=lambda x: -x[0][1]):
        if held.get(value, 0) < limit:
            held[value] = held.get(value, 0) + n
            least[value] = octave
    if not least:
        return rows.limit(0)
    of_value = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    w = Window.partitionBy(by).orderBy(*order)
    return (rows.where(hash_octave(order[0]) >= of_value[F.col(by)])
            .withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit).drop("_rank"))
