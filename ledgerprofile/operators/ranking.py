"""Ranking: top-n per group (T1, T4) and top fraction of a whole table.

Ties are broken by the id ascending everywhere, so every cut is deterministic.

Top-n per group uses ``row_number() <= n``; Spark plans it with a partial
``WindowGroupLimit`` before the shuffle, so a group holding a third of all rows still
ships at most ``n`` rows per map task.

Top fraction keeps the ``k`` best rows of the whole table, where ``k`` follows from the row
count.  Small ``k`` uses Spark's bounded top-k (``TakeOrderedAndProject``: a k-row heap per
task, then one merge of tasks x k rows).  Large ``k`` never goes through one task and sorts nothing:
the value of the k-th row is found by counting rows in ``RANGES`` ranges and refining the one
that holds it, one pass each; ties at that value are refined by their ids' beginnings in the same
way.  What is left at the boundary is a bounded top-k, and all better rows are a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.session import checkpoint_dir

from ledgerprofile.functions.scalars import positive_finite

# Largest k served by the bounded top-k path; above it the distributed path runs.  The
# bounded path merges (tasks x k) rows in one final task, so k stays small.
BOUNDED_TOPK_LIMIT = 1_000
RANGES = 1_024   # ranges of a refinement
LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def _order(value: str, id_col: str, descending: bool) -> list[Column]:
    v = F.col(value)
    return [v.desc() if descending else v.asc(), F.col(id_col).asc()]


# T1 / T4 --------------------------------------------------------------------------------
def top_n_per_group(df: DataFrame, group: str | list[str], value: str, id_col: str, n: int,
                    descending: bool = True, rank_col: str | None = None) -> DataFrame:
    """The ``n`` best rows of every group by ``value`` (ties: lower id first)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*_order(value, id_col, descending))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


# T2 / T3 --------------------------------------------------------------------------------
def growth_cut(n: int, ratio: float) -> int:
    """Rows kept by the growth rule: all when n <= 1, else floor(n*ratio) + 1 (at most n)."""
    if n <= 1:
        return n
    return min(n, int(n * ratio) + 1)


def periodic_cut(n: int, ratio: float) -> int:
    """Rows kept by the periodic rule: all when n <= 2, else floor(n*ratio)."""
    if n <= 2:
        return n
    return min(n, int(n * ratio))


def check_ratio(ratio: float) -> float:
    if not 0.0 <= float(ratio) <= 1.0:
        raise ValueError(f"ratio must be in [0, 1], got {ratio}")
    return float(ratio)


def top_k(df: DataFrame, value: str, id_col: str, k: int, descending: bool = True,
          bounded_limit: int = BOUNDED_TOPK_LIMIT) -> DataFrame:
    """The ``k`` best rows of ``df`` by ``value`` (ties: lower id first), exactly."""
    order = _order(value, id_col, descending)
    if k <= 0:
        return df.limit(0)
    if k <= bounded_limit:
        return df.orderBy(*order).limit(k)
    return select_best(df, value, id_col, k, descending, max(1, bounded_limit))


def select_best(df: DataFrame, value: str, id_col: str, k: int, descending: bool = True,
                bounded_limit: int = BOUNDED_TOPK_LIMIT) -> DataFrame:
    """The ``k`` best rows of ``df`` by ``value`` (finite; ties: lower id first), without sorting it.

    Each refinement is one pass over the rows that are left at the boundary and collects
    ``RANGES`` counts at most (for ids: one per next character).
    """
    sign = -1.0 if descending else 1.0
    v, i = sign * F.col(value).cast("double"), F.col(id_col).cast("string")      # smaller is better
    lo, hi, n = df.agg(F.min(v), F.max(v), F.count(v)).first()
    if k <= 0 or not n:
        return df.limit(0)
    if k >= n:
        return df.where(v.isNotNull())
    need, better, boundary = k, F.lit(False), v.isNotNull()

    def refined(parts: list[tuple]) -> tuple:
        """The part (in order; its count comes first) that holds the row ``need``; what comes before is taken off."""
        nonlocal need
        for part in parts:
            if need <= part[0]:
                return part
            need -= part[0]
        raise AssertionError("the rows changed between two passes")

    while lo < hi and min(n, need) > bounded_limit:
        width = hi / RANGES - lo / RANGES
        place = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(RANGES - 1)) if width > 0 else (v > F.lit(lo)).cast("long")
        counts = df.where(boundary).groupBy(place.alias("p")).agg(F.count(F.lit(1)), F.min(v), F.max(v)).collect()
        n, lo, hi = refined([tuple(r)[1:] for r in sorted(counts, key=lambda r: r["p"])])
        better, boundary = v < F.lit(lo), v.between(F.lit(lo), F.lit(hi))
    prefix = ""
    while lo == hi and min(n, need) > bounded_limit:
        step = F.substring(i, len(prefix) + 1, 1)
        counts = df.where(boundary & i.startswith(prefix)).groupBy(step.alias("c")).agg(F.count(F.lit(1))).collect()
        n, c = refined([(r[1], r["c"]) for r in sorted(counts, key=lambda r: r["c"].encode())])
        if not c:                            # rows of one id: any of them
            boundary = boundary & (i == F.lit(prefix))
            break
        prefix += c
    if prefix:
        better = better | ((v == F.lit(lo)) & (i < F.lit(prefix)))
        boundary = boundary & i.startswith(prefix)
    rest = df.where(boundary)
    if need < n:
        rest = rest.orderBy(*_order(value, id_col, descending)).limit(need)
    return df.where(better).unionByName(rest)


def with_global_position(df: DataFrame, order: list[Column], pos_col: str,
                         partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order`` (distributed).

    ``order`` must be a total order (end with a unique id).  No step holds more than one
    range partition per task; the offsets table has one row per partition.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).checkpoint()
    mono = F.monotonically_increasing_id()
    local = ranged.withColumn("_mid", mono).select(
        "*",
        F.shiftright(F.col("_mid"), LOCAL_BITS).alias("_part"),
        (F.col("_mid") - F.shiftleft(F.shiftright(F.col("_mid"), LOCAL_BITS), LOCAL_BITS)).alias("_local"),
    ).drop("_mid")
    counts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_part",
        (F.sum("_cnt").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    return (local.join(F.broadcast(offsets), "_part")      # one row per partition
            .select("*", (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local") + 1).alias(pos_col))
            .drop("_part", "_local", "_off"))


def top_fraction(df: DataFrame, value: str, id_col: str, ratio: float, rule: str,
                 bounded_limit: int = BOUNDED_TOPK_LIMIT) -> DataFrame:
    """Positive, non-NaN rows of ``df`` cut to the best fraction ``ratio``.

    ``rule='growth'``: keep floor(n*ratio)+1 of n rows (all when n <= 1).
    ``rule='periodic'``: keep floor(n*ratio) of n rows (all when n <= 2).
    The candidates are checkpointed and counted eagerly to fix k.
    """
    ratio = check_ratio(ratio)
    cut = {"growth": growth_cut, "periodic": periodic_cut}[rule]
    checkpoint_dir(df.sparkSession)
    # Materialise the candidates once (reliable checkpoint): the count and the cut then
    # read the same rows instead of recomputing the whole upstream plan twice.
    positive = df.where(positive_finite(value)).checkpoint()
    n = positive.count()
    return top_k(positive, value, id_col, cut(n, ratio), True, bounded_limit)
