"""Scalar column expressions (all JVM-side, codegen-friendly, ANSI-safe).

Every function takes and returns ``pyspark.sql.Column`` objects, so callers compose them
inside ``select``/``filter`` and Catalyst can push them down or fold them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
INVOICE_TIME_FORMAT = "yyyyMMddHHmmss"   # invoice time text, e.g. 20120105123456
MONTH_FORMAT = "yyyyMM"                  # year-month key, e.g. 201201
INT_MAX = 2147483647                     # digit counting saturates like a 32-bit int


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def invoice_month(kprq) -> Column:
    """Invoice time text ``yyyyMMddHHmmss`` -> year-month text ``yyyyMM``.

    Strict: text that is not a valid time (``bad``, day 32, ...) gives NULL instead of an
    error or a rolled-over date.
    """
    ts = F.try_to_timestamp(_col(kprq), F.lit(INVOICE_TIME_FORMAT))
    return F.date_format(ts, MONTH_FORMAT)


def month_key(kprq) -> Column:
    """Year-month as an integer ``yyyyMM`` (NULL for invalid text)."""
    return invoice_month(kprq).cast("int")


def first_token(s) -> Column:
    """Text before the first space (the whole text when there is none)."""
    return F.substring_index(_col(s), " ", 1)


def region_prefix(nsrsbh, width: int = 2) -> Column:
    """Leading ``width`` characters of a taxpayer id (the region code)."""
    return F.substring(_col(nsrsbh), 1, width)


def non_empty(c) -> Column:
    """``c <> ''``: false for the empty string, NULL (so dropped by filters) for NULL."""
    return _col(c) != F.lit("")


def period_between(ny, start: int, end: int) -> Column:
    """Inclusive numeric period test on an integer ``yyyyMM`` column."""
    return _col(ny).between(F.lit(int(start)), F.lit(int(end)))


def time_text_between(kprq, start: int, end: int) -> Column:
    """Invoice time text inside the months ``[start, end]`` (integers ``yyyyMM``).

    A plain text range, so it reaches a scan of stored invoices; it holds for every valid time
    of those months and for some invalid texts, which the month conversion drops.
    """
    following = int(end) + (89 if int(end) % 100 == 12 else 1)
    text = _col(kprq)
    return (text >= F.lit(f"{int(start):06d}")) & (text < F.lit(f"{following:06d}"))


def digit_count(c) -> Column:
    """Digits of the integer part of ``c``, sign ignored, 0 -> 1, saturating at 10.

    The integer part is truncated toward zero and clamped to the 32-bit range before
    counting, so 3e9 counts as 10 digits.
    """
    whole = F.least(F.floor(F.abs(_col(c))), F.lit(INT_MAX).cast("double"))
    return F.length(whole.cast("bigint").cast("string"))


def round_half_up(c, digits: int) -> Column:
    """Decimal rounding, half up, as text formatting ``%.{digits}f`` does."""
    return F.round(_col(c), digits)


def safe_share(part, whole) -> Column:
    """``part / whole`` where a zero or NULL denominator (or NULL part) gives 0.0."""
    return F.coalesce(F.try_divide(_col(part), _col(whole)), F.lit(0.0))


def positive_finite(c) -> Column:
    """``c > 0`` and not NaN (NaN compares greater than every number in Spark)."""
    return (~F.isnan(_col(c))) & (_col(c) > F.lit(0.0))
