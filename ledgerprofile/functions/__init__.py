"""Column expressions and the tag row contract."""

from ledgerprofile.functions.scalars import (
    digit_count,
    first_token,
    invoice_month,
    month_key,
    non_empty,
    period_between,
    positive_finite,
    region_prefix,
    round_half_up,
    safe_share,
    time_text_between,
)
from ledgerprofile.functions.tagrows import TAG_SCHEMA, TagKey, today_text, to_tags

__all__ = [
    "TAG_SCHEMA",
    "TagKey",
    "digit_count",
    "first_token",
    "invoice_month",
    "month_key",
    "non_empty",
    "period_between",
    "positive_finite",
    "region_prefix",
    "round_half_up",
    "safe_share",
    "time_text_between",
    "today_text",
    "to_tags",
]
