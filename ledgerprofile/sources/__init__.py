"""Sources and sinks: table loaders (S1-S12), the test-data adapter, the tag sink."""

from ledgerprofile.sources.loaders import (
    catalog_invoices,
    foreign_trade_registry,
    industry_monthly_table,
    purchase_invoices,
    registry,
    registry_from_maps,
    sales_invoices,
    scan_table,
    taxpayer_monthly_table,
    trade_pair_totals,
    trade_pairs_in_period,
    trade_pairs_monthly_table,
)
from ledgerprofile.sources.sink import append_tags

__all__ = [
    "append_tags",
    "catalog_invoices",
    "foreign_trade_registry",
    "industry_monthly_table",
    "purchase_invoices",
    "registry",
    "registry_from_maps",
    "sales_invoices",
    "scan_table",
    "taxpayer_monthly_table",
    "trade_pair_totals",
    "trade_pairs_in_period",
    "trade_pairs_monthly_table",
]
