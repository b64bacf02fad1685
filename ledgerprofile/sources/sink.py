"""Tag sink (S13): append tag rows to a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerprofile.functions.tagrows import TAG_COLUMNS


def append_tags(tags: DataFrame, table: str, fmt: str | None = None, path: str | None = None) -> None:
    """Append ``tags`` (tag schema) to ``table``; the table is created on first use.

    ``path`` places a new table's files outside the warehouse.

    Appending is not idempotent: running the same job twice stores its rows twice, so the
    caller owns reruns (e.g. by writing into a per-run partition).
    """
    writer = tags.select(*TAG_COLUMNS).write.mode("append")
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
