"""The verification run over a table: eight sections, each a frame."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from . import quality, reports

REFUNDED = "payment_status = 'refunded'"


def sections(table, delete: bool = False) -> Iterator[tuple[str, DataFrame | None]]:
    """Title and result of each section, in order; a section that cannot run has no result.

    Deleting the refunded rows changes the table for good, so it must be asked for.
    """
    current = table.current()
    yield "row count", reports.row_count(current)
    yield "latest transactions", reports.latest(current)
    yield "revenue by store", reports.revenue_by_store(current)
    yield "transactions by payment method", reports.by_payment_method(current)
    yield "snapshots", table.snapshots()
    first = table.first_snapshot()
    yield "first snapshot", None if first is None else reports.first_rows(table.as_of(first))
    yield "delete refunded", delete_check(table) if delete else None
    yield "quality", quality.dq_report(table.current())


def delete_check(table) -> DataFrame:
    """Refunded rows before and after deleting them. Where the table has version numbers, both counts
    are of fixed snapshots, so a stream that appends meanwhile does not disturb them."""
    before = _refunded(table.current(), "before").first()["refunded"]
    version = table.delete_where(REFUNDED)
    if version in (None, 1):  # nothing was hit, or the catalogue numbers snapshots itself
        spark = table.current().sparkSession
        known = spark.range(1).select(F.lit("before").alias("checked"), F.lit(before).cast("long").alias("refunded"))
        return known.unionByName(_refunded(table.current(), "after"))
    return _refunded(table.as_of(version - 1), "before").unionByName(_refunded(table.as_of(version), "after"))


def _refunded(rows: DataFrame, when: str) -> DataFrame:
    return rows.filter(REFUNDED).agg(F.count(F.lit(1)).alias("refunded")).select(F.lit(when).alias("checked"), "refunded")
