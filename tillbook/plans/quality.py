"""Quality checks and the gate that fails a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.money import MONEY, as_money, basket_subtotal, tax_on
from ..operators.parts import whole_once
from ..schema import FAILED_STATUS
from ..streaming.waiting import settle

OBSERVED = "quality"

# In the order in which a run is judged: name, what must hold, message.
RULES: tuple[tuple[str, Callable[[int], bool], str], ...] = (
    ("row_count", lambda n: n > 0, "the table has no rows"),
    ("null_transaction_ids", lambda n: n == 0, "rows without a transaction id"),
    ("failed_payments", lambda n: n == 0, "rows with a failed payment"),
)


class DataQualityError(RuntimeError):
    """A rule does not hold. ``rule`` and ``value`` say which one and what was found."""

    def __init__(self, rule: str, value: int, message: str):
        super().__init__(f"{rule} = {value}: {message}")
        self.rule = rule
        self.value = value


def dq_report(sales: DataFrame) -> DataFrame:
    """One row with the three counts, in one pass."""
    return sales.agg(*_counts(F.lit(True)))


def _counts(counted: Column) -> list[Column]:
    return [
        F.count_if(counted).alias("row_count"),
        F.count_if(counted & F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(counted & (F.col("payment_status") == FAILED_STATUS)).alias("failed_payments"),
    ]


def observed(events: DataFrame) -> DataFrame:
    """Rows of stored events that count themselves for the same report while they are written, without a second
    scan. Of a transaction in parts the first part counts."""
    return events.observe(OBSERVED, *_counts(F.coalesce(F.col("part"), F.lit(0)) == 0))


def gate(report: DataFrame) -> DataFrame:
    """Raise ``DataQualityError`` on the first rule that fails, otherwise return the record."""
    found = report.first()
    for rule, holds, message in RULES:
        if not holds(found[rule]):
            raise DataQualityError(rule, found[rule], message)
    return report.sparkSession.createDataFrame([found], report.schema)


def gated_run(start: Callable[[], StreamingQuery], rows: Callable[[], DataFrame], timeout: float = 600.0, **source: str) -> DataFrame:
    """Start ingest (or find it running), let it catch up, then judge the table. ``source`` is the location and
    the checkpoint that ``settle`` needs for a source of files."""
    settle(start(), timeout, **source)
    return gate(dq_report(rows()))


def reconcile(transactions: DataFrame) -> DataFrame:
    """Amounts recomputed from the items of nested transactions, and whether the events' own agree.

    The subtotals of the parts of a large transaction are added first. NULL or non-money amounts are never consistent.
    """
    own = basket_subtotal(F.col("items"))
    events = transactions.select("transaction_id", "subtotal", "tax", "total", "part", "parts", own.alias("recomputed"))
    every = F.count("recomputed") == F.count(F.lit(1))
    claimed = whole_once(events, {"recomputed": F.when(every, F.sum("recomputed").cast(MONEY))})
    subtotal = F.col("recomputed")
    expected = {"subtotal": subtotal, "tax": tax_on(subtotal), "total": subtotal + tax_on(subtotal)}
    agrees = F.lit(True)
    for name, value in expected.items():
        agrees = agrees & (as_money(F.col(name)) == value)
    return claimed.select(
        "transaction_id",
        *(value.cast("double").alias(name) for name, value in expected.items()),
        F.coalesce(agrees, F.lit(False)).alias("consistent"),
    )
