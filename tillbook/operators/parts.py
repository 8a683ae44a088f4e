"""Transactions that came as several events.

An order of any size is sent in parts that each hold some of its items and their share of its amounts; the
tax of a share is not rounded. Parts travel through parsing, filter and sinks as any event does. Here they
are added up again: sums of shares, so the order in which they arrive does not matter, and the one rounding
is made at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SHARE = "decimal(24,4)"
_AMOUNTS = ("subtotal", "tax", "total")
_MARKS = ("part", "parts")


def _single() -> Column:
    """Events that are a transaction of their own, also when their marks make no sense."""
    return F.col("part").isNull() | F.col("parts").isNull() | (F.col("parts") < 1) | ~F.col("part").between(0, F.col("parts") - 1)


def _amount(name: str) -> Column:
    """Sum of the shares in cents; NULL if one of them is missing or no money."""
    share = F.col(name).try_cast(_SHARE)
    return F.when(F.count(share) == F.count(F.lit(1)), F.round(F.sum(share), 2).cast("double"))


def _folds(rows: DataFrame, more: dict[str, Column] | None) -> dict[str, Column]:
    known = {name: _amount(name) for name in _AMOUNTS} | {"item_count": F.sum("item_count").cast("int")} | (more or {})
    return {name: fold.alias(name) for name, fold in known.items() if name in rows.columns}


def _headers(rows: DataFrame, folds: dict[str, Column]) -> list[str]:
    return [name for name in rows.columns if name not in folds and name not in _MARKS]


def whole(rows: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """The transactions of stored events: single ones as they are, the others added up.

    Rows need ``transaction_id``, ``part`` and ``parts``; amounts and item_count are summed, columns in ``more``
    folded as it says, all others must agree between the parts. A part that was sent twice counts once. A
    transaction of which parts are missing is left out; see ``incomplete``. Only parts are shuffled, and a
    table without any is read no further than its statistics.
    """
    folds = _folds(rows, more)
    headers, columns = _headers(rows, folds), [name for name in rows.columns if name not in _MARKS]
    once = rows.filter(~_single()).dropDuplicates(["transaction_id", "part"])
    added = once.groupBy(*headers, "parts").agg(F.count(F.lit(1)).alias("_arrived"), *folds.values())
    return rows.filter(_single()).select(columns).unionByName(added.filter("_arrived = parts").select(columns))


def whole_once(events: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """``whole`` for a frame that is dear to compute, in one pass: everything is grouped, and a part that was
    sent twice makes its transaction incomplete."""
    folds = _folds(events, more)
    headers, columns = _headers(events, folds), [name for name in events.columns if name not in _MARKS]
    marked = events.withColumns({"_n": F.when(~_single(), F.col("parts")), "_own": F.when(_single(), F.monotonically_increasing_id())})
    kept = [F.when(F.col("_n").isNull(), F.any_value(name)).otherwise(fold).alias(name) for name, fold in folds.items()]
    added = marked.groupBy(*headers, "_n", "_own").agg(F.count(F.lit(1)).alias("_arrived"), *kept)
    return added.filter("_n IS NULL OR _arrived = _n").select(columns)


def incomplete(rows: DataFrame) -> DataFrame:
    """transaction_id, parts, arrived: transactions of which not all parts, or parts that disagree, are stored."""
    marked = rows.filter(~_single()).dropDuplicates(["transaction_id", "part"])
    found = marked.groupBy("transaction_id", "parts").agg(F.count(F.lit(1)).alias("arrived"))
    return found.filter(F.col("arrived") < F.col("parts"))
