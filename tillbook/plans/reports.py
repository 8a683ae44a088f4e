"""Reports over flat transactions. Sums use exact decimals; orders end in a unique column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import not_addable, rounded_sum

LATEST_COLUMNS = ("transaction_id", "store_id", "total", "payment_status", "transaction_timestamp")


def row_count(sales: DataFrame) -> DataFrame:
    return sales.agg(F.count(F.lit(1)).alias("total_rows"))


def newest(sales: DataFrame, n: int = 5) -> DataFrame:
    """The newest transactions with all their columns; rows without a time come last. The amount of a
    transaction follows from its id, so it is not needed to break ties."""
    return sales.orderBy(F.desc("transaction_timestamp"), "transaction_id", "store_id", "payment_status").limit(n)


def latest(sales: DataFrame, n: int = 5) -> DataFrame:
    return newest(sales.select(*LATEST_COLUMNS), n)


def revenue_by_store(sales: DataFrame) -> DataFrame:
    """Transactions and revenue per store, and how many amounts (NaN, from 1e11) could not be added."""
    return (
        sales.groupBy("store_id")
        .agg(F.count(F.lit(1)).alias("transactions"), rounded_sum(F.col("total")).alias("total_revenue"), not_addable(F.col("total")).alias("not_added"))
        .orderBy(F.desc("total_revenue"), "store_id")
    )


def by_payment_method(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("payment_method").agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "payment_method")
    )


def first_rows(snapshot: DataFrame, n: int = 5) -> DataFrame:
    """A few rows of an earlier snapshot, always the same ones."""
    return snapshot.select("transaction_id", "total", "transaction_timestamp").orderBy(
        "transaction_id", "transaction_timestamp", "total"
    ).limit(n)


def _window(moment: str, seconds: int) -> Column:
    """Number of the window of an instant, counted from the epoch."""
    return F.floor(F.unix_micros(F.col(moment).cast("timestamp")) / F.lit(seconds * 1_000_000.0)).cast("long")


def _rates(counted: DataFrame, first: int | None, last: int | None, kind: str, seconds: int, low: float, high: float) -> DataFrame:
    """A row for each window from ``first`` to ``last``; those without events have a rate of 0."""
    windows = counted.sparkSession.range(0 if first is None else first, 0 if last is None else last + 1)
    rate = F.col("events") / F.lit(float(seconds))
    start = F.timestamp_micros(F.col("id") * F.lit(seconds * 1_000_000)).cast(kind)
    return (
        windows.join(counted.withColumnRenamed("window", "id"), "id", "left").withColumn("events", F.coalesce("found", F.lit(0)))
        .select(start.alias("window_start"), "events", rate.alias("per_second"), rate.between(low, high).alias("in_range"))
    )


def rate_check(events: DataFrame, moment: str = "ts", seconds: int = 60, low: float = 5.0, high: float = 10.0) -> DataFrame:
    """Events per window and whether the rate is within the limits, from the first to the last window with an
    event; a window without any has a rate of 0."""
    window = _window(moment, seconds)
    ends = events.agg(F.min(window).alias("first"), F.max(window).alias("last")).first()
    counted = events.filter(F.col(moment).isNotNull()).groupBy(window.alias("window")).agg(F.count(F.lit(1)).alias("found"))
    return _rates(counted, ends["first"], ends["last"], events.schema[moment].dataType.simpleString(), seconds, low, high)


def windowed_counts(events: DataFrame, moment: str = "ts", seconds: int = 60, delay: str = "10 minutes") -> DataFrame:
    """window_start and found of a stream: a window is counted once, when the watermark has passed its end.

    The watermark trails the newest event by ``delay``; events older than that are late and are not counted
    (progress rows say how many). Only open windows are kept in the state store, whatever the length of the
    stream, and a restart goes on with them.
    """
    known = events.withColumn(moment, F.col(moment).cast("timestamp"))  # a watermark needs instants
    return (
        known.withWatermark(moment, delay).groupBy(F.window(moment, f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("found")).select(F.col("w.start").alias("window_start"), "found")
    )


def rates_of_counts(counts: DataFrame, seconds: int = 60, low: float = 5.0, high: float = 10.0) -> DataFrame:
    """``rate_check`` of the closed windows that a stream of ``windowed_counts`` has written."""
    kind = counts.schema["window_start"].dataType.simpleString()
    counted = counts.select(_window("window_start", seconds).alias("window"), "found")
    ends = counted.agg(F.min("window").alias("first"), F.max("window").alias("last")).first()
    return _rates(counted, ends["first"], ends["last"], kind, seconds, low, high)
