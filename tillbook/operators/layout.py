"""Hidden partitioning: directory columns derived from the row, which readers never see."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from ..functions.times import day_of, instant, utc_day, utc_month


@dataclass(frozen=True)
class Derived:
    """A directory column: where it comes from, how, and its type."""

    source: str
    make: object
    kind: DataType

    def of_rows(self) -> Column:
        return self.make(F.col(self.source))


DERIVED = {
    "day": Derived("transaction_timestamp", utc_day, DateType()),
    "month": Derived("transaction_timestamp", utc_month, DateType()),
    "store": Derived("store_id", lambda store: store, StringType()),
}

DEFAULT = ("day", "store")


def checked(layout: tuple[str, ...]) -> tuple[str, ...]:
    unknown = [name for name in layout if name not in DERIVED]
    if unknown or len(set(layout)) != len(layout):
        raise ValueError(f"a layout takes each of {sorted(DERIVED)} at most once, not {layout!r}")
    return tuple(layout)


def directory(name: str) -> str:
    return f"_p_{name}"


def gathered(rows: DataFrame, layout: tuple[str, ...], once: bool = False) -> DataFrame:
    """Brings the rows of a directory together, so that few tasks write each of them.

    Days make many small directories, whose files cost more than their rows: these are dealt in ranges, which
    keeps all tasks busy, with a hash behind the directory so that a hot one is split. Few directories
    are rebalanced instead, which needs no sample; adaptive execution splits the large and merges the small.
    So are the rows of a micro-batch, which are of few days and must be read only ``once``. Rows that are stored
    as removed have no id of a transaction, so their identity is hashed too.
    """
    names = [directory(name) for name in layout]
    if "day" in layout and not once:
        identity = [name for name in ("_write", "_row") if name in rows.columns]
        return rows.repartitionByRange(*names, F.xxhash64("transaction_id", "transaction_timestamp", *identity))
    return rows.hint("rebalance", *names)


def write_by_layout(rows: DataFrame, path: str, layout: tuple[str, ...] = DEFAULT, mode: str = "errorifexists") -> None:
    """Write rows as Parquet with a directory per day (UTC) and store, or another layout.

    The derived columns are hidden: ``read_by_layout`` leaves them out.
    """
    names = [directory(name) for name in checked(layout)]
    derived = rows.withColumns({directory(name): DERIVED[name].of_rows() for name in layout})
    dealt = gathered(derived, layout).sortWithinPartitions(*names, "transaction_timestamp") if layout else derived
    dealt.write.mode(mode).partitionBy(*names).parquet(path)


def read_by_layout(
    spark: SparkSession, path: str, schema: StructType, layout: tuple[str, ...] = DEFAULT,
    since: datetime | None = None, until: datetime | None = None, stores: list[str] | None = None,
) -> DataFrame:
    """Rows of a folder written by ``write_by_layout``, of a range of time and of some stores; other directories
    are not read."""
    kinds = [StructField(directory(name), DERIVED[name].kind, True) for name in checked(layout)]
    rows = spark.read.schema(StructType([*schema.fields, *kinds])).parquet(path)
    last = None if until is None else day_of(until - timedelta(microseconds=1))
    for test in pruning(layout, None if since is None else day_of(since), last, stores):
        rows = rows.filter(test)
    moment = F.col("transaction_timestamp")
    if since is not None:
        rows = rows.filter(moment >= instant(since))
    if until is not None:
        rows = rows.filter(moment < instant(until))
    if stores is not None:
        rows = rows.filter(F.col("store_id").isin(stores))
    return rows.select(*schema.fieldNames())


def pruning(layout: tuple[str, ...], first: date | None, last: date | None, stores: list[str] | None) -> list[Column]:
    """Directory predicates that every row of the range satisfies.

    The empty store is left out: as a directory name it reads back as NULL, so a list with it cannot
    be turned into a directory predicate.
    """
    tests = []
    for name in layout:
        column = F.col(directory(name))
        if name == "store":
            if stores is not None and "" not in stores:
                tests.append(column.isin(stores))
            continue
        start = (lambda day: day.replace(day=1)) if name == "month" else (lambda day: day)
        if first is not None:
            tests.append(column >= F.lit(start(first)))
        if last is not None:
            tests.append(column <= F.lit(start(last)))
    return tests
