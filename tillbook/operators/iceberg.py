"""The same table operations on an Iceberg table, through its connector.

Needs the connector's jar and a session built with ``session_conf("iceberg", warehouse)``. Snapshot
ids, conflicts and hidden-partition pruning are the connector's own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import instant
from ..schema import CLEAN, STORED
from . import layout as layouts
from .parts import whole

_TRANSFORM = {"day": "days(transaction_timestamp)", "month": "months(transaction_timestamp)", "store": "store_id"}


class IcebergTable:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name

    def create_statement(self, layout: tuple[str, ...] = layouts.DEFAULT) -> str:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED)
        parts = ", ".join(_TRANSFORM[name] for name in layouts.checked(layout))
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING iceberg" + (f" PARTITIONED BY ({parts})" if parts else "")

    def create(self, layout: tuple[str, ...] = layouts.DEFAULT) -> IcebergTable:
        """Create the table if it does not exist. Rows may be parts of transactions, hence two more columns."""
        self.spark.sql(self.create_statement(layout))
        return self

    def append(self, rows: DataFrame) -> None:
        given = {name: F.col(name) for name in rows.columns}
        stored = rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STORED))
        stored.writeTo(self.name).append()

    def current(self) -> DataFrame:
        return whole(self.spark.table(self.name)).select(*CLEAN.fieldNames())

    def as_of(self, snapshot: int | None) -> DataFrame:
        if snapshot is None:
            raise LookupError("time travel needs at least two snapshots")
        return whole(self.spark.sql(f"SELECT * FROM {self.name} VERSION AS OF {int(snapshot)}")).select(*CLEAN.fieldNames())

    def snapshots(self) -> DataFrame:
        return self.spark.table(f"{self.name}.snapshots")

    def first_snapshot(self) -> int | None:
        found = self.snapshots().agg(
            F.count(F.lit(1)).alias("n"), F.min_by("snapshot_id", "committed_at").alias("first")
        ).first()
        return found["first"] if found["n"] >= 2 else None

    def scan_between(self, since: datetime, until: datetime, stores: list[str] | None = None) -> DataFrame:
        moment = F.col("transaction_timestamp")
        rows = self.current().filter((moment >= instant(since)) & (moment < instant(until)))
        return rows if stores is None else rows.filter(F.col("store_id").isin(stores))

    def delete_where(self, predicate: str) -> None:
        self.spark.sql(f"DELETE FROM {self.name} WHERE {predicate}")

    def update_where(self, predicate: str, assignments: dict[str, str]) -> None:
        changes = ", ".join(f"{column} = {value}" for column, value in assignments.items())
        self.spark.sql(f"UPDATE {self.name} SET {changes} WHERE {predicate}")

    def add_partition(self, name: str) -> None:
        """Partition later appends by one more derived column; existing files stay as they are."""
        (checked,) = layouts.checked((name,))
        self.spark.sql(f"ALTER TABLE {self.name} ADD PARTITION FIELD {_TRANSFORM[checked]}")
