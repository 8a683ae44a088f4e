"""A history of sale transactions in plain partitioned Parquet: appends, deletions and updates as rows.

Layout below ``root``::

    layout=day-store/change=added|removed|base/version=N/query=Q/batch=B/_p_day=.../_p_store=.../*.parquet

Every stored row has an identity. A deletion stores the identities of the rows that it hit, as removed; an update
stores them as removed and the new form of the rows as added. A snapshot is what was added up to a version without
what was removed up to it: a filter on partitions and an anti-join, with bits that all tasks get, so that the rows
stay where they are read. ``rewrite`` stores what is left as a new base. Each change is one write, whose files appear when Spark commits it; its predicate is evaluated once. There is no log: versions,
operations and counts are read off the folders and rows.

A micro-batch is known by the id of its query and its number. When it is replayed after a crash it
replaces its own folder. Writers that start at the same time may share a version number; neither loses rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.times import day_of, instant
from ..schema import CLEAN
from ..session import content, matching
from . import layout as layouts
from .parts import whole

_IDENTITY = StructType([StructField("_write", LongType()), StructField("_row", LongType())])
_PLACE = StructType([StructField("change", StringType()), StructField("version", LongType()), StructField("query", StringType()), StructField("batch", LongType())])
_ADDED, _REMOVED, _BASE = "added", "removed", "base"
_PLAIN = "none"  # name of the layout without directories

# Removed rows are marked in words of 64 bits, of which an entry holds so many.
_WORDS = 16
# Entries take some 250 bytes for 1,024 rows, or for a file with fewer: some 145 MB for 16 GB of rows of 27 bytes,
# or for half a million files. In tables beyond, rows and identities are joined as Spark chooses.
_MARKED_BYTES = 16 << 30
_MARKED_FILE = 32 << 10


class VersionedTable:
    """Snapshots of sale transactions below one folder. ``layout`` is that of rows written from now on.

    With the schema ``STORED`` rows may be parts of transactions; they are read as whole ones, while changes
    act on the stored rows.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType = CLEAN, layout: tuple[str, ...] = layouts.DEFAULT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.layout = layouts.checked(layout)

    def with_layout(self, layout: tuple[str, ...]) -> VersionedTable:
        """The same table, written with another layout from now on. Existing files stay as they are."""
        return VersionedTable(self.spark, self.root, self.schema, layout)

    # -- versions -----------------------------------------------------------------------------

    def _stored_layouts(self) -> list[tuple[str, ...]]:
        names = sorted(path.rsplit("layout=", 1)[1] for path, _ in matching(self.spark, f"{self.root}/layout=*"))
        return [() if name == _PLAIN else tuple(name.split("-")) for name in names]

    def _versions(self, change: str = "*") -> list[int]:
        found = matching(self.spark, f"{self.root}/layout=*/change={change}/version=*")
        return sorted({int(path.rsplit("version=", 1)[1]) for path, _ in found})

    def latest(self) -> int:
        """Number of the newest version; 0 for a table without rows."""
        return max(self._versions(), default=0)

    def snapshots(self) -> DataFrame:
        """One row per version, oldest first, counted from the rows themselves without reading a column."""
        rows = self._scan()
        counts = {change: F.count_if(F.col("change") == change) for change in (_ADDED, _REMOVED, _BASE)}
        found = rows.groupBy("version").agg(*(count.alias(name) for name, count in counts.items()), F.max("file_time").alias("committed_at"))
        order = Window.orderBy("version")  # a row per version
        operation = (
            F.when(F.col(_BASE) > 0, "rewrite").when((F.col(_ADDED) > 0) & (F.col(_REMOVED) > 0), "update")
            .when(F.col(_REMOVED) > 0, "delete").otherwise("append")
        )
        added, deleted = F.col(_ADDED) + F.col(_BASE), F.col(_REMOVED) + F.col(_BASE)
        return found.select(
            F.col("version").alias("snapshot_id"), F.lag("version").over(order).alias("parent_id"), "committed_at",
            operation.alias("operation"), added.alias("added_records"), deleted.alias("deleted_records"),
            F.sum(F.col(_ADDED) - F.col(_REMOVED)).over(order).alias("total_records"),
        ).orderBy("snapshot_id")

    def first_snapshot(self) -> int | None:
        """Oldest snapshot if there are at least two, as time travel needs; otherwise None."""
        versions = self._versions()
        return versions[0] if len(versions) >= 2 else None

    def total_records(self) -> int:
        counted = self._scan().filter(F.col("change") != _BASE).agg(F.sum(F.when(F.col("change") == _ADDED, 1).otherwise(-1)).alias("n"))
        return counted.first()["n"] or 0

    # -- write --------------------------------------------------------------------------------

    def append(self, rows: DataFrame, *, query_id: str | None = None, batch_id: int | None = None, replay: bool = True) -> int:
        """Append rows as one version. A batch of a stream that is there already is replaced by itself;
        ``replay=False`` says that it cannot be there yet."""
        query, batch = query_id or f"append-{uuid.uuid4().hex}", batch_id or 0
        version = self._version_of(query, batch) if query_id and replay else None
        version = version or self.latest() + 1
        given = {name: F.col(name) for name in rows.columns}
        rows = rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema))
        folder = f"{self._folder(self.layout)}/change={_ADDED}/version={version}/query={query}/batch={batch}"
        names = [layouts.directory(name) for name in self.layout]
        self._prepared(rows, once=query_id is not None).write.mode("overwrite").partitionBy(*names).parquet(folder)
        return version

    def _version_of(self, query: str, batch: int) -> int | None:
        found = matching(self.spark, f"{self.root}/layout=*/change={_ADDED}/version=*/query={query}/batch={batch}")
        return int(found[0][0].split("version=")[1].split("/")[0]) if found else None

    def _folder(self, layout: tuple[str, ...]) -> str:
        return f"{self.root}/layout={'-'.join(layout) or _PLAIN}"

    def _prepared(self, rows: DataFrame, once: bool = False) -> DataFrame:
        """Rows as they are written: with directories, and an identity where they had none before."""
        if "_row" not in rows.columns:
            rows = rows.withColumns({"_write": F.lit(None).cast("long"), "_row": F.lit(None).cast("long")})
        names = [layouts.directory(name) for name in self.layout]
        rows = rows.withColumns({layouts.directory(name): layouts.DERIVED[name].of_rows() for name in self.layout})
        if self.layout:
            rows = layouts.gathered(rows, self.layout, once)
            # the write sorts by directory anyway; the time makes row groups skippable
            rows = rows.sortWithinPartitions(*names, "transaction_timestamp")
        fresh = uuid.uuid4().int >> 65  # of this write
        return rows.withColumns({
            "_row": F.when(F.col("_write").isNull(), F.monotonically_increasing_id()).otherwise(F.col("_row")),
            "_write": F.coalesce("_write", F.lit(fresh)),
        })

    def stream_writer(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that appends each micro-batch exactly once.

        Batches are identified by the query id, which is stable across restarts from a checkpoint; a new
        checkpoint has a new one and starts again at batch 0. Only the first batch after a start can be a replay.
        """
        started: set[str] = set()

        def write(batch: DataFrame, batch_id: int) -> None:
            table = VersionedTable(batch.sparkSession, self.root, self.schema, self.layout)
            query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            table.append(batch, query_id=query_id, batch_id=batch_id, replay=query_id not in started)
            started.add(query_id)

        return write

    # -- read ---------------------------------------------------------------------------------

    def current(self) -> DataFrame:
        return self._shown(self._rows(self.latest()))

    def _shown(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*self.schema.fieldNames())
        return whole(rows) if "part" in rows.columns else rows

    def as_of(self, version: int | None) -> DataFrame:
        """The rows of a snapshot. ``first_snapshot()`` of a table with a single one gives none to travel to."""
        if version is None:
            raise LookupError("time travel needs at least two snapshots")
        if not 1 <= version <= self.latest():
            raise LookupError(f"no version {version} of {self.root}")
        return self._shown(self._rows(version))

    def scan_between(self, since: datetime, until: datetime, stores: list[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows with ``since <= transaction_timestamp < until``, optionally of some stores only; directories
        outside are not read."""
        first, last = day_of(since), day_of(until - timedelta(microseconds=1))
        rows = self._rows(self.latest() if version is None else version, lambda layout: layouts.pruning(layout, first, last, stores))
        moment = F.col("transaction_timestamp")
        rows = rows.filter((moment >= instant(since)) & (moment < instant(until)))
        if stores is not None:
            rows = rows.filter(F.col("store_id").isin(stores))
        return self._shown(rows)

    def partitions(self, version: int | None = None) -> DataFrame:
        """Rows and files per directory of the layout, counted as written: removed rows are still there."""
        version = self.latest() if version is None else version
        stored = self._scan([self.layout]).filter(_visible(version, self._bases(version))).select(
            *(F.col(layouts.directory(name)).alias(name) for name in self.layout), F.col("file_path").alias("file")
        )
        # Per file first: the second step then handles one row per file, not per record.
        per_file = stored.groupBy(*self.layout, "file").agg(F.count(F.lit(1)).alias("rows"))
        return per_file.groupBy(*self.layout).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))

    def register(self, name: str, version: int | None = None) -> DataFrame:
        """Make a snapshot and the snapshot list readable from SQL as ``name`` and ``name_snapshots``."""
        rows = self.current() if version is None else self.as_of(version)
        rows.createOrReplaceTempView(name)
        self.snapshots().createOrReplaceTempView(f"{name}_snapshots")
        return rows

    def _scan(self, wanted: list[tuple[str, ...]] | None = None) -> DataFrame:
        """All stored rows with their files, or those of some layouts."""
        found = [self._scan_layout(layout) for layout in self._stored_layouts() if wanted is None or layout in wanted]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found or [self._nothing(self.layout)])

    def _schema(self, layout: tuple[str, ...]) -> StructType:
        directories = [StructField(layouts.directory(n), layouts.DERIVED[n].kind, True) for n in layout]
        return StructType([*self.schema.fields, *_IDENTITY.fields, *_PLACE.fields, *directories])

    def _scan_layout(self, layout: tuple[str, ...]) -> DataFrame:
        """The schema is always given: inference would turn a store called 007 into a number."""
        stored = self.spark.read.schema(self._schema(layout)).parquet(self._folder(layout))
        return stored.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("file_time"))

    def _nothing(self, layout: tuple[str, ...]) -> DataFrame:
        empty = self.spark.createDataFrame([], self._schema(layout))
        return empty.withColumns({"file_path": F.lit(""), "file_time": F.current_timestamp()})

    def _bases(self, version: int) -> list[int]:
        return [base for base in self._versions(_BASE) if base <= version][-1:]

    def _rows(self, version: int, prune: Callable[[tuple[str, ...]], list[Column]] = lambda layout: []) -> DataFrame:
        """The rows of a snapshot with their identity. Without a deletion so far no join is made."""
        bases, columns, found = self._bases(version), [*self.schema.fieldNames(), *_IDENTITY.fieldNames()], []
        for layout in self._stored_layouts():
            part = self._scan_layout(layout)
            for test in [_visible(version, bases), *prune(layout)]:
                part = part.filter(test)
            found.append(part.select(columns))
        rows = reduce(DataFrame.unionByName, found or [self._nothing(self.layout).select(columns)])
        removals = [v for v in self._versions(_REMOVED) if v <= version and v > max(bases, default=0)]
        if removals:
            gone = self._scan().filter((F.col("change") == _REMOVED) & (F.col("version") <= version) & (F.col("version") >= removals[0]))
            rows = self._without(rows, gone.select(*_IDENTITY.fieldNames()))
        return rows

    def _without(self, rows: DataFrame, gone: DataFrame) -> DataFrame:
        """Rows whose identity is not among those that are gone. The rows of a task that writes are numbered
        without gaps, so bits say which: they are sent to the rows, which else every change would shuffle."""
        size, files = content(self.spark, self.root)
        if size + files * _MARKED_FILE > _MARKED_BYTES:
            return rows.join(gone, _IDENTITY.fieldNames(), "left_anti")
        bit, word, entry = F.expr("shiftleft(1L, CAST(_row & 63 AS INT))"), _word(F.col("_row")), _entry(F.col("_row"))
        # An aggregate per word, as these are combined before the shuffle without sorting.
        words = [F.bit_or(F.when(word == n, bit)).alias(f"_{n}") for n in range(_WORDS)]
        marked = gone.groupBy(F.col("_write").alias("_marked"), entry.alias("_entry")).agg(*words)
        marks = marked.select("_marked", "_entry", F.array(*(f"_{n}" for n in range(_WORDS))).alias("_words"))
        place = (F.col("_write") == F.col("_marked")) & (entry == F.col("_entry"))
        is_gone = F.getbit(F.get("_words", word), F.col("_row").bitwiseAND(63)) == 1
        return rows.join(F.broadcast(marks), place & is_gone, "left_anti")

    # -- change -------------------------------------------------------------------------------

    def delete_where(self, predicate: str) -> int | None:
        """Delete the rows for which the predicate is true; where it is NULL, the row stays. Returns the new
        version, or None if no row was hit."""
        hit = self._rows(self.latest()).filter(F.coalesce(F.expr(predicate), F.lit(False)))
        return self._change(hit.select(*self._removed(), F.lit(_REMOVED).alias("change")))

    def _removed(self) -> list[Column]:
        """A row as it is stored when it is removed: its identity, and what names its directory, which spreads
        such rows over the tasks of the write as their new forms are."""
        kept = {*_IDENTITY.fieldNames(), *(layouts.DERIVED[name].source for name in self.layout)}
        names = {field.name: field.dataType for field in [*self.schema, *_IDENTITY]}
        return [(F.col(name) if name in kept else F.lit(None).cast(kind)).alias(name) for name, kind in names.items()]

    def update_where(self, predicate: str, assignments: dict[str, str]) -> int | None:
        """Set columns to SQL expressions over the old row where the predicate is true. The snapshot
        list counts a changed row as deleted and added. Returns the new version, or None if no row was hit."""
        unknown = [name for name in assignments if name not in self.schema.fieldNames()]
        if unknown or not assignments:
            raise ValueError(f"cannot assign {unknown or 'nothing'}")
        hit = self._rows(self.latest()).filter(F.coalesce(F.expr(predicate), F.lit(False)))
        names = [*self.schema.fieldNames(), *_IDENTITY.fieldNames()]
        new = {name: F.expr(value).cast(self.schema[name].dataType) for name, value in assignments.items()}
        new |= {name: F.lit(None).cast("long") for name in _IDENTITY.fieldNames()}
        # Both forms come from one row, so the predicate is evaluated once.
        old_and_new = F.array(
            F.struct(*self._removed(), F.lit(_REMOVED).alias("change")),
            F.struct(*(new.get(name, F.col(name)).alias(name) for name in names), F.lit(_ADDED).alias("change")),
        )
        return self._change(hit.select(F.inline(old_and_new)))

    def rewrite(self) -> int | None:
        """Write the current rows out again as one version in this layout. Later reads open it instead of what
        came before; earlier snapshots stay readable."""
        return self._change(self._rows(self.latest()).withColumn("change", F.lit(_BASE)))

    def _change(self, rows: DataFrame) -> int | None:
        version, query = self.latest() + 1, f"change-{uuid.uuid4().hex}"
        place = {"version": F.lit(version).cast("long"), "query": F.lit(query), "batch": F.lit(0).cast("long")}
        names = [*_PLACE.fieldNames(), *map(layouts.directory, self.layout)]
        self._prepared(rows).withColumns(place).write.mode("append").partitionBy(*names).parquet(self._folder(self.layout))
        return version if matching(self.spark, f"{self._folder(self.layout)}/change=*/version={version}/query={query}") else None


def _visible(version: int, bases: list[int]) -> Column:
    """Partitions that hold the rows of a snapshot: its newest base and what was added since."""
    base = max(bases, default=0)
    added = (F.col("change") == _ADDED) & (F.col("version") > base) & (F.col("version") <= version)
    return added | ((F.col("change") == _BASE) & (F.col("version") == base)) if bases else added


def _word(row: Column) -> Column:
    return F.shiftright(row, 6).bitwiseAND(_WORDS - 1).cast("int")


def _entry(row: Column) -> Column:
    return F.shiftright(row, 6 + _WORDS.bit_length() - 1)
