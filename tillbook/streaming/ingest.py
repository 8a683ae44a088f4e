"""Start and find ingest queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.codec import MODES, clean, judged, parse, rejects, sound
from ..operators.iceberg import IcebergTable
from ..operators.layout import DEFAULT
from ..operators.versions import VersionedTable
from ..plans.quality import observed
from ..schema import STORED
from ..session import exists

SINKS = ("parquet", "versions", "iceberg")
AVAILABLE_NOW = "availableNow"
REJECTS = "rejects"


def start_ingest(
    raw: DataFrame,
    sink: str,
    target: str,
    checkpoint: str,
    *,
    trigger: str = "10 seconds",
    mode: str = "strict",
    name: str | None = None,
    layout: tuple[str, ...] = DEFAULT,
) -> StreamingQuery:
    """Parse, clean and append raw events until stopped.

    ``target`` is a folder for ``parquet``, the root of a ``VersionedTable`` for ``versions``, which is
    written with ``layout``, and a table name for ``iceberg``. ``trigger`` is a processing-time interval or
    ``availableNow``. With ``mode="quarantine"`` the events set aside go to ``rejects_of(sink, target, checkpoint)``.
    The counts of the quality report are observed on the rows of every batch (see ``streaming.journal``).
    If a query with this checkpoint is already running, it is returned.
    """
    if sink not in SINKS:
        raise ValueError(f"sink must be one of {SINKS}, not {sink!r}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = raw.sparkSession
    running = running_query(spark, checkpoint)
    if running:
        return running

    if mode == "quarantine":
        aside = rejects_of(sink, target, checkpoint)
        writer = raw.writeStream.foreachBatch(_quarantining(_batch_writer(spark, sink, target, layout), aside))
    else:
        rows = observed(clean(parse(raw)))
        if sink == "versions":
            writer = rows.writeStream.foreachBatch(_batch_writer(spark, sink, target, layout))
        elif sink == "parquet":
            writer = rows.writeStream.format("parquet").option("path", target)
        else:
            writer = rows.writeStream.format("iceberg")
    writer = _triggered(writer.outputMode("append").option("checkpointLocation", checkpoint), trigger)
    if name:
        writer = writer.queryName(name)
    return writer.toTable(target) if sink == "iceberg" and mode == "strict" else writer.start()


def stored_events(spark: SparkSession, target: str) -> DataFrame:
    """What the Parquet sink has written, in either mode."""
    return spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(target)


def rejects_of(sink: str, target: str, checkpoint: str) -> str:
    """Folder of the events set aside: below a versioned table, else beside the checkpoint."""
    return f"{target}/{REJECTS}" if sink == "versions" else f"{checkpoint.rstrip('/')}.{REJECTS}"


def _triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(processingTime=trigger)


def _own_folder(root: str, batch: DataFrame, batch_id: int) -> str:
    """Folder of one micro-batch. It is replaced as a whole, so a replay leaves each event there once."""
    return f"{root}/query={_query_id(batch)}/batch={batch_id}"


def _query_id(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _batch_writer(spark: SparkSession, sink: str, target: str, layout: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """A function that appends a micro-batch to the sink exactly once. The Iceberg connector has no such
    mark for a batch written by hand, so there a replay after a crash may append it a second time."""
    if sink == "versions":
        return VersionedTable(spark, target, STORED, layout).stream_writer()
    if sink == "iceberg":
        return lambda batch, batch_id: IcebergTable(batch.sparkSession, target).append(batch)
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(_own_folder(target, batch, batch_id))


def _quarantining(append: Callable[[DataFrame, int], None], aside: str) -> Callable[[DataFrame, int], None]:
    """Two outputs of one parse: sound events go on to the sink, the others to ``aside``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        events = judged(batch).persist()
        try:
            rejects(events).write.mode("overwrite").parquet(_own_folder(aside, batch, batch_id))
            append(clean(sound(events)), batch_id)
        finally:
            events.unpersist()

    return write


def running_query(spark: SparkSession, checkpoint: str) -> StreamingQuery | None:
    """The active query of this session that uses the checkpoint, if any."""
    known = query_id(spark, checkpoint)
    return next((q for q in spark.streams.active if known and q.id == known), None)


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the query to which a checkpoint belongs; restarts keep it."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    found = spark.read.schema("id string").json(path).first() if exists(spark, path) else None
    return found["id"] if found else None
