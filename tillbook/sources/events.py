"""Raw event sources. Each returns a streaming frame with one column, ``value BINARY``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import TOPIC
from ..session import exists

KINDS = ("kafka", "files", "table")
STARTS = ("latest", "earliest")


def raw_source(
    spark: SparkSession,
    kind: str,
    location: str,
    *,
    topic: str = TOPIC,
    start: str | None = None,
    checkpoint: str | None = None,
    tolerate_loss: bool = False,
    per_batch: int | None = None,
) -> DataFrame:
    """Open a stream of raw events.

    ``kafka`` reads ``topic`` from the brokers in ``location``; its connector must be on the class path.
    ``files`` reads text files with one event per line, ``table`` reads Parquet files with a ``value`` column.

    ``start="latest"`` skips what was there before the first start. It is the default for Kafka, which
    does it itself; a folder is read from the beginning by default, and for ``latest`` the time of the
    first start is kept beside ``checkpoint``. Offsets or files that have vanished are an error unless
    ``tolerate_loss`` is set. ``per_batch`` bounds a micro-batch to so many events of Kafka, or files of
    a folder.
    """
    if kind not in KINDS:
        raise ValueError(f"source kind must be one of {KINDS}, not {kind!r}")
    if start not in (None, *STARTS):
        raise ValueError(f"start must be one of {STARTS}, not {start!r}")
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", start or "latest")
            .option("failOnDataLoss", "false" if tolerate_loss else "true")
        )
        if per_batch:
            reader = reader.option("maxOffsetsPerTrigger", per_batch)
        return reader.load().select("value")

    reader = spark.readStream.option("ignoreMissingFiles", "true" if tolerate_loss else "false")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if kind == "files":
        found = reader.format("text").schema("value string").load(location)
    else:
        found = reader.format("parquet").schema("value binary").load(location)
    if start == "latest":
        if not checkpoint:
            raise ValueError('start="latest" on a folder needs the checkpoint it belongs to')
        found = found.filter(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(_first_start(spark, checkpoint))))
    return found.select(F.col("value").cast("binary").alias("value"))


def _first_start(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds of the first start with this checkpoint; written down on that start."""
    path = f"{checkpoint.rstrip('/')}.first_start"
    if not exists(spark, path):
        now = spark.range(1).select(F.unix_millis(F.current_timestamp()).alias("millis"))
        now.write.mode("errorifexists").json(path)
    return spark.read.schema("millis bigint").json(path).first()["millis"]


def publish(raw: DataFrame, brokers: str, topic: str = TOPIC) -> None:
    """Send a batch of raw events to Kafka, without a key. Needs the Kafka connector."""
    (
        raw.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def publish_stream(raw: DataFrame, brokers: str, checkpoint: str, topic: str = TOPIC):
    """Send a stream of raw events to Kafka, without a key. Needs the Kafka connector."""
    return (
        raw.select("value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
