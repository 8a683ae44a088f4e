"""Ingest sale events until stopped."""

from __future__ import annotations

import argparse
import os
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.parts import whole
from ..schema import TOPIC
from ..sources.events import KINDS, STARTS, raw_source
from ..streaming.ingest import SINKS, start_ingest, stored_events
from ..streaming.journal import Journal
from . import options


def parser(description: str) -> argparse.ArgumentParser:
    known = options.parser(description)
    known.add_argument("--sink", choices=SINKS, default=os.environ.get("WRITE_MODE", "versions"))
    known.add_argument("--source", choices=KINDS, default="kafka")
    known.add_argument("--location", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
                       help="brokers, or the folder with events")
    known.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC", TOPIC))
    known.add_argument("--start", choices=STARTS)
    known.add_argument("--tolerate-loss", action="store_true", help="go on when events have vanished from the source")
    known.add_argument("--checkpoint", required=True, help="folder that all executors can reach")
    known.add_argument("--trigger", default="10 seconds", help="interval, or availableNow")
    known.add_argument("--per-batch", type=int, help="most events (kafka) or files of a micro-batch")
    known.add_argument("--mode", default="strict", help="strict or quarantine")
    known.add_argument("--journal", help="folder for a row per micro-batch")
    return known


def checked(known: argparse.ArgumentParser, chosen: argparse.Namespace) -> argparse.Namespace:
    if chosen.sink not in SINKS:  # argparse does not check a default from the environment
        known.error(f"unknown sink {chosen.sink!r}, use one of {SINKS}")
    if chosen.sink == "iceberg":
        chosen.format = "iceberg"
    return chosen


def target(chosen: argparse.Namespace) -> str:
    return f"{options.location(chosen)}.parquet" if chosen.sink == "parquet" else options.location(chosen)


def start(spark: SparkSession, chosen: argparse.Namespace) -> StreamingQuery:
    if chosen.sink == "iceberg":
        options.opened(spark, chosen).create()
    raw = raw_source(
        spark, chosen.source, chosen.location, topic=chosen.topic, start=chosen.start,
        checkpoint=chosen.checkpoint, tolerate_loss=chosen.tolerate_loss, per_batch=chosen.per_batch,
    )
    return start_ingest(raw, chosen.sink, target(chosen), chosen.checkpoint, trigger=chosen.trigger, mode=chosen.mode)


def stored(spark: SparkSession, chosen: argparse.Namespace) -> DataFrame:
    """The whole transactions that the sink holds."""
    if chosen.sink == "parquet":
        return whole(stored_events(spark, target(chosen)))
    return options.opened(spark, chosen).current()


def main(arguments: list[str] | None = None) -> None:
    known = parser(__doc__)
    chosen = checked(known, known.parse_args(arguments))
    spark = options.session("ingest", chosen)
    with Journal(spark, chosen.journal) if chosen.journal else nullcontext() as journal:
        query = start(spark, chosen)
        query.awaitTermination()
        if journal:
            journal.wait(query)


if __name__ == "__main__":
    main()
