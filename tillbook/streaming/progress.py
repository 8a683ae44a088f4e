"""Progress of a query as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_PROGRESS = """
    query_id STRING, name STRING, batch_id BIGINT, started_at STRING, input_rows BIGINT,
    input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, duration_ms BIGINT,
    source STRING, start_offset STRING, end_offset STRING, latest_offset STRING
"""


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch and source: rates, and how far it is behind the latest offset.
    Spark keeps a bounded number of recent batches."""
    rows = [
        (
            str(batch["id"]), batch["name"], batch["batchId"], batch["timestamp"], source["numInputRows"],
            source["inputRowsPerSecond"], source["processedRowsPerSecond"],
            batch["durationMs"].get("triggerExecution"), source["description"],
            *(_text(source[key]) for key in ("startOffset", "endOffset", "latestOffset")),
        )
        for batch in query.recentProgress
        for source in batch["sources"]
    ]
    return spark.createDataFrame(rows, _PROGRESS)


def _text(offset) -> str | None:
    return None if offset is None else str(offset)
