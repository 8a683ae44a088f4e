"""Progress and quality counts of micro-batches, kept after their query has stopped.

Spark itself remembers a bounded number of batches of running queries. A ``Journal`` listens to all queries
of a session and writes one row per batch below a folder, under the query's id, which restarts share. The
quality counts were observed by the tasks that wrote the rows; no second scan is made.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..plans.quality import OBSERVED, RULES
from ..session import matching

_ROW = """
    query_id STRING, run_id STRING, name STRING, batch_id BIGINT, started_at STRING, input_rows BIGINT,
    input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, duration_ms BIGINT, late_rows BIGINT,
    row_count BIGINT, null_transaction_ids BIGINT, failed_payments BIGINT,
    sources ARRAY<STRUCT<description: STRING, start_offset: STRING, end_offset: STRING, latest_offset: STRING>>
"""


class Journal(StreamingQueryListener):
    """Writes a row per micro-batch to ``folder``. Use it as a context, or attach and detach it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __enter__(self) -> Journal:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        """Spark says so every ten seconds or so."""
        self._put(f"alive/query={event.id}", [str(event.timestamp)])

    def onQueryTerminated(self, event) -> None:
        """A mark that all progress of this run has been written."""
        self._put(f"ended/run={event.runId}", [json.dumps({"query_id": str(event.id)})])

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        self._put(f"alive/query={progress['id']}", [progress["timestamp"]])
        if not progress["numInputRows"]:
            return
        counts = progress.get("observedMetrics", {}).get(OBSERVED, {})
        row = {
            "query_id": progress["id"], "run_id": progress["runId"], "name": progress.get("name"), "batch_id": progress["batchId"],
            "started_at": progress["timestamp"], "input_rows": progress["numInputRows"],
            "input_rows_per_second": progress.get("inputRowsPerSecond"), "processed_rows_per_second": progress.get("processedRowsPerSecond"),
            "duration_ms": progress["durationMs"].get("triggerExecution"),
            "late_rows": sum(state.get("numRowsDroppedByWatermark", 0) for state in progress.get("stateOperators", [])),
            "sources": [
                {"description": source["description"]} | {_snake(key): _text(source.get(key)) for key in ("startOffset", "endOffset", "latestOffset")}
                for source in progress["sources"]
            ],
        } | {rule: counts.get(rule) for rule, _, _ in RULES}
        self._put(f"batches/query={progress['id']}/batch={progress['batchId']}", [json.dumps(row)])

    def _put(self, place: str, lines: list[str]) -> None:
        """A batch that is replayed after a crash replaces its row."""
        made = self.spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))
        made.write.mode("overwrite").text(f"{self.folder}/{place}")

    def rows(self) -> DataFrame:
        """One row per batch with data: rates, offsets of the sources, rows too late for a watermark, quality counts."""
        if not matching(self.spark, f"{self.folder}/batches/query=*"):
            return self.spark.createDataFrame([], _ROW)
        return self.spark.read.schema(_ROW).option("recursiveFileLookup", "true").json(f"{self.folder}/batches")

    def alive(self, query_id: str, within: float = 60.0) -> bool:
        """Whether a query, of any program that writes to this journal, gave a sign of life lately."""
        signs = [written for _, written in matching(self.spark, f"{self.folder}/alive/query={query_id}/_SUCCESS")]
        return bool(signs) and time.time() - max(signs) / 1000 < within

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until everything that an ended run reported is written; reports come a moment after the run."""
        until = time.monotonic() + timeout
        while not matching(self.spark, f"{self.folder}/ended/run={query.runId}/_SUCCESS"):
            if time.monotonic() > until:
                raise TimeoutError(f"no report of the end of run {query.runId} within {timeout} seconds")
            time.sleep(0.05)


def _snake(key: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in key)


def _text(offset) -> str | None:
    return None if offset is None else offset if isinstance(offset, str) else json.dumps(offset)
