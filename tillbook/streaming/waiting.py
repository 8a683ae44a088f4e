"""Wait until a query has committed what had arrived at the source when it was asked."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import matching

_POLL = 0.2  # seconds


def settle(query: StreamingQuery, timeout: float = 600.0, *, location: str | None = None, checkpoint: str | None = None) -> None:
    """Return once everything that had arrived at the time of the call is committed, ``timeout`` seconds at most.

    For a source of files, ``location`` (its folder) and ``checkpoint`` say what has arrived and what is
    committed: a query that has nothing to do returns at once, and it does not matter what arrives meanwhile.
    Without them the offsets that the source reports are compared, as Kafka does; a source that reports none
    is waited for until the query ends. Raises the error of a failed query, and ``TimeoutError`` if the
    query is still behind.
    """
    if location and checkpoint:
        behind = _files_behind(_session(), location, checkpoint)
    else:
        behind = _offsets_behind(query)
    until = time.monotonic() + timeout
    while query.isActive and behind():
        if query.awaitTermination(min(_POLL, max(0.01, until - time.monotonic()))):
            break
        if time.monotonic() > until and behind():
            raise TimeoutError(f"the query has not caught up within {timeout} seconds")
    if query.exception():
        raise query.exception()


def settle_elsewhere(spark: SparkSession, location: str, checkpoint: str, timeout: float = 600.0) -> None:
    """``settle`` for a query that runs in another program and reads files."""
    behind = _files_behind(spark, location, checkpoint)
    until = time.monotonic() + timeout
    while behind():
        if time.monotonic() > until:
            raise TimeoutError(f"the query has not caught up within {timeout} seconds")
        time.sleep(_POLL)


def files_behind(spark: SparkSession, location: str, checkpoint: str) -> list[str]:
    """Files that have arrived and are in no committed batch: the lag of a consumer, whether it runs or not."""
    arrived, take = _arrived(spark, location), _taken(spark, checkpoint)
    return sorted(arrived - take(None)[0])


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _number(path: str) -> int:
    name = path.rsplit("/", 1)[1].removesuffix(".compact")
    return int(name) if name.isdigit() else -1


def _name(path: str) -> str:
    """A path as both the file system and the source's log can be compared by."""
    return re.sub("/+", "/", path.split(":", 1)[-1])


def _arrived(spark: SparkSession, location: str) -> set[str]:
    return {_name(path) for path, _ in matching(spark, f"{location}/*") if not path.rsplit("/", 1)[1].startswith(("_", "."))}


def _taken(spark: SparkSession, checkpoint: str) -> Callable[[int | None], tuple[set[str], int]]:
    """Gives the files of all committed batches and the number of the newest; no files if that is the given one."""
    place = checkpoint.rstrip("/")

    def take(known: int | None) -> tuple[set[str], int]:
        newest = max((_number(path) for path, _ in matching(spark, f"{place}/commits/*")), default=-1)
        if newest < 0 or newest == known:
            return set(), newest
        lines = spark.read.schema("path string, batchId long").json(f"{place}/sources/0")
        return {_name(unquote(row["path"])) for row in lines.filter(f"batchId <= {newest}").select("path").collect()}, newest

    return take


def _files_behind(spark: SparkSession, location: str, checkpoint: str) -> Callable[[], bool]:
    """Whether files that are in the folder now are in no committed batch."""
    waiting, take, seen = _arrived(spark, location), _taken(spark, checkpoint), [None]

    def behind() -> bool:
        if waiting:
            files, seen[0] = take(seen[0])
            waiting.difference_update(files)
        return bool(waiting)

    return behind


def _offsets_behind(query: StreamingQuery) -> Callable[[], bool]:
    """Whether a batch has yet to reach the offsets that were the latest at the call."""
    progress = query.lastProgress
    wanted = [_offset(source["latestOffset"]) for source in progress["sources"]] if progress else None

    def behind() -> bool:
        now = query.lastProgress
        if wanted is None or now is None or any(w is None for w in wanted):
            return True
        return not all(_reached(_offset(source["endOffset"]), w) for source, w in zip(now["sources"], wanted))

    return behind


def _offset(value):
    try:
        return json.loads(value) if isinstance(value, str) else value
    except ValueError:
        return None


def _reached(at, wanted) -> bool:
    """Offsets are numbers, or numbers by topic and partition."""
    if isinstance(wanted, dict):
        return isinstance(at, dict) and all(key in at and _reached(at[key], value) for key, value in wanted.items())
    return at is not None and at >= wanted
