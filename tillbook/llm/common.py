"""What the operators of this subpackage share: words, hashes, scratch tables, connected components."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbook.session import workspace

_MIX = np.uint64(0x9E3779B97F4A7C15)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROW_GROUP = 8 << 20  # a task that writes holds a row group, one that reads a column of it
_TO_A_FILE = 2


def save(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts the lineage, survives a lost executor."""
    path = workspace(frame.sparkSession, label)
    frame.write.option("parquet.block.size", str(_ROW_GROUP)).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def merged(frame: DataFrame) -> DataFrame:
    """The frame in fewer partitions, two of a shuffle to one but one for each core at least; a task goes through
    them one after the other. Sorts stay as small as they are while fewer files are written: without Hadoop's native
    library a process is started for each file, its checksums and its folder. Not for joins that are split because
    of a hot key, as that would put its parts together again."""
    spark = frame.sparkSession
    started = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions")
    return frame.coalesce(max(spark.sparkContext.defaultParallelism, -(-int(started) // _TO_A_FILE)))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of 8 MB at most for what runs inside: each task holds one or two on either side of the pipe."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "8m")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Only tables whose size was measured by a shuffle are broadcast by what runs inside. An estimate from files is
    too low by far behind an explode, which it takes for as many rows as went in: the driver would gather all of them."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before, own = spark.conf.get(planned), spark.conf.get(measured, None)
    if own is None:
        spark.conf.set(measured, before)
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        spark.conf.set(planned, before)
        if own is None:
            spark.conf.unset(measured)


_PIECE = 1 << 19  # bytes hashed at a time
_BASE = 0x9DDFEA08EB382D69
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_PLAIN = np.arange(1, 257, dtype=np.uint64)
_LOWER = _PLAIN + np.uint64(32) * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _PIECE + 1), _powers(pow(_BASE, -1, 2**64), _PIECE + 1)


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about _PIECE bytes that end after white space or with the data."""
    start = 0
    while start < len(data):
        end = min(start + _PIECE, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # one word longer than a piece
                rest = next((k for k in range(end, len(data), _PIECE) if _SPACE[data[k : k + _PIECE]].any()), None)
                end = len(data) if rest is None else rest + int(np.flatnonzero(_SPACE[data[rest : rest + _PIECE]])[0]) + 1
        yield start, end
        start = end


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and how many words each text has.

    A word is a maximal run of bytes other than space and 0x09-0x0D. Its hash is a polynomial in its
    bytes, taken from running sums, so that no word becomes a Python object.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    hashes, starts = [], []
    for start, end in _pieces(data):
        part = data[start:end]
        up, down = (_UP, _DOWN) if len(part) <= _PIECE else (_powers(_BASE, len(part)), _powers(pow(_BASE, -1, 2**64), len(part)))
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER if lower else _PLAIN)[part] * up[: len(part)], dtype=np.uint64)])
        hashes.append(mix((sums[last] - sums[first]) * down[first]))
        starts.append(first + start)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(text) + 1 for text in texts])
    upto = np.searchsorted(np.concatenate(starts), ends)
    return np.concatenate(hashes), np.diff(upto, prepend=0)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits of the input."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive elements; there are len - width + 1 of them."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _MIX + hashes[k : k + n]
    return mix(out)


def crc(doc_id: int | None) -> int | None:
    """crc32 of a number as decimal text; a row without a number has none."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, without turning a whole batch into Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(column.to_pylist() for column in part.columns))


def grouped(records: Iterator[tuple], weight, limit: int) -> Iterator[list[tuple]]:
    """Lists of consecutive records whose weights add up to about ``limit``; a heavier record stands alone."""
    held, total = [], 0
    for record in records:
        size = weight(record)
        if held and total + size > limit:
            yield held
            held, total = [], 0
        held.append(record)
        total += size
    if held:
        yield held


def carried(frame: DataFrame, columns: list[str]) -> list:
    """Columns that only travel along, under names that nothing else has."""
    return [F.col(name).alias(f"_carry_{k}") for k, name in enumerate(columns)]


def carry_schema(frame: DataFrame, columns: list[str]) -> str:
    return "".join(f", _carry_{k} {frame.schema[name].dataType.simpleString()}" for k, name in enumerate(columns))


def uncarried(columns: list[str]) -> list:
    return [F.col(f"_carry_{k}").alias(name) for k, name in enumerate(columns)]


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one edge and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not each.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge (u, v); the component is its smallest node.

    Alternating large and small stars: each round joins edges with one minimum per node, so no node's
    neighbours are gathered, and the rounds grow with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = save(edges, "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = save(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
