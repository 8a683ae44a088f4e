"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here assumes. Partition counts are left to AQE, the master and the
# memory sizes to spark-submit.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Files of a shuffle go when the query that made them has ended, not when the driver collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Beyond this many partitions the bookkeeping of a shuffle costs more than larger, spilling tasks.
_MOST_PARTITIONS = 20_000
_SHUFFLE_BYTES = 64 << 20
_MOST_SPLITS = 200_000
_SPLIT_BYTES = 128 << 20
_LARGEST_SPLIT = 1 << 30


def session_conf(table_format: str = "versions", warehouse: str | None = None, catalog: str = "local") -> dict[str, str]:
    """Settings for a session; ``iceberg`` adds the catalogue, whose jar must be on the class path."""
    conf = dict(RUNTIME)
    if table_format == "iceberg":
        if not warehouse:
            raise ValueError("the iceberg catalogue needs a warehouse path")
        name = f"spark.sql.catalog.{catalog}"
        conf |= {
            "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
            name: "org.apache.iceberg.spark.SparkCatalog",
            f"{name}.type": "hadoop",
            f"{name}.warehouse": warehouse,
        }
    elif table_format != "versions":
        raise ValueError(f"unknown table format {table_format!r}")
    return conf


def open_session(app: str, conf: dict[str, str]) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, folder: str) -> SparkSession:
    """Start shuffles with a partition per 64 MB of input below ``folder``; AQE merges what turns out
    small. A fixed number that suits a test would put hundreds of GB into one task at 100 TB. Scans of
    very large folders get larger splits, as a shuffle has a block per scan task and partition."""
    size, _ = content(spark, folder)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(max(configured, size // _SHUFFLE_BYTES), max(configured, _MOST_PARTITIONS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wanted)
    if size > _MOST_SPLITS * _SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", min(size // _MOST_SPLITS, _LARGEST_SPLIT))
    return spark


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    ``spark.checkpoint.dir`` names the shared folder of a cluster. Only a local session without that
    setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix=f"{label}-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")


def written(frame: DataFrame, label: str) -> DataFrame:
    """A frame put down in the scratch folder and read again: its size is known to joins and it is made once."""
    path = workspace(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def content(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Bytes and number of the files below a folder, on whatever file system the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path)
    return found.getLength(), found.getFileCount()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and modification time (milliseconds) of the files and folders that a pattern names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [(status.getPath().toString(), status.getModificationTime()) for status in found]
