"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, ExitStack, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Event times are UTC everywhere; window state can outgrow executor heap, so it lives in RocksDB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Store what a batch changed, not whole state files, when a stream commits.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MB = 1 << 20
# Stored bytes behind one shuffle partition or scan task, and how many of them a job should have at most:
# beyond that the blocks between tasks get too many and too small, so tasks get larger instead.
PARTITION_BYTES = 128 * MB
MOST_SHUFFLE_PARTITIONS = 40_000
MOST_SCAN_TASKS = 200_000
LARGEST_SCAN_TASK = 1024 * MB
# Files of a written table: small ones while there are few.
SMALLEST_FILE, LARGEST_FILE, MOST_FILES = 64 * MB, 1024 * MB, 100_000


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this library relies on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Tables by date have thousands of folders: list them with a few tasks per slot, not one per folder.
    listing_tasks = min(10_000, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing_tasks))
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths, 0 if there are none. Only lists them; their content is not read."""
    total = 0
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        total += files.agg(F.sum("length")).first()[0] or 0
    return total


def sizes_for(stored: int, least: int = 1) -> dict[str, str]:
    """Shuffle partitions, scan tasks and written files for an input of so many bytes.

    Spark merges shuffle partitions that turn out small, but does not split those of an aggregate or a
    window that turn out large, so it has to start with enough of them. Files of large tables are written larger,
    as there would be millions of them else.
    """
    partitions = max(least, min(MOST_SHUFFLE_PARTITIONS, -(-stored // PARTITION_BYTES)))
    scan_bytes = max(PARTITION_BYTES, min(LARGEST_SCAN_TASK, stored // MOST_SCAN_TASKS))
    file_bytes = max(SMALLEST_FILE, min(LARGEST_FILE, stored // MOST_FILES))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
            "spark.sql.files.maxPartitionBytes": str(scan_bytes),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)}


@contextmanager
def sized(spark: SparkSession, stored: int) -> Iterator[None]:
    """Sizes for an input of so many bytes, for the duration of a block; what runs later has the session's own."""
    with ExitStack() as block:
        for key, value in sizes_for(stored, int(spark.conf.get("spark.sql.shuffle.partitions"))).items():
            block.enter_context(setting(spark, key, value))
        yield


def sized_for(spark: SparkSession, *paths: str) -> AbstractContextManager[None]:
    """Sizes for what is stored below the paths."""
    return sized(spark, stored_bytes(spark, *paths))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One session setting for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def build_session(app_name: str = "kerbside", **extra: str) -> SparkSession:
    """A session for the command line; master, memory and cores come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def working_folder(spark: SparkSession, label: str) -> str:
    """A new folder for written tables, below the folder named in `spark.checkpoint.dir`.

    Only a local session may fall back to a machine-local folder; a cluster has to name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="kerbside-")
    return f"{root.rstrip('/')}/kerbside/{label}-{uuid.uuid4().hex}"
