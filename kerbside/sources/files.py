"""CSV, JSON and Parquet reading and writing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.session import setting

# Text is stored by gzip, which takes about a fifth of the space but cannot be split: a file ends after so many rows, so
# that many tasks read a large feed.
CSV_ROWS = 250_000


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text; blank cells are NULL.

    Columns are matched by header name, and a file whose header differs from the others fails the job
    instead of shifting values into the wrong column.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("compression", "gzip")
     .option("maxRecordsPerFile", CSV_ROWS).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType, array_files: bool = False) -> DataFrame:
    """JSON records: one per line, which Spark can split, or one array per file with array_files."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """Records as files that each hold one array of up to `rows` of them."""
    chunk = F.struct(F.spark_partition_id(), F.floor(F.monotonically_increasing_id() % (1 << 33) / rows))
    arrays = (df.select(F.struct(*df.columns).alias("record"), chunk.alias("chunk"))
              .groupBy("chunk").agg(F.collect_list("record").alias("records")))
    (arrays.select(F.to_json("records", {"ignoreNullFields": "false"}))
     .write.mode("overwrite").option("maxRecordsPerFile", 1).text(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system the session knows."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on any file system the session knows; nothing happens where there is none."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


def scan(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """A stored table with its partition columns; a filter on them leaves the other folders unread."""
    df = spark.read.parquet(path)
    return df if where is None else df.filter(where)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or no rows of the given schema when the path is missing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    frames = list(frames)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Replace a Parquet table and return its number of rows.

    For a partitioned table the rows of one partition value are first brought together, so that tasks
    do not each write a small file for every value; Spark cuts a value that holds much of the data into
    several files of its advised size. Rows are counted by the final tasks of the write itself, which
    saves running the plan again and stays right when lost tasks are repeated.
    """
    written = Observation()
    if partition_by is None:
        (df.observe(written, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").option("compression", "zstd").parquet(path))
        return written.get["n"]
    # Where partitions are many and small, opening files costs more than writing them: keep tasks small too.
    with setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB"):
        (df.hint("rebalance", partition_by)
         .observe(written, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").option("compression", "zstd").partitionBy(partition_by).parquet(path))
    return written.get["n"]
