"""Faults on purpose: a stream that dies between the steps by which a batch becomes final.

A batch of a file sink becomes final in three steps: its tasks write files, the sink lists them in the table's log
(`_spark_metadata`), and the stream notes the batch as done in its checkpoint (`commits`). A driver may be lost between any two of
these. `unfinish` takes a stopped stream back to such a point, by removing what the lost driver would not have written, so that a
restart has to get over it. Readers and the restarted stream are those of everyday use.
"""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

LOGGED = "logged"      # files written and listed, batch not noted as done
WRITTEN = "written"    # files written, neither listed nor noted


def unfinish(spark: SparkSession, table_folder: str, checkpoint: str, point: str) -> int:
    """Take the last finished batch of a stopped stream back to a point, and return its number.

    The stream's folders may be on any file system that the session knows. Batches whose list of files has been folded into a
    summary cannot be taken back to WRITTEN.
    """
    if point not in (LOGGED, WRITTEN):
        raise ValueError(f"point must be {LOGGED!r} or {WRITTEN!r}, not {point!r}")
    batch = max(_numbers(spark, f"{checkpoint}/commits"))
    if point == WRITTEN:
        listed = f"{table_folder}/_spark_metadata"
        if batch in _numbers(spark, listed):
            _remove(spark, f"{listed}/{batch}")
        elif batch in _numbers(spark, listed, ".compact"):
            raise ValueError(f"batch {batch} is part of a summary")
    _remove(spark, f"{checkpoint}/commits/{batch}")
    return batch


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def _numbers(spark: SparkSession, folder: str, ending: str = "") -> list[int]:
    """Numbers that name the files of a log: one per batch."""
    files, path = _file_system(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return [int(n.removesuffix(ending)) for n in names if n.endswith(ending) and n.removesuffix(ending).isdigit()]


def _remove(spark: SparkSession, path: str) -> None:
    files, found = _file_system(spark, path)
    if not files.delete(found, False):
        raise FileNotFoundError(path)
