"""Starting, running and stopping the streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from kerbside.schemas import CANCELLATIONS, FEEDS, LOCATIONS, PAYMENTS, RIDES, Feed
from kerbside.session import setting, working_folder
from kerbside.sources.files import path_exists, union_all
from kerbside.sources.topics import decode
from kerbside.streaming.windows import (availability_windows, cancellation_windows, payment_rates, payment_windows,
                                        ride_monitor, ride_windows)

# How long a window stays open for late records, and how often a stream looks for new ones.
DELAY = "90 days"
INTERVAL = "30 seconds"
SHOWN = 30


@dataclass(frozen=True)
class StreamTable:
    name: str
    feed: Feed
    build: Callable[[DataFrame], DataFrame]
    minutes: int   # length of its windows


# Shares by method, for those who ask for them; a second table of the payments topic.
RATE_TABLE = StreamTable("payment_success", PAYMENTS, payment_rates, 5)

STREAM_TABLES = {t.name: t for t in (
    StreamTable("ride_windows", RIDES, ride_windows, 5),
    StreamTable("driver_availability", LOCATIONS, availability_windows, 1),
    StreamTable("payment_rates", PAYMENTS, payment_windows, 5),
    StreamTable("cancellation_breakdown", CANCELLATIONS, cancellation_windows, 5),
)}


def _trigger(once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": INTERVAL}


def state_partitions(spark: SparkSession, n: int) -> AbstractContextManager:
    """Start streams with n state partitions. The number is fixed by a stream's first start."""
    return setting(spark, "spark.sql.shuffle.partitions", str(n))


def decode_stream(records: DataFrame, feed: Feed, delay: str = DELAY, drop_repeats: bool = False) -> DataFrame:
    """Decoded records of a stream, which waits `delay` for late ones.

    With `drop_repeats` records that are delivered again within the delay are dropped: those of one id and one time of
    event. A later event of the same id is a record of its own. An id and time are kept until the delay has passed.
    """
    rows = decode(records, feed).withWatermark("event_ts", delay)
    return rows.dropDuplicatesWithinWatermark([feed.key, "event_ts"]) if drop_repeats else rows


def start_table(records: DataFrame, table: StreamTable, warehouse: str, delay: str = DELAY,
                once: bool = False, drop_repeats: bool = False, move: bool = False) -> StreamingQuery:
    """Append closed windows to a Parquet table. A restart goes on where the checkpoint says.

    The number of state partitions is part of a checkpoint. With `move` a stopped stream goes on under a new one, with as
    many as the session says now, and a new folder of windows beside the old one (`read_table` reads both). Windows that
    the old one has written are final; it reads the topic from its beginning once more, but only the records of
    windows that were still open, by the watermark of the last batch that the old one finished.
    """
    spark = records.sparkSession
    generation = max(0, generations(spark, warehouse, table) - 1) + move
    rows = decode_stream(records, table.feed, delay, drop_repeats)
    if generation:
        written = written_until(spark, _checkpoint(warehouse, table, generation - 1))
        if written is not None:
            # The beginning of the first window that ends later.
            rows = rows.filter(F.col("event_ts") >= F.timestamp_millis(F.lit(written - written % (table.minutes * 60_000))))
    return (table.build(rows).writeStream.queryName(table.name).outputMode("append").format("parquet")
            .option("path", _folder(warehouse, table, generation))
            .option("checkpointLocation", _checkpoint(warehouse, table, generation))
            .trigger(**_trigger(once)).start())


def _suffix(generation: int) -> str:
    return f".{generation}" if generation else ""


def _folder(warehouse: str, table: StreamTable, generation: int) -> str:
    return f"{warehouse}/streaming/{table.name}{_suffix(generation)}"


def _checkpoint(warehouse: str, table: StreamTable, generation: int) -> str:
    return f"{warehouse}/checkpoints/{table.name}{_suffix(generation)}"


def generations(spark: SparkSession, warehouse: str, table: StreamTable) -> int:
    """How many checkpoints a stream has had: none before its first start, one more with each move."""
    n = 0
    while path_exists(spark, f"{_checkpoint(warehouse, table, n)}/offsets"):
        n += 1
    return n


def written_until(spark: SparkSession, checkpoint: str) -> int | None:
    """Watermark in milliseconds of the last finished batch of a stream, up to which closed windows are written."""
    done = spark.read.text(f"{checkpoint}/commits").select(F.col("_metadata.file_name").try_cast("long").alias("batch"))
    last = done.agg(F.max("batch")).first()[0]
    if last is None:
        return None
    lines = spark.read.text(f"{checkpoint}/offsets/{last}")
    return lines.select(F.max(F.get_json_object("value", "$.batchWatermarkMs").cast("long"))).first()[0]


def read_table(spark: SparkSession, warehouse: str, table: StreamTable) -> DataFrame:
    """The windows that a stream has written under all its checkpoints."""
    return union_all(spark.read.parquet(_folder(warehouse, table, n))
                     for n in range(max(1, generations(spark, warehouse, table)))
                     if n == 0 or path_exists(spark, f"{_folder(warehouse, table, n)}/_spark_metadata"))


def start_monitor(records: DataFrame, delay: str = DELAY, once: bool = False, folder: str | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Show the latest minutes of the ride monitor, or store each of its results below `folder`.

    The whole result is worked out anew each time (complete mode), by the tasks. Only the SHOWN rows that are printed
    come to the driver. Of stored results the last two stay: each goes to one of two folders in turn, and a
    reader looks at the one whose number was noted last, which the next result does not touch.
    """
    spark = records.sparkSession

    def show(result: DataFrame, batch: int) -> None:
        latest_minutes(result).show(SHOWN, truncate=False)

    def store(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{folder}/result-{batch % 2}")
        spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/finished/slot={batch % 2}")

    writer = ride_monitor(decode_stream(records, RIDES, delay)).writeStream.outputMode("complete")
    writer = writer.foreachBatch(store if folder else show)
    # State goes to the shared folder like that of every other stream.
    writer = writer.option("checkpointLocation", checkpoint or working_folder(spark, "monitor"))
    return writer.trigger(**_trigger(once)).start()


def latest_minutes(result: DataFrame) -> DataFrame:
    """The newest SHOWN rows of a monitor result; each task keeps as many, so no more than these are collected."""
    return result.orderBy(F.col("minute").desc(), "city").limit(SHOWN)


def latest_monitor(spark: SparkSession, folder: str) -> DataFrame:
    """The newest stored result of the ride monitor that is finished."""
    batch = spark.read.parquet(f"{folder}/finished").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{folder}/result-{batch % 2}")


def run_once(query: StreamingQuery) -> None:
    """Wait for a stream that was started with once=True; a failed stream raises here."""
    query.awaitTermination()


def start_topics(spark: SparkSession, source: Callable[[str], DataFrame], warehouse: str,
                 topics: Iterable[str] | None = None, delay: str = DELAY, monitor: bool = True,
                 once: bool = False, drop_repeats: bool = False, move: bool = False) -> list[StreamingQuery]:
    """Start the tables (and the monitor) of the chosen topics; `source` gives a topic's records."""
    queries = []
    for topic in topics or FEEDS:
        for table in STREAM_TABLES.values():
            if table.feed.name == topic:
                queries.append(start_table(source(topic), table, warehouse, delay, once, drop_repeats, move))
        if monitor and topic == RIDES.name:
            queries.append(start_monitor(source(topic), delay, once))
    return queries


def run_topics(spark: SparkSession, source: Callable[[str], DataFrame], warehouse: str,
               topics: Iterable[str] | None = None, runtime: float | None = None, **options) -> None:
    """Run the chosen topics until one ends, or for `runtime` seconds, then stop them all."""
    spark.streams.resetTerminated()
    queries = start_topics(spark, source, warehouse, topics, **options)
    try:
        if options.get("once"):
            for query in queries:
                run_once(query)
        elif runtime is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(int(runtime))
    finally:
        for query in queries:
            query.stop()
