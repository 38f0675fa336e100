"""Topics: records of (topic, key, value), where value is JSON text whose members are all text.

A folder of records is like a broker's topic: the writing task is a record's `partition`, and numbers its records from 0
on as they come (`offset`). So arrival is known and counted without any order over the whole topic, and nothing is
sorted or shuffled to write it. `sent_at` is the time of the event that the record tells of, `written_at` that of the write.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.convert import as_text, blank_to_null
from kerbside.schemas import Feed
from kerbside.sources.files import union_all

RECORD_SCHEMA = "key string, value string"
STORED_SCHEMA = ("key string, value string, sent_at timestamp, partition int, offset long, written_at timestamp, "
                 "topic string")
ARRIVAL = ("written_at", "offset", "partition")
# A monotonically increasing id holds the task's number above so many bits, and its records' numbers below.
OFFSET_BITS = 33
# Values are nearly all different, so a dictionary of them costs time and saves nothing.
FILE_OPTIONS = {"parquet.enable.dictionary": "false"}


def topic_options(topic: str, servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_topic(spark: SparkSession, topic: str, servers: str, **options: str) -> DataFrame:
    """A broker topic as a stream, from its first record. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(topic, servers), **options).load()


def read_topic_batch(spark: SparkSession, topic: str, servers: str) -> DataFrame:
    """All records a broker topic holds now."""
    return spark.read.format("kafka").options(**topic_options(topic, servers)).load()


def read_topic_files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """A folder of topic records as a stream; new files are new records."""
    return spark.readStream.schema(RECORD_SCHEMA).options(**options).parquet(folder)


def read_topic_files_batch(spark: SparkSession, folder: str) -> DataFrame:
    """All records a folder holds now, of one topic or of several (`topic` is null for one), with their places."""
    return spark.read.schema(STORED_SCHEMA).parquet(folder)


def topic_records(df: DataFrame, feed: Feed, columns: Sequence[str] | None = None, timed: bool = False) -> DataFrame:
    """Rows as topic records. Numbers and times become text, blanks become JSON nulls.

    With `timed` the records carry `sent_at`, the time of the event, as a column that can be read without the value.
    """
    names = list(columns or feed.columns)
    value = F.to_json(F.struct(*[blank_to_null(as_text(df, c), c) for c in names]), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(feed.name).alias("topic"),
        as_text(df, feed.topic_key).alias("key"),
        value.alias("value"),
        *([F.col("event_timestamp").cast("timestamp").alias("sent_at")] if timed else []),
    )


def write_topic_files(records: DataFrame, folder: str, mode: str = "append") -> None:
    """Add records of one topic to a folder, each with its place there (see above). Those of one write share `written_at`."""
    _placed(records.drop("topic")).write.mode(mode).options(**FILE_OPTIONS).parquet(folder)


def write_topics(records: DataFrame, folder: str) -> None:
    """Add records of any topics to a folder that holds a folder `topic=<name>` for each, in one job.

    A task writes one file for each topic that it has records of; the union of several feeds gives it one topic.
    """
    _placed(records).write.mode("append").options(**FILE_OPTIONS).partitionBy("topic").parquet(folder)


def _placed(records: DataFrame) -> DataFrame:
    offset = F.monotonically_increasing_id().bitwiseAND((1 << OFFSET_BITS) - 1)
    sent_at = F.col("sent_at") if "sent_at" in records.columns else F.lit(None).cast("timestamp")
    return records.withColumns({"sent_at": sent_at, "partition": F.spark_partition_id(), "offset": offset,
                                "written_at": F.lit(datetime.now(timezone.utc))})


def write_topic(records: DataFrame, servers: str) -> None:
    """Send records to the broker topics named in their `topic` column."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def first_records(records: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first n records of one topic."""
    return records.orderBy(*order).limit(n)


def decode(records: DataFrame, feed: Feed) -> DataFrame:
    """Typed columns and `event_ts` from topic records.

    Members are read as text and then converted, so quoted and bare numbers both work; what cannot be
    converted, or is not JSON at all, is NULL and does not stop a stream.
    """
    data = records.select(F.from_json(F.col("value").cast("string"), feed.topic_schema()).alias("data"))
    flat = data.select("data.*")
    numbers = {c: F.col(c).try_cast("double") for c in feed.of_type("double") if c in feed.topic_columns}
    return flat.withColumns({**numbers, "event_ts": F.try_to_timestamp(F.col("event_timestamp"))})


def tail(topics: Iterable[DataFrame], n: int, order: Sequence[Column]) -> DataFrame:
    """The first n records of every topic. Each task keeps n of them, so no topic is sorted or shuffled."""
    return union_all(first_records(records, n, order) for records in topics)


def topic_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("n_records"))


def topic_places(records: DataFrame) -> DataFrame:
    """Of stored topics: the records, how many there are by the last place in each partition, and whether these agree.

    A partition numbers its records from 0 on within each write. They are `whole` if each has as many records as its last
    place says and its places add up; not so if a write is incomplete, or seen twice. Values are not read.
    """
    each = records.groupBy("topic", "written_at", "partition").agg(
        F.count("*").alias("n"), (F.max("offset") + 1).alias("last"), F.sum("offset").alias("places"))
    whole = (F.col("n") == F.col("last")) & (2 * F.col("places") == F.col("n") * (F.col("n") - 1))
    return each.groupBy("topic").agg(F.sum("n").alias("n_records"), F.sum("last").alias("n_by_place"),
                                     F.every(whole).alias("whole"))
