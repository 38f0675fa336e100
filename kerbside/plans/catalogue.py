"""Every query of the engine over a data folder, by name.

Each entry takes a session and a folder of star-schema tables, and reads those tables whole. Entries that
store something write to a new folder below the cluster's shared working folder.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions.convert import local_times, to_text
from kerbside.functions.pricing import fare_quote, shift_seconds, surge_at
from kerbside.operators import gold, layers, marts
from kerbside.operators.changes import (change_feed, delete_audit, delete_where, first_driver, merge_update,
                                        open_ride_updates)
from kerbside.operators.dedup import keep_first, keep_latest
from kerbside.operators.derive import derive_cancellations, derive_payments
from kerbside.operators.quality import check_tables, table_counts, validate_inputs, validate_outputs
from kerbside.plans import warehouse as wh
from kerbside.plans.questions import QUESTIONS
from kerbside.schemas import FEEDS, LOCATIONS, PAYMENTS, RIDES
from kerbside.session import prepare, sized, stored_bytes, working_folder
from kerbside.sources import feeds, topics
from kerbside.sources.files import (read_csv, read_json, scan, scan_or_empty, union_all, write_csv, write_json,
                                    write_json_arrays, write_table)
from kerbside.sources.keyed import KeyedTable
from kerbside.streaming import faults, runs, windows

DELAY = "10 minutes"
CLOSED_AT = "2024-03-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_STORED: dict[str, int] = {}


def register(name: str, build: Query) -> None:
    """Add a query. Times in its result are shown as UTC wall-clock times.

    What a query stores and reads back is written in sizes for its input; they do not outlast it.
    """
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if sf_dir not in _STORED:
            _STORED[sf_dir] = stored_bytes(spark, sf_dir)
        with sized(prepare(spark), _STORED[sf_dir]):
            return local_times(build(spark, sf_dir))
    QUERIES[name] = run


def query(build: Query) -> Query:
    register(build.__name__.strip("_"), build)
    return build


# -- inputs ------------------------------------------------------------------------------------------

def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return layers.SILVER[name](feeds.READERS[name](spark, sf_dir))


def all_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: silver(spark, sf_dir, name) for name in FEEDS}


def rides_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, RIDES.name)


def report(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    feed, build = gold.GOLD[table]
    return build(silver(spark, sf_dir, feed))


def timed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed as stored, with the event time the window summaries ask for."""
    return feeds.READERS[name](spark, sf_dir).withColumn("event_ts", F.col("event_timestamp").cast("timestamp"))


def records_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return topics.topic_records(feeds.READERS[name](spark, sf_dir), FEEDS[name])


def closed_at() -> Column:
    return F.lit(CLOSED_AT).cast("timestamp_ntz")


# -- bronze, silver, gold ----------------------------------------------------------------------------

def _bronze(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = working_folder(spark, f"csv-{name}")
        write_csv(to_text(feeds.READERS[name](spark, sf_dir).drop("event_date")), folder)
        return layers.to_bronze(read_csv(spark, folder), FEEDS[name]).drop("_ingested_at")
    return build


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: silver(spark, sf_dir, name)


def _gold(table: str) -> Query:
    return lambda spark, sf_dir: report(spark, sf_dir, table)


for _short, _feed in (("rides", "ride_events"), ("locations", "driver_location_events"),
                      ("payments", "payment_events"), ("cancellations", "cancellation_events")):
    register(f"bronze_{_short}", _bronze(_feed))
    register(f"silver_{_short}", _silver(_feed))

for _short, _table in (("daily_ride_metrics", "daily_ride_metrics"), ("driver_utilization", "driver_utilization"),
                       ("city_demand", "city_demand_heatmap"), ("payment_summary", "payment_summary"),
                       ("cancellation_analysis", "cancellation_analysis")):
    register(f"gold_{_short}", _gold(_table))


@query
def bronze_roundtrip(spark, sf_dir):
    folder = working_folder(spark, "bronze")
    write_table(feeds.ride_events(spark, sf_dir), folder, "event_date")
    return scan(spark, folder)


def _stored_places(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """A report as stored, with each row's place among those of its date."""
    folder = working_folder(spark, "gold")
    write_table(gold.in_stored_order(df, table), folder)
    stored = spark.read.parquet(folder)
    place = Window.partitionBy("event_date").orderBy("_metadata.file_name", "_metadata.row_index")
    return stored.withColumn("place", F.row_number().over(place))


@query
def gold_roundtrip(spark, sf_dir):
    return _stored_places(spark, report(spark, sf_dir, "daily_ride_metrics"), "daily_ride_metrics")


@query
def layer_counts(spark, sf_dir):
    """All three layers from feed files to report tables, with the rows each write counted."""
    folder = working_folder(spark, "layers")
    for name in FEEDS:
        write_csv(to_text(feeds.READERS[name](spark, sf_dir).drop("event_date")), f"{folder}/input/{name}.csv")
    return wh.run_layers(spark, f"{folder}/input", f"{folder}/warehouse")


@query
def ride_reports(spark, sf_dir):
    """The groups of the three ride reports, out of one pass over the cleaned rides."""
    return gold.ride_reports(rides_of(spark, sf_dir))


@query
def dedup_latest(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return keep_latest(events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts")


@query
def dedup_first(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return keep_first(events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts")


@query
def sort_mixed(spark, sf_dir):
    return _stored_places(spark, report(spark, sf_dir, "cancellation_analysis"), "cancellation_analysis")


@query
def union_events(spark, sf_dir):
    """All four feeds as one list of events."""
    return union_all(
        feeds.READERS[name](spark, sf_dir).select(F.lit(name).alias("feed"), F.col(feed.key).alias("id"),
                                                  "event_timestamp")
        for name, feed in FEEDS.items())


# -- files -------------------------------------------------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    folder = working_folder(spark, "csv")
    write_csv(to_text(feeds.payment_events(spark, sf_dir).drop("event_date")), folder)
    return read_csv(spark, folder)


@query
def json_scan(spark, sf_dir):
    folder = working_folder(spark, "json")
    write_json(to_text(feeds.cancellation_events(spark, sf_dir).drop("event_date")), folder)
    return read_json(spark, folder, FEEDS["cancellation_events"].text_schema())


@query
def json_array(spark, sf_dir):
    """Records in files that are one array each."""
    folder = working_folder(spark, "json-arrays")
    write_json_arrays(to_text(feeds.cancellation_events(spark, sf_dir).drop("event_date")), folder, 500)
    return read_json(spark, folder, FEEDS["cancellation_events"].text_schema(), array_files=True)


@query
def scan_or_empty_(spark, sf_dir):
    """Rows of a stored and of a missing table."""
    folder = working_folder(spark, "scan")
    schema = feeds.payment_events(spark, sf_dir).schema
    write_table(feeds.payment_events(spark, sf_dir), f"{folder}/payment_events")
    return table_counts({name: scan_or_empty(spark, f"{folder}/{name}", schema)
                         for name in ("payment_events", "missing_events")})


@query
def validate_inputs_(spark, sf_dir):
    folder = working_folder(spark, "inputs")
    for name in FEEDS:
        write_csv(to_text(feeds.READERS[name](spark, sf_dir).drop("event_date")), f"{folder}/{name}.csv")
    names = validate_inputs(spark, folder)
    return check_tables({name: read_csv(spark, f"{folder}/{name}.csv") for name in names})


@query
def validate_outputs_(spark, sf_dir):
    """The stored report tables are there and hold rows."""
    folder = working_folder(spark, "outputs")
    for name in gold.GOLD:
        write_table(report(spark, sf_dir, name), f"{folder}/gold/{name}")
    return check_tables({name: scan(spark, f"{folder}/gold/{name}") for name in validate_outputs(spark, folder)})


# -- topics ------------------------------------------------------------------------------------------

@query
def topic_records(spark, sf_dir):
    return records_of(spark, sf_dir, RIDES.name)


@query
def parse_topic(spark, sf_dir):
    """Rides as they come off their topic: encoded as records, then decoded."""
    return topics.decode(records_of(spark, sf_dir, RIDES.name), RIDES).drop("event_timestamp")


def _stored_topics(spark: SparkSession, sf_dir: str, timed: bool = False) -> DataFrame:
    """All topics as stored, by one write that neither sorts nor shuffles."""
    folder = working_folder(spark, "topics")
    topics.write_topics(union_all(topics.topic_records(feeds.READERS[name](spark, sf_dir), feed, timed=timed)
                                  for name, feed in FEEDS.items()), folder)
    return topics.read_topic_files_batch(spark, folder)


@query
def topic_tail(spark, sf_dir):
    """The earliest records of each stored topic, chosen by the time they were sent at before any is decoded."""
    stored = _stored_topics(spark, sf_dir, timed=True)
    order = [F.col("sent_at").asc_nulls_last(), F.col("key"), F.col("value")]
    first = topics.tail([stored.filter(F.col("topic") == name) for name in FEEDS], 3, order)
    return first.select("topic", "key", F.get_json_object("value", "$.event_timestamp").alias("event_timestamp"))


@query
def topic_counts(spark, sf_dir):
    """Records of each topic as they are sent; `topic_places` counts stored ones."""
    return topics.topic_counts(union_all(records_of(spark, sf_dir, name) for name in FEEDS))


@query
def topic_places(spark, sf_dir):
    """Records of each stored topic, and whether the places that their writers gave them are without gaps and repeats."""
    return topics.topic_places(_stored_topics(spark, sf_dir))


@query
def topic_limit(spark, sf_dir):
    return topics.first_records(records_of(spark, sf_dir, PAYMENTS.name), 500, [F.col("key"), F.col("value")])


# -- expressions and derived feeds -------------------------------------------------------------------

@query
def fare_quote_(spark, sf_dir):
    rides = feeds.ride_events(spark, sf_dir)
    return rides.select("ride_id", "event_timestamp",
                        fare_quote(F.col("distance_miles"), F.col("surge_multiplier")).alias("quote"))


@query
def surge_lookup(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    jitter = (F.col("event_id") % 31 - 10).cast("double") / 100
    return events.select("event_id", surge_at(F.col("ts"), jitter).alias("surge"))


@query
def derive_payments_(spark, sf_dir):
    number = F.regexp_extract("ride_id", "([0-9]+)", 1).cast("long")
    return derive_payments(rides_of(spark, sf_dir), status=F.lit("success"), seconds=number % 56 + 5)


@query
def derive_cancellations_(spark, sf_dir):
    number = F.regexp_extract("ride_id", "([0-9]+)", 1).cast("long")
    return derive_cancellations(rides_of(spark, sf_dir), cancelled_by=F.lit("rider"),
                                reason=F.lit("rider_cancelled"), seconds=number % 271 + 30)


# -- updates, deletes, versions ----------------------------------------------------------------------

@query
def merge_payload(spark, sf_dir):
    return open_ride_updates(rides_of(spark, sf_dir), 500, closed_at()).select(
        "ride_id", "city", "ride_status", "fare_amount", "dropoff_time")


@query
def merge_update_(spark, sf_dir):
    rides = rides_of(spark, sf_dir).select("ride_id", "city", "ride_status", "fare_amount", "dropoff_time",
                                           "distance_miles")
    return merge_update(rides, open_ride_updates(rides, 500, closed_at()), ["ride_id", "city"],
                        ["ride_status", "fare_amount", "dropoff_time"], source_rows=500)


@query
def delete_where_(spark, sf_dir):
    pings = silver(spark, sf_dir, LOCATIONS.name)
    return delete_where(pings, F.col("driver_id") == first_driver(pings)).select("event_id", "driver_id", "city")


@query
def delete_audit_(spark, sf_dir):
    pings = silver(spark, sf_dir, LOCATIONS.name)
    condition = F.col("driver_id") == first_driver(pings)
    return delete_audit(pings, delete_where(pings, condition), condition)


def _rides_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The keyed rides table with two versions: as loaded, and with open rides closed."""
    table = wh.load_keyed_tables(spark, {RIDES.name: rides_of(spark, sf_dir)},
                                 working_folder(spark, "keyed"))[RIDES.name]
    wh.close_open_rides(table, 500, closed_at())
    return table


@query
def table_delete(spark, sf_dir):
    """The stored pings after those of the first driver have been deleted."""
    table, _ = _erased_pings(spark, sf_dir)
    return table.read().select("event_id", "driver_id", "city")


@query
def table_delete_audit(spark, sf_dir):
    """Pings of the first driver in the versions before and after their deletion."""
    return _erased_pings(spark, sf_dir)[1]


@query
def table_delete_history(spark, sf_dir):
    table, _ = _erased_pings(spark, sf_dir)
    return table.history().select("version", "operation", "n_rows_written",
                                  F.col("operationParameters")["predicate"].alias("predicate"))


def _erased_pings(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, DataFrame]:
    pings = silver(spark, sf_dir, LOCATIONS.name)
    table = wh.load_keyed_tables(spark, {LOCATIONS.name: pings}, working_folder(spark, "keyed"))[LOCATIONS.name]
    return table, wh.erase_driver(table)


def _changed_rides(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """Rides as loaded, with open ones closed, and without the cancelled ones of one city."""
    table = _rides_table(spark, sf_dir)
    table.delete((F.col("ride_status") == "cancelled") & (F.col("city") == "Miami"), "cancelled rides of Miami")
    return table


@query
def change_feed_deletes(spark, sf_dir):
    """Updates and deletes since the load, from the stored changes alone."""
    return _changed_rides(spark, sf_dir).changes(0, 2, columns=["ride_status", "fare_amount"])


@query
def change_feed_versions(spark, sf_dir):
    """Inserts, updates and deletes over versions of which the last one loads the table anew."""
    table = _changed_rides(spark, sf_dir)
    more = table.read(0).filter("ride_status = 'completed' AND city = 'Boston'").withColumn(
        "ride_id", F.concat(F.lit("new_"), "ride_id"))
    table.overwrite(table.read().unionByName(more))
    return table.changes(0, 3, columns=["ride_status", "fare_amount"])


@query
def table_current(spark, sf_dir):
    return _rides_table(spark, sf_dir).read().select("ride_id", "city", "ride_status", "fare_amount",
                                                     "dropoff_time")


@query
def time_travel(spark, sf_dir):
    return wh.open_rides_since(_rides_table(spark, sf_dir), 0)


@query
def time_travel_ts(spark, sf_dir):
    table = _rides_table(spark, sf_dir)
    loaded_at = table.history().filter(F.col("version") == 0).first()["timestamp"]
    return table.read_as_of(loaded_at).select("ride_id", "city", "ride_status", "fare_amount")


@query
def table_history(spark, sf_dir):
    return _rides_table(spark, sf_dir).history(10).select("version", "operation", "n_rows_written")


@query
def change_feed_(spark, sf_dir):
    return _rides_table(spark, sf_dir).changes(0, columns=["ride_status", "fare_amount"])


@query
def change_feed_raw_(spark, sf_dir):
    """Inserts, updates and deletes between the raw first records and the cleaned latest ones."""
    columns = ["ride_id", "city", "ride_status", "fare_amount"]
    old = keep_first(feeds.ride_events(spark, sf_dir).filter(F.col("ride_status") != "in_progress"),
                     "ride_id", "event_timestamp").select(*columns)
    return change_feed(old, rides_of(spark, sf_dir).select(*columns), "ride_id", ["ride_status", "fare_amount"])


@query
def schema_enforce(spark, sf_dir):
    """A reload with the columns in another order is taken; one with a wrong type is refused."""
    payments = silver(spark, sf_dir, PAYMENTS.name)
    table = wh.load_keyed_tables(spark, {PAYMENTS.name: payments}, working_folder(spark, "schema"))[PAYMENTS.name]
    table.overwrite(payments.select(*reversed(payments.columns)))
    try:
        table.overwrite(payments.withColumn("amount", F.col("amount").cast("string")))
    except ValueError:
        return table.read()
    raise AssertionError("a text amount was taken")


@query
def table_counts_(spark, sf_dir):
    tables = wh.load_keyed_tables(spark, all_silver(spark, sf_dir), working_folder(spark, "keyed"))
    return table_counts({FEEDS[name].keyed_table: table.read() for name, table in tables.items()})


@query
def table_preview(spark, sf_dir):
    payments = {PAYMENTS.name: silver(spark, sf_dir, PAYMENTS.name)}
    table = wh.load_keyed_tables(spark, payments, working_folder(spark, "keyed"))[PAYMENTS.name]
    return marts.preview(table.read(), "payment_id")


# -- dashboard ---------------------------------------------------------------------------------------

@query
def kpi_summary(spark, sf_dir):
    tables = all_silver(spark, sf_dir)
    return marts.kpi_summary(tables["ride_events"], tables["payment_events"], tables["driver_location_events"],
                             tables["cancellation_events"])


def _mart(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(report(spark, sf_dir, table))


for _name, _table, _build in (
    ("city_revenue", "daily_ride_metrics", marts.city_revenue),
    ("rides_by_status", "daily_ride_metrics", marts.rides_by_status),
    ("avg_fare_by_city", "daily_ride_metrics", marts.avg_fare_by_city),
    ("surge_heatmap", "city_demand_heatmap", marts.surge_heatmap),
    ("surge_heatmap_pivot", "city_demand_heatmap", marts.surge_heatmap_pivot),
    ("peak_surge_hours", "city_demand_heatmap", marts.peak_surge_hours),
    ("payments_by_method", "payment_summary", lambda df: marts.transactions_by(df, "payment_method")),
    ("payments_by_status", "payment_summary", lambda df: marts.transactions_by(df, "payment_status")),
    ("top_drivers", "driver_utilization", marts.top_drivers),
):
    register(_name, _mart(_table, _build))


def _histogram(column: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = working_folder(spark, "utilization")
        write_table(report(spark, sf_dir, "driver_utilization").select(column), folder)
        return marts.histogram(scan(spark, folder), column)
    return build


register("trips_histogram", _histogram("completed_trips"))
register("earnings_histogram", _histogram("total_earnings"))


# -- SQL ---------------------------------------------------------------------------------------------

def _views(spark: SparkSession, sf_dir: str, sql: str) -> AbstractContextManager[None]:
    """The views that a query names."""
    tables = {feed.keyed_table: silver(spark, sf_dir, name) for name, feed in FEEDS.items()
              if feed.keyed_table in sql}
    tables |= {view: report(spark, sf_dir, name) for view, name in wh.GOLD_VIEWS.items() if view in sql}
    return wh.views(spark, tables)


def _question(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _views(spark, sf_dir, QUESTIONS[name]):
            return spark.sql(QUESTIONS[name])
    return build


for _name in QUESTIONS:
    register(f"sql_{_name}", _question(_name))


@query
def run_query(spark, sf_dir):
    """A query that gives more rows than are shown."""
    sql = "SELECT driver_id, count(*) AS n FROM rides GROUP BY driver_id ORDER BY n DESC, driver_id"
    with _views(spark, sf_dir, sql):
        return wh.run_query(spark, sql)


# -- windows over stored data ------------------------------------------------------------------------

def _windows(build: Callable[[DataFrame], DataFrame], feed: str) -> Query:
    return lambda spark, sf_dir: build(timed(spark, sf_dir, feed))


for _name, _build, _feed in (
    ("window_rides", windows.ride_windows, "ride_events"),
    ("window_availability", windows.availability_windows, "driver_location_events"),
    ("window_payments", windows.payment_windows, "payment_events"),
    ("window_cancellations", windows.cancellation_windows, "cancellation_events"),
    ("window_monitor", windows.ride_monitor, "ride_events"),
    ("payment_rate", windows.payment_rates, "payment_events"),
):
    register(_name, _windows(_build, _feed))


@query
def stream_city_totals(spark, sf_dir):
    """Rides by city out of the stored stream table."""
    return marts.stream_city_totals(_stream(runs.STREAM_TABLES["ride_windows"])(spark, sf_dir))


@query
def latest_windows(spark, sf_dir):
    """The 20 latest rows of each stored stream table, in one list."""
    folder = _all_streams(spark, sf_dir)
    measures = {"ride_windows": ("city", "ride_status", "ride_count"),
                "driver_availability": ("city", "availability_status", "driver_count"),
                "payment_rates": ("payment_method", "payment_status", "txn_count"),
                "cancellation_breakdown": ("cancelled_by", "reason", "cancellation_count")}
    return union_all(
        marts.latest_windows(spark.read.parquet(f"{folder}/streaming/{name}"), measures[name][:2])
        .select(F.lit(name).alias("stream_table"), "window_start", F.col(measures[name][0]).alias("first_key"),
                F.col(measures[name][1]).alias("second_key"), F.col(measures[name][2]).alias("n"))
        for name in runs.STREAM_TABLES)


# -- streams -----------------------------------------------------------------------------------------

def _slots(spark: SparkSession) -> int:
    """As many state partitions as the cluster has task slots."""
    return spark.sparkContext.defaultParallelism


def _run_step(spark: SparkSession, table: runs.StreamTable, folder: str, step: DataFrame | None, delay: str = DELAY,
              drop_repeats: bool = False, move_to: int | None = None) -> None:
    """Write a step's records to the topic, and run the stream over what it has not finished, with more state partitions
    if it is moved."""
    if step is not None:
        topics.write_topic_files(step, f"{folder}/topic")
    with runs.state_partitions(spark, move_to or _slots(spark)):
        started = runs.start_table(topics.read_topic_files(spark, f"{folder}/topic"), table, folder, delay, True,
                                   drop_repeats, move_to is not None)
    runs.run_once(started)


def _stream_in_steps(spark: SparkSession, table: runs.StreamTable, steps: list[DataFrame], delay: str = DELAY,
                     drop_repeats: bool = False) -> DataFrame:
    """Write each step's records to the topic, and run the stream over them before the next step comes."""
    folder = working_folder(spark, f"stream-{table.name}")
    for step in steps:
        _run_step(spark, table, folder, step, delay, drop_repeats)
    return spark.read.parquet(f"{folder}/streaming/{table.name}")


def _stream(table: runs.StreamTable) -> Query:
    return lambda spark, sf_dir: _stream_in_steps(spark, table, [records_of(spark, sf_dir, table.feed.name)])


for _name, _table in (("stream_rides", "ride_windows"), ("stream_availability", "driver_availability"),
                      ("stream_payments", "payment_rates"), ("stream_cancellations", "cancellation_breakdown")):
    register(_name, _stream(runs.STREAM_TABLES[_table]))
register("stream_payment_rate", _stream(runs.RATE_TABLE))


@query
def stream_ride_monitor(spark, sf_dir):
    folder = working_folder(spark, "stream-monitor")
    topics.write_topic_files(records_of(spark, sf_dir, RIDES.name), f"{folder}/topic")
    with runs.state_partitions(spark, _slots(spark)):
        monitor = runs.start_monitor(topics.read_topic_files(spark, f"{folder}/topic"), DELAY, True,
                                     f"{folder}/monitor", f"{folder}/checkpoint")
    runs.run_once(monitor)
    return runs.latest_monitor(spark, f"{folder}/monitor")


def _by_day(rides: DataFrame) -> list[DataFrame]:
    """Rides before day 10, from day 10 to 20, and later, counted from the first day."""
    first = F.date_trunc("day", rides.select(F.min("event_timestamp")).scalar())
    day10, day20 = shift_seconds(first, F.lit(10 * 86_400)), shift_seconds(first, F.lit(20 * 86_400))
    time = F.col("event_timestamp")
    return [rides.filter(time < day10), rides.filter((time >= day10) & (time < day20)), rides.filter(time >= day20)]


@query
def stream_restart(spark, sf_dir):
    """A stream stopped and started twice on one checkpoint; each ride is counted once."""
    steps = _by_day(feeds.ride_events(spark, sf_dir))
    return _stream_in_steps(spark, runs.STREAM_TABLES["ride_windows"], [topics.topic_records(step, RIDES) for step in steps])


@query
def stream_late(spark, sf_dir):
    """As stream_restart, but the last step delivers the closed windows of the first once more, too late."""
    first, second, third = _by_day(feeds.ride_events(spark, sf_dir))
    watermark = shift_seconds(first.select(F.max("event_timestamp")).scalar(), F.lit(-600))
    late = (first.withColumn("closes", F.window("event_timestamp", "5 minutes")["end"])
            .filter(F.col("closes") <= watermark).drop("closes"))
    return _stream_in_steps(spark, runs.STREAM_TABLES["ride_windows"], [
        topics.topic_records(step, RIDES) for step in (first, second, third.unionByName(late))])


@query
def stream_crash_restart(spark, sf_dir):
    """A stream that twice dies within a batch and starts again: after its files were listed, and after they were
    written only. Files of a lost batch are written once more, and each ride still counts once."""
    table = runs.STREAM_TABLES["ride_windows"]
    folder = working_folder(spark, "stream-crash")
    first, second, third = (topics.topic_records(step, RIDES) for step in _by_day(feeds.ride_events(spark, sf_dir)))
    paths = f"{folder}/streaming/{table.name}", f"{folder}/checkpoints/{table.name}"
    _run_step(spark, table, folder, first)
    _run_step(spark, table, folder, second)
    faults.unfinish(spark, *paths, faults.LOGGED)
    _run_step(spark, table, folder, third)
    faults.unfinish(spark, *paths, faults.WRITTEN)
    _run_step(spark, table, folder, None)
    return spark.read.parquet(paths[0])


@query
def stream_more_partitions(spark, sf_dir):
    """A stream that goes on with twice as many state partitions after its second step; each ride is counted once."""
    table = runs.STREAM_TABLES["ride_windows"]
    folder = working_folder(spark, "stream-moved")
    first, second, third = (topics.topic_records(step, RIDES) for step in _by_day(feeds.ride_events(spark, sf_dir)))
    _run_step(spark, table, folder, first)
    _run_step(spark, table, folder, second)
    _run_step(spark, table, folder, third, move_to=2 * _slots(spark))
    return runs.read_table(spark, folder, table)


LONG_DELAY = "2 days"


@query
def stream_redelivered(spark, sf_dir):
    """Rides of which each step brings the last two days of the step before once more, and the last step all that were ever
    sent. What is still remembered is dropped as a repeat, what is not is too late."""
    first, second, third = _by_day(feeds.ride_events(spark, sf_dir))

    def again(step: DataFrame) -> DataFrame:
        since = shift_seconds(step.select(F.max("event_timestamp")).scalar(), F.lit(-2 * 86_400))
        return step.filter(F.col("event_timestamp") > since)

    steps = [first, union_all([second, again(first)]), union_all([third, first, second])]
    return _stream_in_steps(spark, runs.STREAM_TABLES["ride_windows"],
                            [topics.topic_records(step, RIDES) for step in steps], LONG_DELAY, drop_repeats=True)


def _all_streams(spark: SparkSession, sf_dir: str) -> str:
    """Run all four topics side by side, and return the folder of their tables."""
    folder = working_folder(spark, "stream-all")
    for name in FEEDS:
        topics.write_topic_files(records_of(spark, sf_dir, name), f"{folder}/topics/{name}")
    with runs.state_partitions(spark, _slots(spark)):
        runs.run_topics(spark, lambda topic: topics.read_topic_files(spark, f"{folder}/topics/{topic}"), folder,
                        delay=DELAY, monitor=False, once=True)
    return folder


@query
def stream_all(spark, sf_dir):
    """All four topics run side by side; rows per stream table."""
    folder = _all_streams(spark, sf_dir)
    return table_counts({name: spark.read.parquet(f"{folder}/streaming/{name}") for name in runs.STREAM_TABLES})
