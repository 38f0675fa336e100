"""Building the stored layers and the keyed tables, and registering them as views."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.changes import compare_open_rides, delete_audit, open_ride_updates
from kerbside.operators.gold import GOLD, in_stored_order, ride_report, ride_reports
from kerbside.operators.layers import SILVER, to_bronze
from kerbside.schemas import FEEDS, RIDES
from kerbside.session import sized_for, working_folder
from kerbside.sources.files import path_exists, read_csv, scan, write_table
from kerbside.sources.keyed import KeyedTable

LAYERS = ("bronze", "silver", "gold")
COUNTS_SCHEMA = "layer string, table string, n_rows long"
Counts = list[tuple[str, str, int]]


def run_bronze(spark: SparkSession, input_dir: str, warehouse: str, on_error: str = "raise") -> Counts:
    """Feed files to typed tables, partitioned by event date."""
    with sized_for(spark, input_dir):
        return [("bronze", name, write_table(to_bronze(read_csv(spark, f"{input_dir}/{name}.csv"), feed, on_error),
                                             f"{warehouse}/bronze/{name}", "event_date"))
                for name, feed in FEEDS.items()]


def run_silver(spark: SparkSession, warehouse: str) -> Counts:
    """Typed tables to cleaned tables, partitioned by event date."""
    with sized_for(spark, f"{warehouse}/bronze"):
        return [("silver", name, write_table(clean(scan(spark, f"{warehouse}/bronze/{name}")),
                                             f"{warehouse}/silver/{name}", "event_date"))
                for name, clean in SILVER.items()]


def run_gold(spark: SparkSession, warehouse: str) -> Counts:
    """Cleaned tables to report tables, each stored in its reading order.

    The groups of all ride reports come from one pass over the cleaned rides; they are stored as a step, as each report is
    sorted on its own.
    """
    with sized_for(spark, f"{warehouse}/silver"):
        step = working_folder(spark, "ride-reports")
        write_table(ride_reports(scan(spark, f"{warehouse}/silver/{RIDES.name}")), step)
        rides = scan(spark, step)
        return [("gold", name, write_table(
                    in_stored_order(ride_report(rides, name) if feed == RIDES.name
                                    else build(scan(spark, f"{warehouse}/silver/{feed}")), name),
                    f"{warehouse}/gold/{name}"))
                for name, (feed, build) in GOLD.items()]


def run_layers(spark: SparkSession, input_dir: str, warehouse: str, layer: str = "all",
               on_error: str = "raise") -> DataFrame:
    """Run one layer, or all in order, and return (layer, table, n_rows) as counted by the writes."""
    if layer not in (*LAYERS, "all"):
        raise ValueError(f"layer must be one of {LAYERS} or 'all', not {layer!r}")
    counts: Counts = []
    if layer in ("bronze", "all"):
        counts += run_bronze(spark, input_dir, warehouse, on_error)
    if layer in ("silver", "all"):
        counts += run_silver(spark, warehouse)
    if layer in ("gold", "all"):
        counts += run_gold(spark, warehouse)
    return spark.createDataFrame(counts, COUNTS_SCHEMA)


# -- keyed tables ------------------------------------------------------------------------------------

def keyed_table(spark: SparkSession, warehouse: str, feed_name: str) -> KeyedTable:
    feed = FEEDS[feed_name]
    return KeyedTable(spark, f"{warehouse}/keyed/{feed.keyed_table}", feed.key, feed.keyed_partition)


def load_keyed_tables(spark: SparkSession, silver: Mapping[str, DataFrame], warehouse: str) -> dict[str, KeyedTable]:
    """Load the cleaned feeds into their keyed tables."""
    tables = {name: keyed_table(spark, warehouse, name) for name in silver}
    for name, table in tables.items():
        table.overwrite(silver[name])
    return tables


def close_open_rides(rides: KeyedTable, n: int = 500, finished_at: Column | None = None) -> int | None:
    """Mark the first n open rides as completed, with fare and dropoff time."""
    updates = open_ride_updates(rides.read(), n, finished_at)
    return rides.merge(updates, ["ride_id", "city"], ["ride_status", "fare_amount", "dropoff_time"], source_rows=n)


def erase_driver(locations: KeyedTable, driver_id: str | None = None) -> DataFrame:
    """Delete all pings of one driver, by default the first, and report the counts in the versions before and after."""
    before = locations.read()
    if driver_id is None:
        driver_id = before.agg(F.min("driver_id")).first()[0]
    condition = F.col("driver_id") == F.lit(driver_id)
    locations.delete(condition, f"driver_id = '{driver_id}'")
    return delete_audit(before, locations.read(), condition)


def open_rides_since(rides: KeyedTable, version: int = 0) -> DataFrame:
    """Open rides at a version and now."""
    return compare_open_rides(rides.read(version), rides.read())


# -- views -------------------------------------------------------------------------------------------

# View -> report table behind it
GOLD_VIEWS = {
    "daily_ride_metrics": "daily_ride_metrics",
    "city_demand": "city_demand_heatmap",
    "payment_summary": "payment_summary",
    "driver_utilization": "driver_utilization",
    "cancellation_analysis": "cancellation_analysis",
}


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


@contextmanager
def views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """Tables as views for the duration of a block. What is analysed there stays valid; views of the same names that
    were there before are there again afterwards."""
    there = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in tables if name in there}
    register_views(tables)
    try:
        yield
    finally:
        for name in tables:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def register_warehouse(spark: SparkSession, warehouse: str) -> list[str]:
    """Register the keyed and report tables that exist as views, and return their names."""
    tables = {}
    for name, feed in FEEDS.items():
        table = keyed_table(spark, warehouse, name)
        if table.exists():
            tables[feed.keyed_table] = table.read()
    for view, name in GOLD_VIEWS.items():
        path = f"{warehouse}/gold/{name}"
        if path_exists(spark, path):
            tables[view] = spark.read.parquet(path)
    return register_views(tables)


def run_query(spark: SparkSession, sql: str, max_rows: int = 20) -> DataFrame:
    """The first rows of any SQL over the registered views, for showing to a person."""
    return spark.sql(sql).limit(max_rows)
