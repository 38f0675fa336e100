"""Physical plans: what must be there at scale, and what must not."""

import pytest
from pyspark.sql import functions as F

import rows
from kerbside.operators import gold, layers, marts
from kerbside.operators.dedup import keep_latest
from kerbside.plans.catalogue import QUERIES
from kerbside.schemas import FEEDS
from kerbside.session import MB, sized, stored_bytes
from kerbside.sources import feeds
from kerbside.sources.files import scan, write_table

# These write tables or run streams when they are called.
STORING = [n for n in QUERIES if n.startswith(("stream_", "table_", "time_travel", "validate_", "topic_"))] + [
    "layer_counts", "change_feed", "change_feed_deletes", "change_feed_versions", "schema_enforce", "scan_or_empty",
    "bronze_roundtrip", "gold_roundtrip", "sort_mixed", "trips_histogram", "earnings_histogram", "latest_windows",
    "json_array"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STORING])
def test_no_cross_joins_no_python_no_single_task_windows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text, bad
    assert "windowspecdefinition(row_number" not in text


def test_dedup_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(keep_latest(feeds.driver_location_events(spark, sf_dir), "event_id", "event_timestamp"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    from kerbside.session import working_folder
    folder = working_folder(spark, "plans")
    write_table(layers.silver_rides(feeds.ride_events(spark, sf_dir)), f"{folder}/rides", "event_date")
    return folder


def test_reports_read_only_their_columns_and_push_filters(spark, stored):
    text = plan(gold.driver_utilization(scan(spark, f"{stored}/rides")))
    assert "PushedFilters: [IsNotNull(ride_status), EqualTo(ride_status,completed)]" in text
    assert "pickup_lat" not in text and "rider_id" not in text
    assert text.count("Exchange") == 1


def test_reports_combine_before_the_shuffle(spark, stored):
    text = plan(gold.daily_ride_metrics(scan(spark, f"{stored}/rides")))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and text.count("Exchange") == 1


def test_ride_reports_read_the_rides_once(spark, stored):
    text = plan(gold.ride_reports(scan(spark, f"{stored}/rides")))
    assert text.count("Scan parquet") == 1 and text.count("Exchange") == 1 and "pickup_lat" not in text


@pytest.mark.parametrize("table", ["daily_ride_metrics", "driver_utilization", "city_demand_heatmap"])
def test_ride_reports_are_those_of_their_own_queries(spark, stored, table):
    """To the last bit, groups with null keys and drivers without a completed ride among them."""
    rides = scan(spark, f"{stored}/rides").withColumn("city", F.when(F.col("city") != "Miami", F.col("city")))
    rides = rides.unionByName(rides.limit(3).withColumns({"ride_status": F.lit("cancelled"), "driver_id": F.lit("idle")}))
    both = gold.ride_report(gold.ride_reports(rides), table), gold.GOLD[table][1](rides)
    found, expected = ([tuple(r) for r in df.collect()] for df in both)
    assert both[0].dtypes == both[1].dtypes and both[0].columns == both[1].columns
    assert sorted(found, key=str) == sorted(expected, key=str) and len(found) > 5


def test_a_date_range_reads_only_its_folders(spark, stored):
    days = scan(spark, f"{stored}/rides", F.col("event_date") == "2024-01-05")
    assert "PartitionFilters: [isnotnull(event_date" in plan(days)
    read = days.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("event_date=")[1][:10] for r in read} == {"2024-01-05"}


def test_top_k_keeps_k_rows_per_task(spark, stored):
    text = plan(marts.top_drivers(gold.driver_utilization(scan(spark, f"{stored}/rides"))))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_histogram_bins_before_its_one_shuffle(spark, stored):
    df = marts.histogram(scan(spark, f"{stored}/rides"), "fare_amount")
    df.collect()
    outer = plan(df).split("Subqueries")[0]
    assert outer.count("Exchange hashpartitioning") == outer.count("partial_count(1)") > 0
    assert "hashpartitioning(value" not in plan(df)
    assert "ReadSchema: struct<fare_amount:double>" in plan(df)


def test_cleaning_carries_only_the_columns_asked_for(spark, sf_dir):
    rides = layers.silver_rides(feeds.ride_events(spark, sf_dir)).select("fare_amount")
    shuffled = [line for line in plan(rides).splitlines() if "pickup_lat" in line or "payment_type" in line]
    assert not shuffled


def test_a_hot_partition_value_is_cut_into_several_files(spark, folder):
    """One city holds nearly all rows; with small files advised, it does not end in one task."""
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "64KB")
    try:
        hot = spark.range(200_000, numPartitions=8).select(
            F.xxhash64("id").alias("x"), F.when(F.col("id") % 50 == 0, "Boston").otherwise("Miami").alias("city"))
        assert write_table(hot, folder, "city") == 200_000
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    files = spark.read.parquet(folder).filter("city = 'Miami'").inputFiles()
    assert len(files) > 4


def test_hot_keys_give_whole_results(spark):
    """A third of the pings share one id, and a third have none."""
    pings = spark.range(90_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("event_id"),
        F.concat(F.lit("d"), F.col("id") % 100).alias("driver_id"), F.lit("Miami").alias("city"),
        F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"), F.lit("available").alias("availability_status"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("event_timestamp"))
    kept = layers.silver_locations(pings)
    assert kept.count() == 30_002
    latest = kept.filter("event_id = 'hot' OR event_id IS NULL").orderBy("event_id").collect()
    assert [r["event_timestamp"].timestamp() for r in latest] == [1_700_089_999, 1_700_089_997]


def test_tasks_are_sized_by_the_input(spark, sf_dir):
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(n, None) for n in names]

    def sizes(stored):
        with sized(spark, stored):
            partitions, *sizes = [int(spark.conf.get(n)) for n in names]
            return (partitions, *[size // MB for size in sizes])
    assert sizes(100_000_000 * MB) == (40_000, 500, 1000)
    assert sizes(1_000_000 * MB) == (7_813, 128, 64)
    assert sizes(stored_bytes(spark, sf_dir)) == (8, 128, 64)
    assert [spark.conf.get(n, None) for n in names] == before
    assert stored_bytes(spark, f"{sf_dir}/none") == 0 < stored_bytes(spark, f"{sf_dir}/events.parquet")


def test_feeds_have_their_contract_columns(spark, sf_dir):
    for name, feed in FEEDS.items():
        df = feeds.READERS[name](spark, sf_dir)
        assert df.columns == [*feed.columns, "event_date"]
    assert rows.rides(spark, {}).count() == 1
