"""Edge rows of ingest, cleaning and reports."""

import datetime
import math
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import rows
from kerbside.functions.convert import to_text
from kerbside.functions.measures import exact_mean, exact_sum
from kerbside.operators import gold, layers
from kerbside.schemas import LOCATIONS, PAYMENTS
from kerbside.sources import files
from kerbside.sources.files import path_exists, read_csv, read_json, scan, scan_or_empty, write_csv, write_table


def csv(spark, folder, *lines):
    header = ",".join(PAYMENTS.columns)
    spark.createDataFrame([(line,) for line in (header, *lines)], "value string").coalesce(1).write.text(folder)
    return read_csv(spark, folder)


def test_blank_cells_are_null_and_both_time_forms_parse(spark, folder):
    raw = csv(spark, folder, 'p1,r1,success,,USD,"",2024-01-01T10:00:00', "p2,r2,success,5.5,USD,card,2024-01-01T10:00:00.25")
    first, second = layers.bronze_payments(raw).orderBy("payment_id").collect()
    assert first["amount"] is None and first["payment_method"] is None
    assert first["event_timestamp"] == datetime.datetime(2024, 1, 1, 10)
    assert second["amount"] == 5.5 and second["event_timestamp"].microsecond == 250_000
    assert str(second["event_date"]) == "2024-01-01" and second["_ingested_at"] is not None


@pytest.mark.parametrize("line", ["p1,r1,success,abc,USD,card,2024-01-01T10:00:00", "p1,r1,success,1,USD,card,abc"])
def test_malformed_cells_fail_or_become_null(spark, folder, line):
    raw = csv(spark, folder, line)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        layers.bronze_payments(raw).collect()
    row = layers.bronze_payments(raw, on_error="null").first()
    assert row["amount"] is None or row["event_timestamp"] is None


def test_unknown_error_mode(spark):
    with pytest.raises(ValueError):
        layers.bronze_payments(spark.createDataFrame([], PAYMENTS.text_schema()), on_error="skip")


def test_columns_follow_the_header_not_their_position(spark, folder):
    names = list(reversed(PAYMENTS.columns))
    values = {"payment_id": "p1", "amount": "7.25", "event_timestamp": "2024-01-01T00:00:00"}
    df = spark.createDataFrame([tuple(values.get(c, "x") for c in names)], ", ".join(f"{c} string" for c in names))
    write_csv(df, folder)
    row = layers.bronze_payments(read_csv(spark, folder)).first()
    assert row["payment_id"] == "p1" and row["amount"] == 7.25


def test_feeds_and_tables_are_stored_small(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "CSV_ROWS", 100)
    df = rows.pings(spark, *[{"event_id": f"e{i}", "city": None if i % 3 else 'a "b", c'} for i in range(450)]).coalesce(1)
    sent = to_text(df.drop("event_date"))
    write_csv(sent, f"{folder}/csv")
    back = read_csv(spark, f"{folder}/csv")
    names = [os.path.basename(name) for name in back.inputFiles()]
    assert len(names) == 5 and all(name.endswith(".csv.gz") for name in names)  # many tasks can read a feed
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, sent.collect()), key=str)
    for partition_by in (None, "event_date"):
        path = f"{folder}/table-{partition_by}"
        assert write_table(df, path, partition_by) == 450
        assert all(name.endswith(".zstd.parquet") for name in spark.read.parquet(path).inputFiles())


def test_null_event_time_goes_to_the_default_partition(spark, folder):
    df = rows.pings(spark, {}, {"event_id": "e2", "event_timestamp": None})
    assert write_table(df, folder, "event_date") == 2
    assert path_exists(spark, f"{folder}/event_date=__HIVE_DEFAULT_PARTITION__")
    assert scan(spark, folder).filter(F.col("event_date").isNull()).first()["event_id"] == "e2"


def test_ride_rules(spark):
    df = rows.rides(
        spark,
        {"ride_id": "ok"}, {"ride_id": None}, {"ride_id": "no_rider", "rider_id": None},
        {"ride_id": "no_driver", "driver_id": None}, {"ride_id": "no_status", "ride_status": None},
        {"ride_id": "bad_status", "ride_status": "unknown"},
        {"ride_id": "fare_null", "fare_amount": None}, {"ride_id": "fare_zero", "fare_amount": 0.0},
        {"ride_id": "fare_negative", "fare_amount": -1.0},
        {"ride_id": "cancelled", "ride_status": "cancelled", "fare_amount": None},
        {"ride_id": "open_negative", "ride_status": "in_progress", "fare_amount": -1.0},
        {"ride_id": "far_null", "distance_miles": None}, {"ride_id": "far_zero", "distance_miles": 0.0},
        {"ride_id": "far_short", "distance_miles": 0.1})
    kept = {r["ride_id"] for r in layers.silver_rides(df).collect()}
    assert kept == {"ok", "cancelled", "open_negative", "far_null", "far_short"}


def test_ride_columns(spark):
    df = rows.rides(spark, {"ride_id": "a", "surge_multiplier": 1.0}, {"ride_id": "b", "surge_multiplier": None},
                    {"ride_id": "c"}, {"ride_id": "d", "request_time": None})
    found = {r["ride_id"]: r for r in layers.silver_rides(df).collect()}
    assert [found[k]["is_surge"] for k in "abc"] == [False, None, True]
    assert found["c"]["trip_hour"] == 10
    assert found["c"]["trip_day_of_week"] == 1          # 2024-01-07 is a Sunday
    assert found["d"]["trip_hour"] is None


def test_newer_invalid_row_does_not_hide_an_older_valid_one(spark):
    df = rows.rides(spark, {"fare_amount": 5.0},
                    {"fare_amount": -5.0, "event_timestamp": "2024-01-08 00:00:00"},
                    {"fare_amount": 7.0, "event_timestamp": None})
    assert [r["fare_amount"] for r in layers.silver_rides(df).collect()] == [5.0]


def test_ping_rules_and_null_ids(spark):
    df = rows.pings(
        spark, {"event_id": "edge", "lat": 90.0, "lng": -180.0}, {"event_id": "out", "lat": 90.1},
        {"event_id": "lat_null", "lat": None}, {"event_id": "bad", "availability_status": "asleep"},
        {"event_id": "no_driver", "driver_id": None}, {"event_id": "no_time", "event_timestamp": None},
        {"event_id": None, "driver_id": "d8"}, {"event_id": None, "driver_id": "d9"})
    kept = layers.silver_locations(df).collect()
    assert sorted((r["event_id"] or "null", r["driver_id"]) for r in kept) == [("edge", "d1"), ("null", "d8")]


def test_equal_times_give_the_same_row_in_any_layout(spark):
    changes = [{"event_id": "same", "lat": float(i), "driver_id": f"d{i % 7}"} for i in range(50)]
    df = rows.pings(spark, *changes)
    first = layers.silver_locations(df).collect()
    for n in (1, 5, 13):
        assert layers.silver_locations(df.orderBy(F.rand(n)).repartition(n)).collect() == first


def test_group_with_only_null_fares(spark):
    cancelled = {"ride_status": "cancelled", "fare_amount": None}
    row = gold.daily_ride_metrics(layers.silver_rides(rows.rides(spark, cancelled))).first()
    assert row["total_rides"] == 1 and row["total_revenue"] is None and row["avg_fare"] is None


def test_exact_sum_is_the_decimal_sum_in_any_layout(spark):
    random.seed(3)
    values = [round(random.uniform(-500, 500), 2) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    true = float(sum(Decimal(str(v)) for v in values))
    for n in (1, 3, 8):
        total, mean = df.repartition(n).agg(exact_sum("x"), exact_mean("x")).first()
        assert total == true and mean == true / len(values)


@pytest.mark.parametrize("values,expected", [
    ([None, None], None), ([], None), ([1e300, 1.0], 1e300), ([3e14, 0.5], 3e14 + 0.5),
    ([0.123456789, 0.1], 0.223456789), ([float("inf"), 1.0], float("inf")), ([-0.01, 0.01], 0.0)])
def test_exact_sum_of_unusual_values(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    total = df.agg(exact_sum("x")).first()[0]
    assert total == expected if expected is None else total == pytest.approx(expected, rel=1e-15, abs=1e-15)


def test_exact_sum_passes_nan_on(spark):
    assert math.isnan(spark.createDataFrame([(float("nan"),), (1.0,)], "x double").agg(exact_sum("x")).first()[0])


def test_json_array_files(spark, folder):
    text = '[\n  {"event_id": "a", "driver_id": "d", "lat": "1.5"},\n  {"event_id": "b", "driver_id": null}\n]'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    found = read_json(spark, folder, LOCATIONS.text_schema(), array_files=True).orderBy("event_id").collect()
    assert [(r["event_id"], r["driver_id"], r["lat"]) for r in found] == [("a", "d", "1.5"), ("b", None, None)]


def test_missing_table_is_empty(spark, folder):
    assert scan_or_empty(spark, folder, LOCATIONS.text_schema()).columns == list(LOCATIONS.columns)
    assert scan_or_empty(spark, folder, LOCATIONS.text_schema()).count() == 0


def test_writing_an_empty_table_counts_zero(spark, folder):
    assert write_table(rows.pings(spark, {}).filter("false"), folder, "event_date") == 0
