"""Typed ingest (bronze) and cleaning (silver) of the four feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.convert import from_text
from kerbside.operators.dedup import keep_latest
from kerbside.schemas import (AVAILABILITY, CANCELLATIONS, CANCELLED_BY, LOCATIONS, PAYMENT_STATUSES, PAYMENTS,
                              RIDE_STATUSES, RIDES, Feed)


def to_bronze(raw: DataFrame, feed: Feed, on_error: str = "raise") -> DataFrame:
    """Text columns to the feed's types, plus the event date and the ingest time."""
    typed = raw.withColumns({
        c: from_text(c, kind, on_error) for c, kind in feed.columns.items() if kind != "string"})
    return typed.withColumns({
        "event_date": F.to_date("event_timestamp"),
        "_ingested_at": F.current_timestamp(),
    })


def bronze_rides(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    return to_bronze(raw, RIDES, on_error)


def bronze_locations(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    return to_bronze(raw, LOCATIONS, on_error)


def bronze_payments(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    return to_bronze(raw, PAYMENTS, on_error)


def bronze_cancellations(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    return to_bronze(raw, CANCELLATIONS, on_error)


def _present(*names: str) -> Column:
    condition = F.col(names[0]).isNotNull()
    for name in names[1:]:
        condition = condition & F.col(name).isNotNull()
    return condition


# Records of one key and time are told apart by these columns alone, so that a query which needs few columns
# sorts and shuffles few.
TIES = {
    RIDES.name: ["rider_id", "driver_id", "fare_amount"],
    LOCATIONS.name: ["driver_id", "city", "lat", "lng", "availability_status"],
    PAYMENTS.name: ["ride_id", "payment_status", "amount"],
    CANCELLATIONS.name: ["ride_id", "reason"],
}


# In every cleaner the filters run before the choice of the latest record: a newer row that breaks a
# rule must not hide an older one that keeps it.

def silver_rides(bronze: DataFrame) -> DataFrame:
    """Valid rides, the latest record of each, with hour, weekday (1 = Sunday) and surge flag."""
    valid = bronze.filter(
        _present("ride_id", "rider_id", "driver_id", "ride_status")
        & F.col("ride_status").isin(RIDE_STATUSES)
        & ((F.col("ride_status") != "completed") | (F.col("fare_amount") > 0))
        & (F.col("distance_miles").isNull() | (F.col("distance_miles") > 0)))
    return keep_latest(valid, RIDES.key, "event_timestamp", TIES[RIDES.name]).withColumns({
        "trip_hour": F.hour("request_time"),
        "trip_day_of_week": F.dayofweek("request_time"),
        "is_surge": F.col("surge_multiplier") > 1.0,
    })


def silver_locations(bronze: DataFrame) -> DataFrame:
    """Valid pings, the latest per id. The id may be NULL; all such pings count as one key."""
    valid = bronze.filter(
        _present("driver_id", "event_timestamp")
        & F.col("lat").between(-90, 90)
        & F.col("lng").between(-180, 180)
        & F.col("availability_status").isin(AVAILABILITY))
    return keep_latest(valid, LOCATIONS.key, "event_timestamp", TIES[LOCATIONS.name])


def silver_payments(bronze: DataFrame) -> DataFrame:
    valid = bronze.filter(
        _present("payment_id", "ride_id")
        & (F.col("amount") > 0)
        & F.col("payment_status").isin(PAYMENT_STATUSES))
    return keep_latest(valid, PAYMENTS.key, "event_timestamp", TIES[PAYMENTS.name])


def silver_cancellations(bronze: DataFrame) -> DataFrame:
    valid = bronze.filter(
        _present("cancellation_id", "ride_id")
        & F.col("cancelled_by").isin(CANCELLED_BY))
    return keep_latest(valid, CANCELLATIONS.key, "event_timestamp", TIES[CANCELLATIONS.name])


SILVER = {
    RIDES.name: silver_rides,
    LOCATIONS.name: silver_locations,
    PAYMENTS.name: silver_payments,
    CANCELLATIONS.name: silver_cancellations,
}
