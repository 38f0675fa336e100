"""Contracts of the four event feeds: columns, keys, allowed values, topic fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    name: str                     # feed, topic and table name
    columns: dict[str, str]       # column -> "string" | "double" | "timestamp", in file order
    key: str                      # identifies one record after cleaning
    topic_key: str                # message key, keeps one entity in one topic partition
    topic_columns: tuple[str, ...]
    keyed_table: str
    keyed_partition: str

    def of_type(self, kind: str) -> list[str]:
        return [c for c, t in self.columns.items() if t == kind]

    def text_schema(self) -> T.StructType:
        """Every column as text, the way files and topics carry them."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def topic_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.topic_columns])


# The allowed values of the feeds.
RIDE_STATUSES = ["completed", "cancelled", "in_progress"]
PAYMENT_STATUSES = ["success", "failed", "pending", "refunded"]
PAYMENT_METHODS = ["card", "cash", "uber_cash", "paypal"]
CANCEL_REASONS = ["rider_cancelled", "driver_cancelled", "no_driver_available", "rider_no_show"]
CANCELLED_BY = ["rider", "driver", "system"]
AVAILABILITY = ["available", "on_trip", "offline"]
CITIES = ["New York", "San Francisco", "Chicago", "Los Angeles", "Miami", "Seattle", "Austin", "Boston"]

RIDES = Feed(
    name="ride_events",
    columns={
        "ride_id": "string", "rider_id": "string", "driver_id": "string", "city": "string",
        "pickup_lat": "double", "pickup_lng": "double", "dropoff_lat": "double", "dropoff_lng": "double",
        "request_time": "timestamp", "pickup_time": "timestamp", "dropoff_time": "timestamp",
        "ride_status": "string", "fare_amount": "double", "surge_multiplier": "double",
        "distance_miles": "double", "duration_minutes": "double", "payment_type": "string",
        "event_timestamp": "timestamp",
    },
    key="ride_id",
    topic_key="ride_id",
    topic_columns=("ride_id", "rider_id", "driver_id", "city", "ride_status", "fare_amount", "surge_multiplier",
                   "distance_miles", "duration_minutes", "payment_type", "event_timestamp"),
    keyed_table="rides",
    keyed_partition="city",
)

LOCATIONS = Feed(
    name="driver_location_events",
    columns={
        "event_id": "string", "driver_id": "string", "city": "string", "lat": "double", "lng": "double",
        "availability_status": "string", "event_timestamp": "timestamp",
    },
    key="event_id",
    topic_key="driver_id",
    topic_columns=("event_id", "driver_id", "city", "lat", "lng", "availability_status", "event_timestamp"),
    keyed_table="driver_locations",
    keyed_partition="city",
)

PAYMENTS = Feed(
    name="payment_events",
    columns={
        "payment_id": "string", "ride_id": "string", "payment_status": "string", "amount": "double",
        "currency": "string", "payment_method": "string", "event_timestamp": "timestamp",
    },
    key="payment_id",
    topic_key="ride_id",
    topic_columns=("payment_id", "ride_id", "payment_status", "amount", "currency", "payment_method",
                   "event_timestamp"),
    keyed_table="payments",
    keyed_partition="event_date",
)

CANCELLATIONS = Feed(
    name="cancellation_events",
    columns={
        "cancellation_id": "string", "ride_id": "string", "cancelled_by": "string", "reason": "string",
        "event_timestamp": "timestamp",
    },
    key="cancellation_id",
    topic_key="ride_id",
    topic_columns=("cancellation_id", "ride_id", "cancelled_by", "reason", "event_timestamp"),
    keyed_table="cancellations",
    keyed_partition="event_date",
)

FEEDS = {feed.name: feed for feed in (RIDES, LOCATIONS, PAYMENTS, CANCELLATIONS)}
