"""Small hand-written frames with the feeds' columns."""

from pyspark.sql import functions as F

from kerbside.schemas import LOCATIONS, RIDES

RIDE = dict(ride_id="r1", rider_id="p1", driver_id="d1", city="Miami", pickup_lat=1.0, pickup_lng=2.0, dropoff_lat=3.0,
            dropoff_lng=4.0, request_time="2024-01-07 10:15:00", pickup_time="2024-01-07 10:20:00",
            dropoff_time="2024-01-07 10:40:00", ride_status="completed", fare_amount=10.0, surge_multiplier=1.5,
            distance_miles=3.0, duration_minutes=20.0, payment_type="card", event_timestamp="2024-01-07 10:15:00")
PING = dict(event_id="e1", driver_id="d1", city="Miami", lat=1.0, lng=2.0, availability_status="available",
            event_timestamp="2024-01-07 10:15:00")


def frame(spark, feed, base, changes):
    """One row per dict of changes to the base row."""
    names = list(feed.columns)
    schema = ", ".join(f"{c} {'double' if t == 'double' else 'string'}" for c, t in feed.columns.items())
    rows = [tuple({**base, **change}[c] for c in names) for change in changes]
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.to_timestamp(c) for c in feed.of_type("timestamp")}).withColumn(
        "event_date", F.to_date("event_timestamp"))


def rides(spark, *changes):
    return frame(spark, RIDES, RIDE, changes)


def pings(spark, *changes):
    return frame(spark, LOCATIONS, PING, changes)
