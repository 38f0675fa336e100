"""The four event feeds read from the star-schema tables of a data folder.

`events` supplies rides (and through them payments and cancellations), `lineitem` supplies driver pings.
The mapping plants rule violations and repeated ids, so that cleaning has something to do. Feeds carry a
numeric `event_id` besides the feed's own columns where the mapping needs one; the functions without a
leading underscore return the contract columns only, plus `event_date`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.derive import derive_cancellations, derive_payments
from kerbside.schemas import CITIES, PAYMENT_METHODS, RIDES


def _pick(values: list[str], index: str) -> str:
    """SQL for the value at a place in a fixed list."""
    return f"get(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT))"


def _degrees(factor: int, limit: int) -> str:
    """SQL for a coordinate with three decimals in -limit..limit, spread by the event id."""
    return f"CAST(event_id * {factor} % {2000 * limit + 1} - {1000 * limit} AS DOUBLE) / 1000"


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def _ride_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "concat('ride_', event_id) AS ride_id",
        "concat('rider_', user_id) AS rider_id",
        "CASE WHEN event_id % 53 <> 0 THEN concat('driver_', regexp_extract(props, '([0-9]+)', 1)) END AS driver_id",
        f"{_pick(CITIES, 'user_id % 8')} AS city",
        f"{_degrees(37, 90)} AS pickup_lat",
        f"{_degrees(73, 180)} AS pickup_lng",
        f"{_degrees(41, 90)} AS dropoff_lat",
        f"{_degrees(79, 180)} AS dropoff_lng",
        "ts AS request_time",
        "ts + INTERVAL '1' SECOND * (event_id % 420 + 60) AS pickup_time",
        """CASE WHEN event_type NOT IN ('error', 'signup')
           THEN ts + INTERVAL '1' SECOND * (event_id % 3600 + 60) END AS dropoff_time""",
        """CASE WHEN event_type = 'error' THEN 'cancelled' WHEN event_type <> 'signup' THEN 'completed'
           WHEN event_id % 41 = 0 THEN 'unknown' ELSE 'in_progress' END AS ride_status""",
        """CASE WHEN event_type NOT IN ('error', 'signup')
           THEN if(event_id % 47 = 0, value * -1.0D, value) END AS fare_amount""",
        "CAST(event_id % 11 * 15 + 100 AS DOUBLE) / 100 AS surge_multiplier",
        "if(event_id % 59 = 0, 0.0D, CAST(event_id * 13 % 2450 + 50 AS DOUBLE) / 100) AS distance_miles",
        "CAST(event_id * 17 % 1080 AS DOUBLE) / 10 AS duration_minutes",
        f"{_pick(PAYMENT_METHODS, 'event_id % 4')} AS payment_type",
        "ts AS event_timestamp",
        # Every 37th ride comes twice; the second record is an hour later and a dollar dearer.
        "explode(if(event_id % 37 = 0, array(false, true), array(false))) AS again",
    )
    return _dated(rides.withColumns({
        "fare_amount": F.expr("if(again, fare_amount + 1.0D, fare_amount)"),
        "event_timestamp": F.expr("if(again, event_timestamp + INTERVAL '1' HOUR, event_timestamp)"),
    }).drop("again"))


def ride_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ride_rows(spark, sf_dir).select(*RIDES.columns, "event_date")


def driver_location_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "CASE WHEN l_orderkey % 997 <> 0 THEN concat('loc_', l_orderkey, '_', l_linenumber) END AS event_id",
        "concat('driver_', l_suppkey) AS driver_id",
        f"{_pick(CITIES, 'l_suppkey % 8')} AS city",
        "l_quantity * 2 - 5 AS lat",
        "l_extendedprice % 400 - 180 AS lng",
        """CASE WHEN l_returnflag = 'A' THEN 'available' WHEN l_returnflag = 'R' THEN 'on_trip'
           WHEN l_partkey % 43 = 0 THEN 'unknown' ELSE 'offline' END AS availability_status""",
        "l_shipdate + INTERVAL '1' HOUR * l_linenumber AS event_timestamp",
    ))


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.expr("""CASE WHEN event_id % 50 < 46 THEN 'success' WHEN event_id % 50 < 48 THEN 'failed'
                       WHEN event_id % 50 = 48 THEN 'pending' ELSE 'refunded' END""")
    return _dated(derive_payments(
        _ride_rows(spark, sf_dir), status, F.expr("event_id % 56 + 5"), F.expr("concat('pay_', event_id)")))


def cancellation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = F.expr("CASE event_id % 3 WHEN 0 THEN 'rider' WHEN 1 THEN 'driver' ELSE 'system' END")
    reason = F.expr("""CASE event_id % 5 WHEN 0 THEN 'rider_cancelled' WHEN 1 THEN 'driver_cancelled'
                       WHEN 2 THEN 'no_driver_available' ELSE 'rider_no_show' END""")
    return _dated(derive_cancellations(
        _ride_rows(spark, sf_dir), by, reason, F.expr("event_id % 271 + 30"), F.expr("concat('cancel_', event_id)")))


READERS = {
    "ride_events": ride_events,
    "driver_location_events": driver_location_events,
    "payment_events": payment_events,
    "cancellation_events": cancellation_events,
}
