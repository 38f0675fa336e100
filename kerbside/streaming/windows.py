"""Event-time window summaries of the decoded topics.

The same functions serve streams, whose records carry a watermark on `event_ts`, and stored data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.measures import exact_mean, exact_sum


def _bounds() -> tuple[Column, Column]:
    return F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")


def _windowed(df: DataFrame, length: str, *keys: str):
    return df.groupBy(F.window("event_ts", length), *keys)


def ride_windows(rides: DataFrame) -> DataFrame:
    """Rides, revenue and means by city and status, five minutes at a time."""
    keys = ("city", "ride_status")
    sums = _windowed(rides, "5 minutes", *keys).agg(
        F.count("ride_id").alias("ride_count"),
        exact_sum("fare_amount").alias("total_revenue"),
        exact_mean("fare_amount").alias("avg_fare"),
        exact_mean("surge_multiplier").alias("avg_surge"),
        exact_mean("distance_miles").alias("avg_distance"),
    )
    return sums.select(*_bounds(), *keys, "ride_count", "total_revenue", "avg_fare", "avg_surge", "avg_distance")


def availability_windows(locations: DataFrame) -> DataFrame:
    """Pings by city and availability per minute."""
    keys = ("city", "availability_status")
    return (_windowed(locations, "1 minute", *keys)
            .agg(F.count("driver_id").alias("driver_count"))
            .select(_bounds()[0], *keys, "driver_count"))


def payment_windows(payments: DataFrame) -> DataFrame:
    """Payments and amounts by method and status, five minutes at a time."""
    keys = ("payment_method", "payment_status")
    sums = _windowed(payments, "5 minutes", *keys).agg(
        F.count("payment_id").alias("txn_count"),
        exact_sum("amount").alias("total_amount"),
        exact_mean("amount").alias("avg_amount"),
    )
    return sums.select(*_bounds(), *keys, "txn_count", "total_amount", "avg_amount")


def cancellation_windows(cancellations: DataFrame) -> DataFrame:
    """Cancellations by actor and reason, five minutes at a time."""
    keys = ("cancelled_by", "reason")
    return (_windowed(cancellations, "5 minutes", *keys)
            .agg(F.count("cancellation_id").alias("cancellation_count"))
            .select(*_bounds(), *keys, "cancellation_count"))


def ride_monitor(rides: DataFrame) -> DataFrame:
    """Requests and mean surge by city per minute, sorted; as a stream it needs complete mode."""
    return (_windowed(rides, "1 minute", "city")
            .agg(F.count("ride_id").alias("requests"), F.round(exact_mean("surge_multiplier"), 2).alias("avg_surge"))
            .select(F.col("window.start").alias("minute"), "city", "requests", "avg_surge")
            .orderBy("minute", "city"))


def _share(status: str) -> Column:
    return F.try_divide(F.count_if(F.col("payment_status") == status), F.count("payment_id"))


def payment_rates(payments: DataFrame) -> DataFrame:
    """Share of successful and of failed payments by method, five minutes at a time."""
    return (_windowed(payments, "5 minutes", "payment_method")
            .agg(F.count("payment_id").alias("txn_count"),
                 _share("success").alias("success_rate"), _share("failed").alias("failure_rate"))
            .select(*_bounds(), "payment_method", "txn_count", "success_rate", "failure_rate"))
