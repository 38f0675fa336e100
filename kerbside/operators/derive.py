"""Payments and cancellations that follow from rides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.pricing import shift_seconds


def _suffix(name: str) -> Column:
    """The part of an id after its prefix."""
    return F.regexp_replace(name, "^[^_]*_", "")


def derive_payments(rides: DataFrame, status: Column, seconds: Column, payment_id: Column | None = None) -> DataFrame:
    """One payment per completed ride, some seconds after dropoff; ids follow from the rides' unless given."""
    if payment_id is None:
        payment_id = F.concat(F.lit("pay_"), _suffix("ride_id"))
    return rides.filter(F.col("ride_status") == "completed").select(
        payment_id.alias("payment_id"),
        "ride_id",
        status.alias("payment_status"),
        F.col("fare_amount").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("payment_type").alias("payment_method"),
        shift_seconds(F.col("dropoff_time"), seconds).alias("event_timestamp"),
    )


def derive_cancellations(rides: DataFrame, cancelled_by: Column, reason: Column, seconds: Column,
                         cancellation_id: Column | None = None) -> DataFrame:
    """One cancellation per cancelled ride, some seconds after the request."""
    if cancellation_id is None:
        cancellation_id = F.concat(F.lit("cancel_"), _suffix("ride_id"))
    return rides.filter(F.col("ride_status") == "cancelled").select(
        cancellation_id.alias("cancellation_id"),
        "ride_id",
        cancelled_by.alias("cancelled_by"),
        reason.alias("reason"),
        shift_seconds(F.col("request_time"), seconds).alias("event_timestamp"),
    )
