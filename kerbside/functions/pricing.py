"""Fare, surge and time-shift expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fare components in dollars, and the speed that turns miles into minutes.
BASE_FARE = 2.50
PER_MILE = 1.25
PER_MINUTE = 0.25
MILES_PER_HOUR = 15

# Base surge for each hour of the day, 0 to 23.
SURGE_BY_HOUR = [
    1.5, 1.8, 2.0, 1.5, 1.2, 1.0,
    1.2, 1.8, 2.5, 1.5, 1.0, 1.0,
    1.2, 1.0, 1.0, 1.2, 1.5, 2.0,
    2.5, 2.0, 1.5, 1.5, 1.8, 2.0,
]


def fare_quote(miles: Column, surge: Column) -> Column:
    """Price of a trip: base, miles and estimated minutes, times the surge, in cents precision."""
    minutes = miles / MILES_PER_HOUR * 60
    return F.round((BASE_FARE + PER_MILE * miles + PER_MINUTE * minutes) * surge, 2)


def surge_at(time: Column, jitter: Column | float = 0.0) -> Column:
    """Surge for the hour of `time` plus jitter, never below 1."""
    table = F.array(*[F.lit(s) for s in SURGE_BY_HOUR])
    jitter = F.lit(jitter) if isinstance(jitter, float) else jitter
    return F.round(F.greatest(F.lit(1.0), F.get(table, F.hour(time)) + jitter), 2)


def shift_seconds(time: Column, seconds: Column) -> Column:
    return time + F.expr("INTERVAL '1' SECOND") * seconds


def completion_fare(miles: Column) -> Column:
    """Flat fare written when an open ride is closed by an update."""
    return F.round(miles * 2.5 + 2.50, 2)
