"""Dashboard summaries over the cleaned feeds, the report tables and the stream tables.

Means of report columns are means of the stored per-group means, not weighted by group size.
Groups with a NULL key are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.measures import exact_mean, exact_sum, percent

HIGH_SURGE = 1.5
HISTOGRAM_BINS = 40


def _by(df: DataFrame, *keys: str):
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(*keys)


def _completed(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("ride_status") == "completed")


def kpi_summary(rides: DataFrame, payments: DataFrame, locations: DataFrame,
                cancellations: DataFrame) -> DataFrame:
    """One row of headline figures."""
    count = F.count(F.lit(1))
    parts = [
        rides.agg(count.alias("total_rides"), exact_sum("fare_amount").alias("total_revenue"),
                  exact_mean("fare_amount").alias("avg_fare"), exact_mean("surge_multiplier").alias("avg_surge")),
        payments.agg(count.alias("payment_events")),
        locations.agg(count.alias("driver_pings")),
        cancellations.agg(count.alias("cancellations")),
    ]
    # One row per feed, each with its own columns; the maximum skips the NULLs of the others.
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).withColumn(
        "cancellation_rate_pct", percent(F.col("cancellations"), F.col("total_rides")))


def city_revenue(metrics: DataFrame) -> DataFrame:
    """Revenue of completed rides by city in whole dollars, highest first."""
    sums = _by(_completed(metrics), "city").agg(
        F.coalesce(exact_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"))
    return (sums.orderBy(F.col("total_revenue").desc(), "city")
            .withColumn("total_revenue", F.round("total_revenue", 0)))


def rides_by_status(metrics: DataFrame) -> DataFrame:
    return _by(metrics, "ride_status").agg(F.sum("total_rides").alias("total_rides"))


def avg_fare_by_city(metrics: DataFrame) -> DataFrame:
    return (_by(_completed(metrics), "city").agg(exact_mean("avg_fare").alias("avg_fare"))
            .orderBy("avg_fare", "city"))


def surge_heatmap(demand: DataFrame) -> DataFrame:
    return _by(demand, "city", "trip_hour").agg(exact_mean("avg_surge").alias("avg_surge"))


def surge_heatmap_pivot(demand: DataFrame) -> DataFrame:
    """One row per city, one column per hour; the hours are fixed, so Spark need not look for them."""
    cells = _by(demand, "city", "trip_hour")
    wide = (cells.agg(exact_mean("avg_surge").alias("avg_surge"))
            .groupBy("city").pivot("trip_hour", list(range(24))).agg(F.first("avg_surge")))
    return wide.select("city", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def peak_surge_hours(demand: DataFrame) -> DataFrame:
    hours = _by(demand, "trip_hour").agg(exact_mean("avg_surge").alias("avg_surge"))
    return hours.withColumn("is_high", F.col("avg_surge") > HIGH_SURGE).orderBy("trip_hour")


def transactions_by(summary: DataFrame, key: str) -> DataFrame:
    """Payments by `payment_method` or by `payment_status`."""
    return _by(summary, key).agg(F.sum("transaction_count").alias("transaction_count"))


def histogram(df: DataFrame, name: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per bin of equal width between the smallest and the largest value, which falls in the last bin.

    Only bins with rows are returned. The bounds are a scalar subquery, a pass of its own over the table, so give a
    stored one; rows are then binned before the shuffle, which carries one row per bin and task.
    """
    values = df.filter(F.col(name).isNotNull()).select(F.col(name).cast("double").alias("value"))
    bounds = values.select(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    width = (high - low) / bins
    last = F.lit(bins - 1).cast("long")
    place = F.when(F.col("value") >= high, F.when(high > low, last).otherwise(F.lit(0).cast("long"))) \
        .otherwise(F.least(last, F.floor(F.try_divide(F.col("value") - low, width))))
    return (values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_start", low + F.col("bin") * width))


def top_drivers(utilization: DataFrame, n: int = 10) -> DataFrame:
    """The n drivers who earned most, with ids cut to 20 characters."""
    sums = _by(utilization, "driver_id").agg(
        F.coalesce(exact_sum("total_earnings"), F.lit(0.0)).alias("total_earnings"))
    return sums.orderBy(F.col("total_earnings").desc(), "driver_id").limit(n).select(
        F.concat(F.substring("driver_id", 1, 20), F.lit("...")).alias("driver"),
        F.round("total_earnings", 2).alias("total_earnings"))


def latest_windows(windows: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The n latest rows of a stream table."""
    return windows.orderBy(F.col("window_start").desc(), *keys).limit(n)


def stream_city_totals(ride_windows: DataFrame) -> DataFrame:
    return (_by(ride_windows, "city").agg(F.sum("ride_count").alias("ride_count"))
            .orderBy(F.col("ride_count").desc(), "city"))


def preview(table: DataFrame, order: str | Sequence[str | Column], n: int = 50) -> DataFrame:
    return table.orderBy(*([order] if isinstance(order, str) else order)).limit(n)
