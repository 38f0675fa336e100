"""Daily and hourly report tables over the cleaned feeds.

Each function returns its rows unsorted; `GOLD_ORDER` names the order in which they are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.measures import exact_mean, exact_sum, percent
from kerbside.schemas import CANCELLATIONS, PAYMENTS, RIDES


def _surge_rides() -> Column:
    return F.sum(F.col("is_surge").cast("int"))


def _ride_measures() -> list[Column]:
    return [
        F.count("ride_id").alias("total_rides"),
        exact_sum("fare_amount").alias("total_revenue"),
        exact_mean("fare_amount").alias("avg_fare"),
        exact_mean("distance_miles").alias("avg_distance_miles"),
        exact_mean("duration_minutes").alias("avg_duration_minutes"),
        exact_mean("surge_multiplier").alias("avg_surge_multiplier"),
        _surge_rides().alias("surge_rides"),
    ]


def _trip_measures(prefix: str = "") -> list[Column]:
    return [
        F.count(f"{prefix}ride_id").alias("completed_trips"),
        exact_sum(f"{prefix}fare_amount").alias("total_earnings"),
        exact_mean(f"{prefix}fare_amount").alias("avg_fare_per_trip"),
        exact_sum(f"{prefix}distance_miles").alias("total_distance_miles"),
        exact_sum(f"{prefix}duration_minutes").alias("total_duration_minutes"),
    ]


def _active_hours(per_day: DataFrame) -> DataFrame:
    return per_day.withColumn("active_hours", F.round(F.col("total_duration_minutes") / 60, 2))


def _surge_rate(cells: DataFrame) -> DataFrame:
    return cells.withColumn(
        "surge_rate_pct", F.round(percent(F.col("surge_count"), F.col("total_requests")), 2))


def daily_ride_metrics(rides: DataFrame) -> DataFrame:
    return rides.groupBy("event_date", "city", "ride_status").agg(*_ride_measures())


def driver_utilization(rides: DataFrame) -> DataFrame:
    completed = rides.filter(F.col("ride_status") == "completed")
    return _active_hours(completed.groupBy("event_date", "driver_id").agg(*_trip_measures()))


def city_demand_heatmap(rides: DataFrame) -> DataFrame:
    return _surge_rate(rides.groupBy("city", "trip_day_of_week", "trip_hour").agg(
        F.count("ride_id").alias("total_requests"),
        exact_mean("surge_multiplier").alias("avg_surge"),
        _surge_rides().alias("surge_count"),
        exact_mean("fare_amount").alias("avg_fare"),
    ))


def ride_reports(rides: DataFrame) -> DataFrame:
    """The groups of all three ride reports from one pass over the rides, each with the `report` that it is of.

    Grouping sets feed every ride to the three groups that it is in, and tasks add these up before the one shuffle.
    Completed trips are added up apart, so that drivers' groups hold nothing else. `ride_report` takes one report out.
    """
    completed = F.col("ride_status") == "completed"
    measured = ("ride_id", "fare_amount", "distance_miles", "duration_minutes")
    rides = rides.withColumns({f"_trip_{c}": F.when(completed, F.col(c)) for c in measured})
    keys = [F.col(c) for c in ("event_date", "city", "ride_status", "driver_id", "trip_day_of_week", "trip_hour")]
    date, city, status, driver, day, hour = keys
    # For each report, the bits of the keys above that it is not grouped by.
    report = F.when(F.grouping_id() == 0b000111, "daily_ride_metrics").when(F.grouping_id() == 0b011011, "driver_utilization")
    groups = rides.groupingSets([[date, city, status], [date, driver], [city, day, hour]], *keys)
    return groups.agg(report.otherwise("city_demand_heatmap").alias("report"), *_ride_measures(), *_trip_measures("_trip_"))


def ride_report(reports: DataFrame, table: str) -> DataFrame:
    """One of the tables in `ride_reports`, as its own function gives it."""
    found = reports.filter(F.col("report") == table)
    if table == "daily_ride_metrics":
        return found.select("event_date", "city", "ride_status", "total_rides", "total_revenue", "avg_fare",
                            "avg_distance_miles", "avg_duration_minutes", "avg_surge_multiplier", "surge_rides")
    if table == "driver_utilization":
        return _active_hours(found.filter(F.col("completed_trips") > 0).select(
            "event_date", "driver_id", "completed_trips", "total_earnings", "avg_fare_per_trip", "total_distance_miles",
            "total_duration_minutes"))
    return _surge_rate(found.select(
        "city", "trip_day_of_week", "trip_hour", F.col("total_rides").alias("total_requests"),
        F.col("avg_surge_multiplier").alias("avg_surge"), F.col("surge_rides").alias("surge_count"), "avg_fare"))


def payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("event_date", "payment_method", "payment_status").agg(
        F.count("payment_id").alias("transaction_count"),
        exact_sum("amount").alias("total_amount"),
        exact_mean("amount").alias("avg_amount"),
    )


def cancellation_analysis(cancellations: DataFrame) -> DataFrame:
    return cancellations.groupBy("event_date", "cancelled_by", "reason").agg(
        F.count("cancellation_id").alias("cancellation_count"),
    )


# table -> (feed it reads, builder)
GOLD = {
    "daily_ride_metrics": (RIDES.name, daily_ride_metrics),
    "driver_utilization": (RIDES.name, driver_utilization),
    "city_demand_heatmap": (RIDES.name, city_demand_heatmap),
    "payment_summary": (PAYMENTS.name, payment_summary),
    "cancellation_analysis": (CANCELLATIONS.name, cancellation_analysis),
}

# How each table is sorted; rows alike in these follow in order of ORDER_TIES.
GOLD_ORDER = {
    "daily_ride_metrics": ["event_date", "city"],
    "driver_utilization": ["event_date", "-completed_trips"],
    "city_demand_heatmap": ["city", "trip_day_of_week", "trip_hour"],
    "payment_summary": ["event_date", "payment_method"],
    "cancellation_analysis": ["event_date", "-cancellation_count"],
}


ORDER_TIES = {
    "daily_ride_metrics": ["ride_status"],
    "driver_utilization": ["driver_id"],
    "city_demand_heatmap": [],
    "payment_summary": ["payment_status"],
    "cancellation_analysis": ["cancelled_by", "reason"],
}


def in_stored_order(df: DataFrame, table: str) -> DataFrame:
    """Globally sorted as the table is stored; a leading minus means descending."""
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c)
                        for c in GOLD_ORDER[table] + ORDER_TIES[table]])
