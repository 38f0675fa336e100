"""Dashboard summaries, derived feeds, prices and checks on small frames."""

import math

import pytest
from pyspark.sql import functions as F

import rows
from kerbside.functions.measures import exact_mean, exact_sum
from kerbside.functions.pricing import SURGE_BY_HOUR, fare_quote, shift_seconds, surge_at
from kerbside.operators import marts
from kerbside.operators.dedup import keep_first, keep_latest
from kerbside.operators.derive import derive_cancellations, derive_payments
from kerbside.operators.quality import MissingData, check_tables, require
from kerbside.plans.catalogue import QUERIES


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def bins(spark, *values, n=4):
    return {r["bin"]: (r["n"], r["bin_start"]) for r in marts.histogram(numbers(spark, *values), "x", n).collect()}


def test_histogram_puts_the_largest_value_in_the_last_bin(spark):
    assert bins(spark, 0.0, 0.9, 1.0, 2.5, 4.0, None) == {0: (2, 0.0), 1: (1, 1.0), 2: (1, 2.0), 3: (1, 3.0)}


def test_histogram_of_one_value_and_of_none(spark):
    assert bins(spark, 5.0, 5.0) == {0: (2, 5.0)}
    assert bins(spark, None) == {}


def total(spark, *values):
    return numbers(spark, *values).agg(exact_sum("x"), exact_mean("x")).first()


def test_sums_beyond_whole_units_do_not_fail(spark):
    assert total(spark, *[9e13] * 11) == (9.9e14, 9e13)
    assert total(spark, *[9e13] * 10) == (9e14, 9e13)
    assert total(spark, *[1.1e14] * 11) == (1.21e15, 1.1e14)
    assert total(spark, 9.9e13, 1.01e14, -9.9e13)[0] == 1.01e14
    assert total(spark, 1e300, 1.25, None)[0] == 1e300
    assert total(spark, 0.1, 0.2, None) == (0.3, 0.15)
    assert total(spark, None) == (None, None)
    assert total(spark, math.inf, 1.0)[0] == math.inf
    assert math.isnan(total(spark, math.nan, 1.0)[0]) and math.isnan(total(spark, math.inf, -math.inf)[0])


def test_means_of_means_are_not_weighted(spark):
    metrics = spark.createDataFrame(
        [("Miami", "completed", 1, 10.0, 10.0), ("Miami", "completed", 9, 180.0, 20.0), (None, "completed", 1, 1.0, 1.0),
         ("Austin", "cancelled", 3, None, None)],
        "city string, ride_status string, total_rides long, total_revenue double, avg_fare double")
    assert [tuple(r) for r in marts.avg_fare_by_city(metrics).collect()] == [("Miami", 15.0)]
    assert [tuple(r) for r in marts.city_revenue(metrics).collect()] == [("Miami", 190.0)]


def test_pivot_leaves_missing_hours_null(spark):
    demand = spark.createDataFrame([("Miami", 1, 3, 1.0), ("Miami", 2, 3, 2.0), ("Austin", 1, 23, 1.25)],
                                   "city string, trip_day_of_week int, trip_hour int, avg_surge double")
    found = {r["city"]: r for r in marts.surge_heatmap_pivot(demand).collect()}
    assert found["Miami"]["h03"] == 1.5 and found["Miami"]["h23"] is None and found["Austin"]["h23"] == 1.25
    assert len(found["Miami"]) == 25


def test_peak_threshold(spark):
    demand = spark.createDataFrame([("a", 8, 1.5), ("a", 9, 1.6)], "city string, trip_hour int, avg_surge double")
    assert [r["is_high"] for r in marts.peak_surge_hours(demand).collect()] == [False, True]


def test_top_drivers_breaks_ties_by_id_and_cuts_ids(spark):
    used = spark.createDataFrame([(f"driver_{'x' * 20}{i}", 5.0) for i in range(12)] + [("d", 9.0), ("e", None)],
                                 "driver_id string, total_earnings double")
    found = marts.top_drivers(used, 3).collect()
    assert [tuple(r) for r in found] == [("d...", 9.0), ("driver_xxxxxxxxxxxxx...", 5.0), ("driver_xxxxxxxxxxxxx...", 5.0)]


def test_kpis_of_empty_tables(spark):
    none = rows.rides(spark, {}).filter("false")
    found = marts.kpi_summary(none, none, none, none).first()
    assert found["total_rides"] == 0 and found["total_revenue"] is None and found["cancellation_rate_pct"] is None


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 5, "n"), (None, 6, "m")],
                               "k string, t int, v string")
    assert {r["k"]: r["v"] for r in keep_latest(df, "k", "t").collect()} == {"a": "y", None: "m"}
    assert {r["k"]: r["v"] for r in keep_first(df, "k", "t").collect()} == {"a": "x", None: "n"}


def test_prices(spark):
    row = spark.range(1).select(
        fare_quote(F.lit(10.0), F.lit(1.5)).alias("fare"),
        surge_at(F.to_timestamp(F.lit("2024-01-01 08:30:00"))).alias("rush"),
        surge_at(F.to_timestamp(F.lit("2024-01-01 05:30:00")), F.lit(-0.1)).alias("floor"),
        shift_seconds(F.to_timestamp(F.lit("2024-01-01 23:59:50")), F.lit(15)).cast("string").alias("later")).first()
    # (2.50 + 12.50 + 40 minutes at 0.25) * 1.5
    assert row["fare"] == 37.5 and row["rush"] == 2.5 and row["floor"] == 1.0 and row["later"] == "2024-01-02 00:00:05"
    assert len(SURGE_BY_HOUR) == 24


def test_derived_feeds(spark):
    df = rows.rides(spark, *[{"ride_id": f"ride_{i:04d}", "ride_status": s} for i in range(300)
                             for s in (("completed", "cancelled", "in_progress")[i % 3],)])
    payments = derive_payments(df, F.lit("success"), F.lit(7)).orderBy("payment_id").collect()
    cancellations = derive_cancellations(df, F.lit("rider"), F.lit("rider_no_show"), F.lit(30)).collect()
    assert len(payments) == len(cancellations) == 100
    first = df.filter("ride_id = 'ride_0000'").first()
    assert payments[0]["payment_id"] == "pay_0000" and payments[0]["payment_status"] == "success"
    assert (payments[0]["event_timestamp"] - first["dropoff_time"]).total_seconds() == 7
    assert {(r["cancelled_by"], r["reason"]) for r in cancellations} == {("rider", "rider_no_show")}


def test_checks(spark):
    full, empty = numbers(spark, 1.0, 2.0), numbers(spark, 1.0).filter("false")
    assert {r["table"]: (r["n_rows"], r["status"]) for r in check_tables({"a": full, "b": empty}).collect()} == {
        "a": (2, "ok"), "b": (0, "empty")}
    assert require({"a": full}) == ["a"]
    with pytest.raises(MissingData, match="c: missing; b: empty"):
        require({"a": full, "b": empty, "c": None})


def test_a_question_leaves_views_as_they_were(spark, sf_dir):
    """A user's view of the same name is there afterwards, and no other view is left."""
    spark.range(3).createOrReplaceTempView("rides")
    before = {t.name for t in spark.catalog.listTables()}
    found = QUERIES["sql_top_revenue_city"](spark, sf_dir)
    assert found.count() == 1 and spark.table("rides").count() == 3
    assert {t.name for t in spark.catalog.listTables()} == before
    spark.catalog.dropTempView("rides")
    QUERIES["run_query"](spark, sf_dir)
    assert "rides" not in {t.name for t in spark.catalog.listTables()}
