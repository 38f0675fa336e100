"""Topics and streams on hand-written records."""

import json

import pytest
from pyspark.sql import functions as F

import rows
from kerbside.schemas import CANCELLATIONS, LOCATIONS, PAYMENTS, RIDES
from kerbside.sources import topics
from kerbside.sources.files import path_exists
from kerbside.streaming import faults, runs, windows

PINGS = runs.STREAM_TABLES["driver_availability"]


def records(spark, *values):
    return spark.createDataFrame([("k", v) for v in values], topics.RECORD_SCHEMA)


def ping_at(spark, *times, city="Miami"):
    """Ping records at the given minutes past ten."""
    return topics.topic_records(rows.pings(spark, *[
        {"event_id": f"{city}{i}", "city": city, "event_timestamp": f"2024-01-07 {t}"} for i, t in enumerate(times)]),
        LOCATIONS)


def run(spark, folder, *batches, delay="10 minutes", table=PINGS):
    """Feed the batches one after the other to one stream, restarting it for each; return its progress reports."""
    reports = []
    for batch in batches:
        topics.write_topic_files(batch, f"{folder}/topic")
        query = runs.start_table(topics.read_topic_files(spark, f"{folder}/topic"), table, folder, delay, once=True)
        runs.run_once(query)
        reports.append(query.recentProgress)
    return reports


def stored(spark, folder, table=PINGS):
    return {str(r["window_start"])[11:16]: r[-1] for r in spark.read.parquet(f"{folder}/streaming/{table.name}").collect()}


def test_values_of_every_kind(spark):
    found = topics.decode(records(
        spark,
        '{"lat": "1.5", "event_timestamp": "2024-01-07T10:00:00"}', '{"lat": 1.5}', '{"lat": null}', '{"lat": "abc"}',
        "not json", '{"event_timestamp": "soon", "driver_id": "d"}'), LOCATIONS).collect()
    assert [r["lat"] for r in found] == [1.5, 1.5, None, None, None, None]
    assert str(found[0]["event_ts"]) == "2024-01-07 10:00:00"
    assert found[5]["event_ts"] is None and found[5]["driver_id"] == "d"
    assert all(v is None for v in found[4])


def test_binary_values(spark):
    df = records(spark, '{"driver_id": "d"}').withColumn("value", F.col("value").cast("binary"))
    assert topics.decode(df, LOCATIONS).first()["driver_id"] == "d"


def test_record_form(spark):
    df = rows.pings(spark, {"event_id": "", "lat": None})
    record = topics.topic_records(df, LOCATIONS).first()
    assert record["topic"] == "driver_location_events" and record["key"] == "d1"
    assert json.loads(record["value"]) == {
        "event_id": None, "driver_id": "d1", "city": "Miami", "lat": None, "lng": "2.0",
        "availability_status": "available", "event_timestamp": "2024-01-07T10:15:00.000000"}


def test_records_survive_the_trip(spark):
    df = rows.rides(spark, {}, {"ride_id": "r2", "fare_amount": None, "ride_status": "cancelled"})
    back = topics.decode(topics.topic_records(df, RIDES), RIDES)
    names = [c for c in RIDES.topic_columns if c != "event_timestamp"]
    assert back.select(names).orderBy("ride_id").collect() == df.select(names).orderBy("ride_id").collect()
    assert [r[0] for r in back.select("event_ts").collect()] == [r[0] for r in df.select("event_timestamp").collect()]


def test_tail_and_counts(spark):
    first = ping_at(spark, "10:00:00", "10:01:00", "10:02:00")
    second = topics.topic_records(spark.createDataFrame(
        [("c1", "r1", "rider", "x", None)],
        "cancellation_id string, ride_id string, cancelled_by string, reason string, event_timestamp timestamp"),
        CANCELLATIONS)
    tail = topics.tail([first, second], 2, [F.col("key"), F.col("value")])
    assert sorted(r["topic"] for r in tail.collect()) == ["cancellation_events"] + ["driver_location_events"] * 2
    counts = topics.topic_counts(first.unionByName(second)).collect()
    assert {r["topic"]: r["n_records"] for r in counts} == {"driver_location_events": 3, "cancellation_events": 1}


def test_broker_options():
    assert topics.topic_options("ride_events", "host:9092") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "ride_events", "startingOffsets": "earliest",
        "failOnDataLoss": "false"}


def test_closed_windows_only(spark, folder):
    run(spark, folder, ping_at(spark, "10:00:10", "10:00:50", "10:05:00", "10:11:00"))
    assert stored(spark, folder) == {"10:00": 2}


def test_long_delay_closes_nothing(spark, folder):
    run(spark, folder, ping_at(spark, "10:00:10", "11:00:00"), delay=runs.DELAY)
    assert stored(spark, folder) == {}


def test_null_time_is_in_no_window(spark, folder):
    nothing = rows.pings(spark, {"event_timestamp": None})
    run(spark, folder, ping_at(spark, "10:00:10", "10:30:00").unionByName(topics.topic_records(nothing, LOCATIONS)))
    assert stored(spark, folder) == {"10:00": 1}


def test_restart_counts_each_record_once(spark, folder):
    run(spark, folder, ping_at(spark, "10:00:10", "10:08:00"), ping_at(spark, "10:00:20", "10:12:00"),
        ping_at(spark, "10:40:00"))
    assert stored(spark, folder) == {"10:00": 2, "10:08": 1, "10:12": 1}


def test_late_record_is_dropped(spark, folder):
    reports = run(spark, folder, ping_at(spark, "10:00:10", "10:30:00"), ping_at(spark, "10:31:00"),
                  ping_at(spark, "10:00:40", "10:50:00", city="Boston"))
    dropped = sum(op["numRowsDroppedByWatermark"] for p in reports[2] for op in p["stateOperators"])
    assert dropped == 1
    assert stored(spark, folder) == {"10:00": 1, "10:30": 1, "10:31": 1}


def test_one_batch_late_counts_within_one_run(spark, folder):
    """Late records are judged by the watermark of the batch before: one batch late still counts."""
    for batch in (ping_at(spark, "10:00:10"), ping_at(spark, "10:30:00"), ping_at(spark, "10:00:40", city="Boston"),
                  ping_at(spark, "10:00:50", city="Austin"), ping_at(spark, "11:30:00")):
        topics.write_topic_files(batch.coalesce(1), f"{folder}/topic")
    source = topics.read_topic_files(spark, f"{folder}/topic", maxFilesPerTrigger="1")
    runs.run_once(runs.start_table(source, PINGS, folder, "10 minutes", once=True))
    found = spark.read.parquet(f"{folder}/streaming/driver_availability").collect()
    cities = {r["city"] for r in found if str(r["window_start"])[11:16] == "10:00"}
    assert cities == {"Miami", "Boston"}


def test_repeated_records_can_be_dropped(spark, folder):
    topics.write_topic_files(ping_at(spark, "10:00:10", "10:00:20").unionByName(ping_at(spark, "10:00:10")), f"{folder}/topic")
    source = topics.read_topic_files(spark, f"{folder}/topic")
    query = (runs.decode_stream(source, LOCATIONS, "10 minutes", drop_repeats=True).writeStream.format("parquet")
             .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
             .trigger(availableNow=True).start())
    runs.run_once(query)
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_table_without_repeated_records(spark, folder):
    once = ping_at(spark, "10:00:10", "10:00:20", "10:30:00")
    topics.write_topic_files(once.unionByName(once), f"{folder}/topic")
    source = topics.read_topic_files(spark, f"{folder}/topic")
    runs.run_once(runs.start_table(source, PINGS, folder, "10 minutes", once=True, drop_repeats=True))
    assert stored(spark, folder) == {"10:00": 2}


def test_monitor_shows_all_minutes_so_far(spark, folder):
    for minute in ("10:00:00", "10:05:00"):
        topics.write_topic_files(topics.topic_records(rows.rides(
            spark, {"event_timestamp": f"2024-01-07 {minute}", "surge_multiplier": 1.234}), RIDES), f"{folder}/topic")
        source = topics.read_topic_files(spark, f"{folder}/topic")
        runs.run_once(runs.start_monitor(source, "10 minutes", True, f"{folder}/monitor", f"{folder}/check"))
    found = runs.latest_monitor(spark, f"{folder}/monitor").orderBy("minute").collect()
    assert [(str(r["minute"])[11:16], r["requests"], r["avg_surge"]) for r in found] == [("10:00", 1, 1.23), ("10:05", 1, 1.23)]


def test_monitor_keeps_two_results_and_shows_few_rows(spark, folder):
    for hour in range(5):
        topics.write_topic_files(topics.topic_records(rows.rides(spark, *[
            {"ride_id": f"r{hour}-{m}", "event_timestamp": f"2024-01-07 1{hour}:{m:02d}:00"} for m in range(20)]), RIDES),
            f"{folder}/topic")
        source = topics.read_topic_files(spark, f"{folder}/topic")
        runs.run_once(runs.start_monitor(source, "10 minutes", True, f"{folder}/monitor", f"{folder}/check"))
    result = runs.latest_monitor(spark, f"{folder}/monitor")
    assert result.count() == 100 and not path_exists(spark, f"{folder}/monitor/result-2")
    shown = runs.latest_minutes(result)
    assert "TakeOrderedAndProject" in shown._jdf.queryExecution().executedPlan().toString()
    found = shown.collect()
    assert len(found) == runs.SHOWN and str(found[0]["minute"])[11:16] == "14:19"


def test_topics_run_for_a_while_and_stop(spark, folder):
    topics.write_topic_files(ping_at(spark, "10:00:10", "10:30:00"), f"{folder}/{LOCATIONS.name}")
    runs.run_topics(spark, lambda t: topics.read_topic_files(spark, f"{folder}/{t}"), folder, [LOCATIONS.name],
                    runtime=8, delay="10 minutes")
    assert not spark.streams.active


def test_failed_stream_raises(spark, folder):
    topics.write_topic_files(ping_at(spark, "10:00:10"), f"{folder}/topic")
    broken = topics.read_topic_files(spark, f"{folder}/topic").withColumn("value", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        runs.run_once(runs.start_table(broken, PINGS, folder, "10 minutes", once=True))


def test_payment_rates(spark):
    df = spark.createDataFrame(
        [("p1", "card", "success"), ("p2", "card", "failed"), ("p3", "card", "success"), ("p4", "cash", "pending")],
        "payment_id string, payment_method string, payment_status string").withColumn(
        "event_ts", F.to_timestamp(F.lit("2024-01-07 10:01:00")))
    found = {r["payment_method"]: (r["txn_count"], r["success_rate"], r["failure_rate"])
             for r in windows.payment_rates(df).collect()}
    assert found == {"card": (3, 2 / 3, 1 / 3), "cash": (1, 0.0, 0.0)}
    assert PAYMENTS.name in {t.feed.name for t in runs.STREAM_TABLES.values()}


def crash(spark, folder, point, table=PINGS):
    return faults.unfinish(spark, f"{folder}/streaming/{table.name}", f"{folder}/checkpoints/{table.name}", point)


@pytest.mark.parametrize("point", [faults.LOGGED, faults.WRITTEN])
def test_a_lost_batch_counts_once(spark, folder, point):
    """The files of a batch that was not finished lie in the folder, and its windows come once all the same."""
    steps = ping_at(spark, "10:00:10", "10:20:00"), ping_at(spark, "10:20:30", "10:40:00"), ping_at(spark, "11:00:00")
    run(spark, folder, *steps[:2])
    whole = {"10:00": 1, "10:20": 2}
    assert stored(spark, folder) == whole
    lost = crash(spark, folder, point)
    again = run(spark, folder, steps[2])
    assert min(p["batchId"] for p in again[0]) == lost
    assert stored(spark, folder) == whole | {"10:40": 1}
    rows_found = spark.read.parquet(f"{folder}/streaming/{PINGS.name}/*.parquet").count()
    assert rows_found == (3 if point == faults.LOGGED else 4)   # the second batch's file is there twice, listed once


def test_a_failed_task_leaves_nothing_to_readers(spark, folder):
    """One task of a batch fails; the restarted stream, without the fault, takes the same records again."""
    run(spark, folder, ping_at(spark, "10:00:10", "10:20:00"))
    topics.write_topic_files(ping_at(spark, "10:30:00", "10:50:00"), f"{folder}/topic")
    source = topics.read_topic_files(spark, f"{folder}/topic")
    bad = source.withColumn("value", F.when(F.col("value").contains("10:50"), F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        runs.run_once(runs.start_table(bad, PINGS, folder, "10 minutes", once=True))
    assert stored(spark, folder) == {"10:00": 1}
    run(spark, folder, ping_at(spark, "11:30:00"))
    assert stored(spark, folder) == {"10:00": 1, "10:20": 1, "10:30": 1, "10:50": 1}


def test_a_stream_moves_to_more_state_partitions(spark, folder):
    """Open windows are taken along, written ones are not written again, and restarts stay with the new checkpoint."""
    first, second, third = (ping_at(spark, "10:00:10", "10:08:30"), ping_at(spark, "10:08:40", "10:20:00", city="Miami"),
                            ping_at(spark, "10:19:30", "10:20:30", "10:45:00", "10:00:50", city="Austin"))
    reports = run(spark, folder, first, second)
    parts = [p["stateOperators"][0]["numShufflePartitions"] for report in reports for p in report if p["stateOperators"]]
    assert stored(spark, folder) == {"10:00": 1, "10:08": 2}
    topics.write_topic_files(third, f"{folder}/topic")
    more = 2 * parts[0]
    for move in (True, False):
        with runs.state_partitions(spark, more):
            query = runs.start_table(topics.read_topic_files(spark, f"{folder}/topic"), PINGS, folder, "10 minutes", once=True,
                                     move=move)
        runs.run_once(query)
        assert all(op["numShufflePartitions"] == more for p in query.recentProgress for op in p["stateOperators"])
        topics.write_topic_files(ping_at(spark, "11:30:00", city="Boston"), f"{folder}/topic")
    assert runs.generations(spark, folder, PINGS) == 2
    found = sorted((str(r["window_start"])[11:16], r["city"], r["driver_count"]) for r in runs.read_table(spark, folder, PINGS).collect())
    assert found == [("10:00", "Miami", 1), ("10:08", "Miami", 2), ("10:19", "Austin", 1), ("10:20", "Austin", 1),
                     ("10:20", "Miami", 1), ("10:45", "Austin", 1)]


def test_only_known_points(spark, folder):
    run(spark, folder, ping_at(spark, "10:00:10"))
    with pytest.raises(ValueError, match="point"):
        crash(spark, folder, "elsewhere")


def test_redelivered_records_over_batches(spark, folder):
    """Records come again in later batches: while they are remembered they are dropped, later they are too late."""
    first, second = ping_at(spark, "10:00:10", "10:05:00"), ping_at(spark, "10:06:00", "10:08:00", city="Boston")
    reports = []
    for step in (first, second.unionByName(first), ping_at(spark, "10:40:00", city="Austin").unionByName(first),
                 ping_at(spark, "11:00:00", city="Seattle").unionByName(first).unionByName(second)):
        topics.write_topic_files(step, f"{folder}/topic")
        query = runs.start_table(topics.read_topic_files(spark, f"{folder}/topic"), PINGS, folder, "10 minutes", once=True,
                                 drop_repeats=True)
        runs.run_once(query)
        reports.append(query.recentProgress)
    assert stored(spark, folder) == {"10:00": 1, "10:05": 1, "10:06": 1, "10:08": 1, "10:40": 1}
    kept = [[op["numRowsTotal"] for op in p[-1]["stateOperators"] if "dedupe" in op["operatorName"].lower()] for p in reports]
    assert kept == [[2], [4], [1], [1]]     # only what the delay still covers


def test_a_later_event_of_an_id_is_no_repeat(spark, folder):
    twice = rows.pings(spark, {}, {"event_timestamp": "2024-01-07 10:16:00"}, {}, {"event_timestamp": "2024-01-07 10:50:00"})
    topics.write_topic_files(topics.topic_records(twice, LOCATIONS), f"{folder}/topic")
    runs.run_once(runs.start_table(topics.read_topic_files(spark, f"{folder}/topic"), PINGS, folder, "10 minutes", once=True,
                                   drop_repeats=True))
    assert stored(spark, folder) == {"10:15": 1, "10:16": 1}


def test_places_are_without_gaps(spark, folder):
    """Each writing task numbers its records; a second write begins anew, and a file that is seen twice shows."""
    pings = ping_at(spark, *[f"10:{m:02d}:00" for m in range(40)]).repartition(3)
    rides = topics.topic_records(rows.rides(spark, {}, {"ride_id": "r2"}), RIDES, timed=True)
    topics.write_topics(pings.withColumn("sent_at", F.lit(None).cast("timestamp")).unionByName(rides), folder)
    topics.write_topics(rides, folder)
    stored_records = topics.read_topic_files_batch(spark, folder)
    found = {r["topic"]: (r["n_records"], r["n_by_place"], r["whole"]) for r in topics.topic_places(stored_records).collect()}
    assert found == {LOCATIONS.name: (40, 40, True), RIDES.name: (4, 4, True)}
    twice = topics.topic_places(stored_records.unionByName(stored_records.filter("offset = 1"))).collect()
    assert not {r["topic"]: r["whole"] for r in twice}[LOCATIONS.name]
    assert str(stored_records.filter(F.col("topic") == RIDES.name).first()["sent_at"]) == "2024-01-07 10:15:00"


def test_counting_and_tail_do_not_sort_or_parse(spark, sf_dir):
    from kerbside.plans.catalogue import QUERIES
    counts, tail = (QUERIES[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString() for n in ("topic_counts", "topic_tail"))
    for plan in (counts, tail):
        assert "rangepartitioning" not in plan and "Sort [" not in plan
    assert "json" not in counts and "TakeOrderedAndProject" in tail
