"""The same queries as SQL for DuckDB over the same tables, to check results against."""

from __future__ import annotations

# Fixed values, written out here a second time so that a wrong one in the engine does not pass: the columns of the
# feeds by type, keys, keyed tables, surge by hour of day, and the closing time of updated rides.
TIMES = {"request_time", "pickup_time", "dropoff_time", "event_timestamp"}
FEED_COLUMNS = {
    "ride_events": ["ride_id", "rider_id", "driver_id", "city", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng",
                    "request_time", "pickup_time", "dropoff_time", "ride_status", "fare_amount", "surge_multiplier",
                    "distance_miles", "duration_minutes", "payment_type", "event_timestamp"],
    "driver_location_events": ["event_id", "driver_id", "city", "lat", "lng", "availability_status", "event_timestamp"],
    "payment_events": ["payment_id", "ride_id", "payment_status", "amount", "currency", "payment_method",
                       "event_timestamp"],
    "cancellation_events": ["cancellation_id", "ride_id", "cancelled_by", "reason", "event_timestamp"],
}
TOPIC_RIDES = ["ride_id", "rider_id", "driver_id", "city", "ride_status", "fare_amount", "surge_multiplier",
               "distance_miles", "duration_minutes", "payment_type"]
KEYS = {"ride_events": "ride_id", "driver_location_events": "event_id", "payment_events": "payment_id",
        "cancellation_events": "cancellation_id"}
TOPIC_KEYS = {"ride_events": "ride_id", "driver_location_events": "driver_id", "payment_events": "ride_id",
              "cancellation_events": "ride_id"}
KEYED = {"rides": "ride_events", "driver_locations": "driver_location_events", "payments": "payment_events",
         "cancellations": "cancellation_events"}
SURGE = [1.5, 1.8, 2.0, 1.5, 1.2, 1.0, 1.2, 1.8, 2.5, 1.5, 1.0, 1.0, 1.2, 1.0, 1.0, 1.2, 1.5, 2.0, 2.5, 2.0, 1.5, 1.5, 1.8, 2.0]
CLOSED_AT = "2024-03-01 00:00:00"

CITY = """CASE {0} % 8 WHEN 0 THEN 'New York' WHEN 1 THEN 'San Francisco' WHEN 2 THEN 'Chicago'
      WHEN 3 THEN 'Los Angeles' WHEN 4 THEN 'Miami' WHEN 5 THEN 'Seattle' WHEN 6 THEN 'Austin' ELSE 'Boston' END"""
SECONDS = "INTERVAL '1' SECOND * ({0})"


def total(x: str, places: int = 4) -> str:
    """The exact sum of values of at most so many decimals."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38, {places}))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / nullif(count({x}), 0))"


def mean_of_means(x: str) -> str:
    """Means have no last decimal, so their sum has no exact value: what exceeds four decimals is added apart."""
    units = f"CAST({x} AS DECIMAL(38, 4))"
    rest = f"sum({x} - CAST({units} AS DOUBLE))"
    return f"((CAST(sum({units}) AS DOUBLE) + {rest}) / nullif(count({x}), 0))"


def rounded(x: str, places: int) -> str:
    """Half up on the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


def degrees(factor: int, limit: int) -> str:
    return f"CAST(event_id * {factor} % {2000 * limit + 1} - {1000 * limit} AS DOUBLE) / 1000"


def latest(source: str, key: str, ties: str) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in ties.split())
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY event_timestamp DESC NULLS LAST, {order}) AS rn FROM {source}) ranked WHERE rn = 1")


CTES = {
    "ride_raw": f"""
  SELECT event_id, concat('ride_', event_id) AS ride_id, concat('rider_', user_id) AS rider_id,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE concat('driver_', regexp_extract(props, '([0-9]+)', 1)) END AS driver_id,
    {CITY.format('user_id')} AS city,
    {degrees(37, 90)} AS pickup_lat, {degrees(73, 180)} AS pickup_lng,
    {degrees(41, 90)} AS dropoff_lat, {degrees(79, 180)} AS dropoff_lng,
    ts AS request_time,
    ts + {SECONDS.format('event_id % 420 + 60')} AS pickup_time,
    CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE ts + {SECONDS.format('event_id % 3600 + 60')} END AS dropoff_time,
    CASE event_type WHEN 'error' THEN 'cancelled'
      WHEN 'signup' THEN CASE WHEN event_id % 41 = 0 THEN 'unknown' ELSE 'in_progress' END
      ELSE 'completed' END AS ride_status,
    CASE WHEN event_type IN ('error', 'signup') THEN NULL WHEN event_id % 47 = 0 THEN -1.0 * value ELSE value END AS fare_amount,
    CAST(100 + event_id % 11 * 15 AS DOUBLE) / 100 AS surge_multiplier,
    CASE WHEN event_id % 59 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(50 + event_id * 13 % 2450 AS DOUBLE) / 100 END AS distance_miles,
    CAST(event_id * 17 % 1080 AS DOUBLE) / 10 AS duration_minutes,
    CASE event_id % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'cash' WHEN 2 THEN 'uber_cash' ELSE 'paypal' END AS payment_type,
    ts AS event_timestamp
  FROM events""",
    "ride_events": """
  SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM (
    SELECT * FROM ride_raw
    UNION ALL
    SELECT * REPLACE (fare_amount + 1.0 AS fare_amount, event_timestamp + INTERVAL '1' HOUR AS event_timestamp)
    FROM ride_raw WHERE event_id % 37 = 0) u""",
    "driver_location_events": f"""
  SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM (
    SELECT CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE concat('loc_', l_orderkey, '_', l_linenumber) END AS event_id,
      concat('driver_', l_suppkey) AS driver_id, {CITY.format('l_suppkey')} AS city,
      l_quantity * 2 - 5 AS lat, l_extendedprice % 400 - 180 AS lng,
      CASE l_returnflag WHEN 'A' THEN 'available' WHEN 'R' THEN 'on_trip'
        ELSE CASE WHEN l_partkey % 43 = 0 THEN 'unknown' ELSE 'offline' END END AS availability_status,
      l_shipdate + INTERVAL '1' HOUR * l_linenumber AS event_timestamp
    FROM lineitem) l""",
    "payment_events": f"""
  SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM (
    SELECT concat('pay_', event_id) AS payment_id, ride_id,
      CASE WHEN event_id % 50 < 46 THEN 'success' WHEN event_id % 50 < 48 THEN 'failed'
        WHEN event_id % 50 = 48 THEN 'pending' ELSE 'refunded' END AS payment_status,
      fare_amount AS amount, 'USD' AS currency, payment_type AS payment_method,
      dropoff_time + {SECONDS.format('event_id % 56 + 5')} AS event_timestamp
    FROM ride_events WHERE ride_status = 'completed') p""",
    "cancellation_events": f"""
  SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM (
    SELECT concat('cancel_', event_id) AS cancellation_id, ride_id,
      CASE event_id % 3 WHEN 0 THEN 'rider' WHEN 1 THEN 'driver' ELSE 'system' END AS cancelled_by,
      CASE event_id % 5 WHEN 0 THEN 'rider_cancelled' WHEN 1 THEN 'driver_cancelled' WHEN 2 THEN 'no_driver_available'
        ELSE 'rider_no_show' END AS reason,
      request_time + {SECONDS.format('event_id % 271 + 30')} AS event_timestamp
    FROM ride_events WHERE ride_status = 'cancelled') c""",
    "rides": f"""
  SELECT *, CAST(hour(request_time) AS INTEGER) AS trip_hour,
    CAST(dayofweek(request_time) + 1 AS INTEGER) AS trip_day_of_week,
    surge_multiplier > 1.0 AS is_surge
  FROM ({latest('''(SELECT * FROM ride_events
    WHERE ride_id IS NOT NULL AND rider_id IS NOT NULL AND driver_id IS NOT NULL
      AND ride_status IN ('completed', 'cancelled', 'in_progress')
      AND (ride_status <> 'completed' OR fare_amount > 0)
      AND (distance_miles IS NULL OR distance_miles > 0)) v''', 'ride_id', 'rider_id driver_id fare_amount')}) d""",
    "driver_locations": latest('''(SELECT * FROM driver_location_events
    WHERE driver_id IS NOT NULL AND event_timestamp IS NOT NULL AND lat >= -90 AND lat <= 90
      AND lng >= -180 AND lng <= 180 AND availability_status IN ('available', 'on_trip', 'offline')) v''',
                               'event_id', 'driver_id city lat lng availability_status'),
    "payments": latest('''(SELECT * FROM payment_events WHERE payment_id IS NOT NULL AND ride_id IS NOT NULL
      AND amount > 0 AND payment_status IN ('success', 'failed', 'pending', 'refunded')) v''',
                       'payment_id', 'ride_id payment_status amount'),
    "cancellations": latest('''(SELECT * FROM cancellation_events WHERE cancellation_id IS NOT NULL
      AND ride_id IS NOT NULL AND cancelled_by IN ('rider', 'driver', 'system')) v''',
                            'cancellation_id', 'ride_id reason'),
    "daily_ride_metrics": f"""
  SELECT event_date, city, ride_status, count(ride_id) AS total_rides, {total('fare_amount')} AS total_revenue,
    {mean('fare_amount')} AS avg_fare, {mean('distance_miles')} AS avg_distance_miles,
    {mean('duration_minutes')} AS avg_duration_minutes, {mean('surge_multiplier')} AS avg_surge_multiplier,
    CAST(sum(CAST(is_surge AS INT)) AS BIGINT) AS surge_rides
  FROM rides GROUP BY event_date, city, ride_status""",
    "driver_utilization": f"""
  SELECT *, {rounded('total_duration_minutes / 60', 2)} AS active_hours FROM (
    SELECT event_date, driver_id, count(ride_id) AS completed_trips, {total('fare_amount')} AS total_earnings,
      {mean('fare_amount')} AS avg_fare_per_trip, {total('distance_miles')} AS total_distance_miles,
      {total('duration_minutes')} AS total_duration_minutes
    FROM rides WHERE ride_status = 'completed' GROUP BY event_date, driver_id) u""",
    "city_demand": f"""
  SELECT *, {rounded('CAST(surge_count AS DOUBLE) / total_requests * 100', 2)} AS surge_rate_pct FROM (
    SELECT city, trip_day_of_week, trip_hour, count(ride_id) AS total_requests, {mean('surge_multiplier')} AS avg_surge,
      CAST(sum(CAST(is_surge AS INT)) AS BIGINT) AS surge_count, {mean('fare_amount')} AS avg_fare
    FROM rides GROUP BY city, trip_day_of_week, trip_hour) h""",
    "payment_summary": f"""
  SELECT event_date, payment_method, payment_status, count(payment_id) AS transaction_count,
    {total('amount')} AS total_amount, {mean('amount')} AS avg_amount
  FROM payments GROUP BY event_date, payment_method, payment_status""",
    "cancellation_analysis": """
  SELECT event_date, cancelled_by, reason, count(cancellation_id) AS cancellation_count
  FROM cancellations GROUP BY event_date, cancelled_by, reason""",
    "updates": f"""
  SELECT ride_id, city, 'completed' AS ride_status, {rounded('distance_miles * 2.5 + 2.5', 2)} AS fare_amount,
    TIMESTAMP '{CLOSED_AT}' AS dropoff_time
  FROM rides WHERE ride_status = 'in_progress' ORDER BY ride_id LIMIT 500""",
    "updated_rides": """
  SELECT t.ride_id, t.city, coalesce(s.ride_status, t.ride_status) AS ride_status,
    coalesce(s.fare_amount, t.fare_amount) AS fare_amount, coalesce(s.dropoff_time, t.dropoff_time) AS dropoff_time,
    t.distance_miles, s.ride_id IS NOT NULL AS changed
  FROM rides t LEFT JOIN updates s ON t.ride_id = s.ride_id AND t.city = s.city""",
    "ride_windows": f"""
  SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end, city, ride_status,
    count(ride_id) AS ride_count, {total('fare_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
    {mean('surge_multiplier')} AS avg_surge, {mean('distance_miles')} AS avg_distance
  FROM ride_events WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, city, ride_status""",
    "driver_availability": """
  SELECT time_bucket(INTERVAL '1 minute', event_timestamp) AS window_start, city, availability_status,
    count(driver_id) AS driver_count
  FROM driver_location_events WHERE event_timestamp IS NOT NULL GROUP BY 1, city, availability_status""",
    "payment_rates": f"""
  SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end, payment_method,
    payment_status, count(payment_id) AS txn_count, {total('amount')} AS total_amount, {mean('amount')} AS avg_amount
  FROM payment_events WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, payment_method, payment_status""",
    "cancellation_breakdown": """
  SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end, cancelled_by, reason,
    count(cancellation_id) AS cancellation_count
  FROM cancellation_events WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, cancelled_by, reason""",
    "ride_monitor": f"""
  SELECT time_bucket(INTERVAL '1 minute', event_timestamp) AS "minute", city, count(ride_id) AS requests,
    {rounded(mean('surge_multiplier'), 2)} AS avg_surge
  FROM ride_events WHERE event_timestamp IS NOT NULL GROUP BY 1, city""",
}

PRELUDE = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())

# The stream tables, and the feed behind each.
STREAMS = {"ride_windows": "ride_events", "driver_availability": "driver_location_events",
           "payment_rates": "payment_events", "cancellation_breakdown": "cancellation_events"}
GOLD_TABLES = {"daily_ride_metrics": "daily_ride_metrics", "driver_utilization": "driver_utilization",
               "city_demand_heatmap": "city_demand", "payment_summary": "payment_summary",
               "cancellation_analysis": "cancellation_analysis"}


def columns(feed: str) -> str:
    return ", ".join(FEED_COLUMNS[feed])


def text_of(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f')" if column in TIMES else f"CAST({column} AS VARCHAR)"


def json_of(feed: str) -> str:
    """A JSON object of text members, written out by hand."""
    members = [f"""'"{c}":' || coalesce('"' || {text_of(c)} || '"', 'null')""" for c in FEED_COLUMNS[feed]]
    return "'{' || " + " || ',' || ".join(members) + " || '}'"


def counted(tables: dict[str, str], extra: str = "") -> str:
    """Rows per table, for name -> source."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS n_rows{extra} FROM {source}" for name, source in tables.items())


def closed(table: str, delay: str = "10 minutes") -> str:
    """Rows of a window table whose window ended some time before the last event."""
    length = "1 minute" if table == "driver_availability" else "5 minutes"
    return (f"SELECT * FROM {table} WHERE window_start + INTERVAL '{length}' <= "
            f"(SELECT max(event_timestamp) FROM {STREAMS[table]}) - INTERVAL '{delay}'")


def records(feed: str) -> str:
    return f"SELECT '{feed}' AS topic, {TOPIC_KEYS[feed]} AS key, {json_of(feed)} AS value, * FROM {feed}"


def histogram(column: str) -> str:
    return f"""
    , v AS (SELECT CAST({column} AS DOUBLE) AS x FROM driver_utilization WHERE {column} IS NOT NULL)
    , b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 40 AS w FROM v)
    SELECT bin, n, lo + bin * w AS bin_start FROM (
      SELECT CAST(CASE WHEN x >= hi THEN CASE WHEN hi > lo THEN 39 ELSE 0 END
                  ELSE least(39, floor((x - lo) / w)) END AS BIGINT) AS bin, count(*) AS n
      FROM v, b GROUP BY 1) h, b"""


def first_latest(order: str) -> str:
    direction = "DESC" if order == "latest" else "ASC"
    return f"""SELECT user_id, ts, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {direction} NULLS LAST, event_id, event_type, value) AS rn
      FROM events) e WHERE rn = 1"""


SURGE_CASE = ("CASE hour(ts) " + " ".join(f"WHEN {h} THEN {s}" for h, s in enumerate(SURGE)) + " END")

RIDE_NUMBER = "CAST(regexp_extract(ride_id, '([0-9]+)', 1) AS BIGINT)"

LATEST = {"ride_windows": ("city", "ride_status", "ride_count"),
          "driver_availability": ("city", "availability_status", "driver_count"),
          "payment_rates": ("payment_method", "payment_status", "txn_count"),
          "cancellation_breakdown": ("cancelled_by", "reason", "cancellation_count")}

PIVOT = ", ".join(f"max(CASE WHEN trip_hour = {h} THEN avg_surge END) AS h{h:02d}" for h in range(24))

CANCELLATION_TEXT = "SELECT " + ", ".join(
    f"{text_of(c)} AS {c}" for c in FEED_COLUMNS["cancellation_events"]) + " FROM cancellation_events"

PAYMENT_RATE = """
    SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
      time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end, payment_method,
      count(payment_id) AS txn_count,
      CAST(sum(CASE WHEN payment_status = 'success' THEN 1 ELSE 0 END) AS DOUBLE) / count(payment_id) AS success_rate,
      CAST(sum(CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END) AS DOUBLE) / count(payment_id) AS failure_rate
    FROM payment_events WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, payment_method"""

FIRST_DRIVER = "(SELECT min(driver_id) FROM driver_locations)"

# Rides after the updates, without the cancelled ones of one city.
CHANGED = """
    , c AS (SELECT * FROM updated_rides WHERE NOT (ride_status = 'cancelled' AND city = 'Miami'))
    SELECT t.ride_id, CASE WHEN c.ride_id IS NULL THEN 'delete' ELSE 'update' END AS change,
      t.ride_status AS old_ride_status, t.fare_amount AS old_fare_amount,
      c.ride_status AS new_ride_status, c.fare_amount AS new_fare_amount
    FROM rides t LEFT JOIN c ON t.ride_id = c.ride_id WHERE c.ride_id IS NULL OR c.changed"""

BODIES = {
    "bronze_rides": f"SELECT {columns('ride_events')}, event_date FROM ride_events",
    "bronze_locations": f"SELECT {columns('driver_location_events')}, event_date FROM driver_location_events",
    "bronze_payments": f"SELECT {columns('payment_events')}, event_date FROM payment_events",
    "bronze_cancellations": f"SELECT {columns('cancellation_events')}, event_date FROM cancellation_events",
    "silver_rides": "SELECT * EXCLUDE (event_id) FROM rides",
    "silver_locations": "SELECT * FROM driver_locations",
    "silver_payments": "SELECT * FROM payments",
    "silver_cancellations": "SELECT * FROM cancellations",
    "gold_daily_ride_metrics": "SELECT * FROM daily_ride_metrics",
    "ride_reports": f"""
    SELECT event_date, city, ride_status, driver_id, trip_day_of_week, trip_hour,
      CASE WHEN GROUPING(trip_hour) = 0 THEN 'city_demand_heatmap' WHEN GROUPING(driver_id) = 0 THEN 'driver_utilization'
        ELSE 'daily_ride_metrics' END AS report,
      count(ride_id) AS total_rides, {total('fare_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
      {mean('distance_miles')} AS avg_distance_miles, {mean('duration_minutes')} AS avg_duration_minutes,
      {mean('surge_multiplier')} AS avg_surge_multiplier, CAST(sum(CAST(is_surge AS INT)) AS BIGINT) AS surge_rides,
      count(trip) AS completed_trips, {total('fare')} AS total_earnings, {mean('fare')} AS avg_fare_per_trip,
      {total('miles')} AS total_distance_miles, {total('minutes')} AS total_duration_minutes
    FROM (SELECT *, CASE WHEN ride_status = 'completed' THEN ride_id END AS trip,
        CASE WHEN ride_status = 'completed' THEN fare_amount END AS fare,
        CASE WHEN ride_status = 'completed' THEN distance_miles END AS miles,
        CASE WHEN ride_status = 'completed' THEN duration_minutes END AS minutes FROM rides) r
    GROUP BY GROUPING SETS ((event_date, city, ride_status), (event_date, driver_id), (city, trip_day_of_week, trip_hour))""",
    "gold_driver_utilization": "SELECT * FROM driver_utilization",
    "gold_city_demand": "SELECT * FROM city_demand",
    "gold_payment_summary": "SELECT * FROM payment_summary",
    "gold_cancellation_analysis": "SELECT * FROM cancellation_analysis",
    "bronze_roundtrip": f"SELECT {columns('ride_events')}, event_date FROM ride_events",
    "gold_roundtrip": """SELECT *, CAST(row_number() OVER (PARTITION BY event_date
      ORDER BY city NULLS FIRST, ride_status NULLS FIRST) AS INTEGER) AS place FROM daily_ride_metrics""",
    "layer_counts": "SELECT * FROM (" + "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS \"table\", count(*) AS n_rows FROM {source}"
        for layer, tables in (("bronze", {f: f for f in KEYS}),
                              ("silver", {f: t for t, f in KEYED.items()}), ("gold", GOLD_TABLES))
        for name, source in tables.items()) + ") c",
    "dedup_latest": first_latest("latest"),
    "dedup_first": first_latest("first"),
    "sort_mixed": """SELECT *, CAST(row_number() OVER (PARTITION BY event_date ORDER BY cancellation_count DESC,
      cancelled_by NULLS FIRST, reason NULLS FIRST) AS INTEGER) AS place FROM cancellation_analysis""",
    "union_events": "\nUNION ALL ".join(
        f"SELECT '{name}' AS feed, {key} AS id, event_timestamp FROM {name}" for name, key in KEYS.items()),
    "csv_roundtrip": "SELECT " + ", ".join(
        f"{text_of(c)} AS {c}" for c in FEED_COLUMNS["payment_events"]) + " FROM payment_events",
    "json_scan": CANCELLATION_TEXT,
    "json_array": CANCELLATION_TEXT,
    "scan_or_empty": counted({"payment_events": "payment_events",
                              "missing_events": "(SELECT 1 WHERE false) e"}),
    "validate_inputs": "SELECT *, CASE WHEN n_rows > 0 THEN 'ok' ELSE 'empty' END AS status FROM ("
                       + counted({f: f for f in KEYS}) + ") c",
    "validate_outputs": "SELECT *, CASE WHEN n_rows > 0 THEN 'ok' ELSE 'empty' END AS status FROM ("
                        + counted(GOLD_TABLES) + ") c",
    "topic_records": f"SELECT topic, key, value FROM ({records('ride_events')}) r",
    "parse_topic": "SELECT " + ", ".join(TOPIC_RIDES)
                   + ", event_timestamp AS event_ts FROM ride_events",
    "topic_tail": "SELECT topic, key, event_time AS event_timestamp FROM ("
                  "SELECT *, row_number() OVER (PARTITION BY topic ORDER BY event_time NULLS LAST, key, value) AS rn "
                  "FROM ("
                  + "\nUNION ALL ".join(
                      f"SELECT topic, key, value, {text_of('event_timestamp')} AS event_time FROM ({records(f)}) r"
                      for f in KEYS) + ") a) t WHERE rn <= 3",
    "topic_counts": "\nUNION ALL ".join(f"SELECT '{f}' AS topic, count(*) AS n_records FROM {f}" for f in KEYS),
    "topic_places": "\nUNION ALL ".join(
        f"SELECT '{f}' AS topic, count(*) AS n_records, count(*) AS n_by_place, true AS whole FROM {f}" for f in KEYS),
    "topic_limit": f"SELECT topic, key, value FROM ({records('payment_events')}) r ORDER BY key, value LIMIT 500",
    "fare_quote": "SELECT ride_id, event_timestamp, " + rounded(
        "(2.5 + 1.25 * distance_miles + 0.25 * (distance_miles / 15 * 60)) * surge_multiplier", 2)
        + " AS quote FROM ride_events",
    "surge_lookup": "SELECT event_id, " + rounded(
        f"greatest(CAST(1 AS DOUBLE), CAST({SURGE_CASE} AS DOUBLE) + CAST(event_id % 31 - 10 AS DOUBLE) / 100)", 2)
        + " AS surge FROM events",
    "derive_payments": f"""
    SELECT concat('pay_', {RIDE_NUMBER}) AS payment_id, ride_id, 'success' AS payment_status, fare_amount AS amount,
      'USD' AS currency, payment_type AS payment_method,
      dropoff_time + {SECONDS.format(RIDE_NUMBER + ' % 56 + 5')} AS event_timestamp
    FROM rides WHERE ride_status = 'completed'""",
    "derive_cancellations": f"""
    SELECT concat('cancel_', {RIDE_NUMBER}) AS cancellation_id, ride_id, 'rider' AS cancelled_by,
      'rider_cancelled' AS reason, request_time + {SECONDS.format(RIDE_NUMBER + ' % 271 + 30')} AS event_timestamp
    FROM rides WHERE ride_status = 'cancelled'""",
    "merge_payload": "SELECT * FROM updates",
    "merge_update": "SELECT ride_id, city, ride_status, fare_amount, dropoff_time, distance_miles FROM updated_rides",
    "delete_where": """SELECT event_id, driver_id, city FROM driver_locations
    WHERE NOT coalesce(driver_id = (SELECT min(driver_id) FROM driver_locations), FALSE)""",
    "delete_audit": """SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after, count(*) AS n_deleted
    FROM driver_locations WHERE driver_id = (SELECT min(driver_id) FROM driver_locations)""",
    "table_current": "SELECT ride_id, city, ride_status, fare_amount, dropoff_time FROM updated_rides",
    "time_travel": """SELECT *, in_progress_then - in_progress_now AS n_updated FROM (
    SELECT (SELECT count(*) FROM rides WHERE ride_status = 'in_progress') AS in_progress_then,
      (SELECT count(*) FROM updated_rides WHERE ride_status = 'in_progress') AS in_progress_now) c""",
    "time_travel_ts": "SELECT ride_id, city, ride_status, fare_amount FROM rides",
    "table_history": """SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS n_rows_written FROM rides
    UNION ALL SELECT 1, 'MERGE', count(*) FROM updated_rides WHERE changed""",
    "table_delete": f"""SELECT event_id, driver_id, city FROM driver_locations
    WHERE NOT coalesce(driver_id = {FIRST_DRIVER}, FALSE)""",
    "table_delete_audit": f"""SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after, count(*) AS n_deleted
    FROM driver_locations WHERE driver_id = {FIRST_DRIVER}""",
    "table_delete_history": f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS n_rows_written,
      CAST(NULL AS VARCHAR) AS predicate FROM driver_locations
    UNION ALL SELECT 1, 'DELETE', count(*), concat('driver_id = ''', min(driver_id), '''')
    FROM driver_locations WHERE driver_id = {FIRST_DRIVER}""",
    "change_feed_deletes": CHANGED,
    "change_feed_versions": CHANGED + """
    UNION ALL SELECT concat('new_', ride_id), 'insert', NULL, NULL, ride_status, fare_amount
    FROM rides WHERE ride_status = 'completed' AND city = 'Boston'""",
    "change_feed": """SELECT t.ride_id, 'update' AS change, t.ride_status AS old_ride_status,
      t.fare_amount AS old_fare_amount, u.ride_status AS new_ride_status, u.fare_amount AS new_fare_amount
    FROM rides t JOIN updated_rides u ON t.ride_id = u.ride_id WHERE u.changed""",
    "change_feed_raw": """
    , o AS (SELECT ride_id, city, ride_status, fare_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY event_timestamp) AS rn
        FROM ride_events WHERE ride_status <> 'in_progress') f WHERE rn = 1)
    SELECT coalesce(n.ride_id, o.ride_id) AS ride_id,
      CASE WHEN o.ride_id IS NULL THEN 'insert' WHEN n.ride_id IS NULL THEN 'delete' ELSE 'update' END AS change,
      o.ride_status AS old_ride_status, o.fare_amount AS old_fare_amount,
      n.ride_status AS new_ride_status, n.fare_amount AS new_fare_amount
    FROM o FULL JOIN rides n ON o.ride_id = n.ride_id
    WHERE o.ride_id IS NULL OR n.ride_id IS NULL OR o.city IS DISTINCT FROM n.city
      OR o.ride_status IS DISTINCT FROM n.ride_status OR o.fare_amount IS DISTINCT FROM n.fare_amount""",
    "schema_enforce": "SELECT * FROM payments",
    "table_counts": counted({t: t for t in KEYED}),
    "table_preview": "SELECT * FROM payments ORDER BY payment_id LIMIT 50",
    "kpi_summary": f"""
    SELECT *, CAST(cancellations AS DOUBLE) / total_rides * 100 AS cancellation_rate_pct FROM (
      SELECT count(*) AS total_rides, {total('fare_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
        {mean('surge_multiplier')} AS avg_surge, (SELECT count(*) FROM payments) AS payment_events,
        (SELECT count(*) FROM driver_locations) AS driver_pings, (SELECT count(*) FROM cancellations) AS cancellations
      FROM rides) k""",
    "city_revenue": f"""SELECT city, {rounded('coalesce(' + total('total_revenue') + ', 0)', 0)} AS total_revenue
    FROM daily_ride_metrics WHERE ride_status = 'completed' AND city IS NOT NULL GROUP BY city""",
    "rides_by_status": """SELECT ride_status, CAST(sum(total_rides) AS BIGINT) AS total_rides
    FROM daily_ride_metrics GROUP BY ride_status""",
    "avg_fare_by_city": f"""SELECT city, {mean_of_means('avg_fare')} AS avg_fare
    FROM daily_ride_metrics WHERE ride_status = 'completed' AND city IS NOT NULL GROUP BY city""",
    "surge_heatmap": f"SELECT city, trip_hour, {mean_of_means('avg_surge')} AS avg_surge FROM city_demand GROUP BY city, trip_hour",
    "surge_heatmap_pivot": f"""SELECT city, {PIVOT} FROM (
      SELECT city, trip_hour, {mean_of_means('avg_surge')} AS avg_surge FROM city_demand GROUP BY city, trip_hour) p
    GROUP BY city""",
    "peak_surge_hours": f"""SELECT *, avg_surge > 1.5 AS is_high FROM (
      SELECT trip_hour, {mean_of_means('avg_surge')} AS avg_surge FROM city_demand GROUP BY trip_hour) h""",
    "payments_by_method": """SELECT payment_method, CAST(sum(transaction_count) AS BIGINT) AS transaction_count
    FROM payment_summary WHERE payment_method IS NOT NULL GROUP BY payment_method""",
    "payments_by_status": """SELECT payment_status, CAST(sum(transaction_count) AS BIGINT) AS transaction_count
    FROM payment_summary GROUP BY payment_status""",
    "trips_histogram": histogram("completed_trips"),
    "earnings_histogram": histogram("total_earnings"),
    "top_drivers": f"""SELECT concat(substring(driver_id, 1, 20), '...') AS driver,
      {rounded('t', 2)} AS total_earnings FROM (
      SELECT driver_id, {total('total_earnings')} AS t FROM driver_utilization GROUP BY driver_id
      ORDER BY t DESC, driver_id LIMIT 10) d""",
    "sql_top_revenue_city": f"""SELECT city, {total('fare_amount')} AS total_revenue FROM rides
    WHERE ride_status = 'completed' GROUP BY city ORDER BY total_revenue DESC, city LIMIT 1""",
    "sql_cancel_pct": "SELECT city, " + rounded(
        "CAST(100 * sum(CASE WHEN ride_status = 'cancelled' THEN 1 ELSE 0 END) AS DOUBLE) / count(*)", 1)
        + " AS cancelled_pct FROM rides GROUP BY city ORDER BY cancelled_pct DESC, city LIMIT 20",
    "sql_peak_hour": f"""SELECT trip_hour, {mean('surge_multiplier')} AS avg_surge FROM rides
    GROUP BY trip_hour ORDER BY avg_surge DESC, trip_hour LIMIT 1""",
    "sql_cancel_reasons": """SELECT reason, cancelled_by, count(*) AS n FROM cancellations
    GROUP BY GROUPING SETS ((reason), (cancelled_by))""",
    "sql_top_methods": """SELECT payment_method, count(payment_id) AS transaction_count FROM payments
    GROUP BY payment_method ORDER BY transaction_count DESC, payment_method LIMIT 5""",
    "sql_available_city": """SELECT city, CAST(sum(n) AS DOUBLE) / count(*) AS avg_available FROM (
      SELECT event_date, city, count(DISTINCT driver_id) AS n FROM driver_locations
      WHERE availability_status = 'available' GROUP BY event_date, city) d
    GROUP BY city ORDER BY avg_available DESC, city LIMIT 1""",
    "sql_available_distinct": """SELECT city, count(DISTINCT driver_id) AS drivers FROM driver_locations
    WHERE availability_status = 'available' GROUP BY city ORDER BY drivers DESC, city LIMIT 20""",
    "sql_top_revenue_city_any_status": f"""SELECT city, {total('fare_amount')} AS total_revenue FROM rides
    GROUP BY city ORDER BY total_revenue DESC, city LIMIT 1""",
    "run_query": "SELECT driver_id, count(*) AS n FROM rides GROUP BY driver_id ORDER BY n DESC, driver_id LIMIT 20",
    "window_rides": "SELECT * FROM ride_windows",
    "window_availability": "SELECT * FROM driver_availability",
    "window_payments": "SELECT * FROM payment_rates",
    "window_cancellations": "SELECT * FROM cancellation_breakdown",
    "window_monitor": "SELECT * FROM ride_monitor",
    "payment_rate": PAYMENT_RATE,
    "stream_payment_rate": f"""SELECT * FROM ({PAYMENT_RATE}) r WHERE window_end <=
      (SELECT max(event_timestamp) FROM payment_events) - INTERVAL '10 minutes'""",
    "stream_city_totals": f"""SELECT city, CAST(sum(ride_count) AS BIGINT) AS ride_count
    FROM ({closed('ride_windows')}) w WHERE city IS NOT NULL GROUP BY city""",
    "latest_windows": "\nUNION ALL ".join(
        f"SELECT * FROM (SELECT '{t}' AS stream_table, window_start, {a} AS first_key, {b} AS second_key, {n} AS n "
        f"FROM ({closed(t)}) w ORDER BY window_start DESC, {a}, {b} LIMIT 20) l{i}" for i, (t, (a, b, n)) in enumerate(LATEST.items())),
    "stream_rides": closed("ride_windows"),
    "stream_availability": closed("driver_availability"),
    "stream_payments": closed("payment_rates"),
    "stream_cancellations": closed("cancellation_breakdown"),
    "stream_ride_monitor": "SELECT * FROM ride_monitor",
    "stream_restart": closed("ride_windows"),
    "stream_late": closed("ride_windows"),
    "stream_crash_restart": closed("ride_windows"),
    "stream_more_partitions": closed("ride_windows"),
    "stream_redelivered": closed("ride_windows", "2 days"),
    "stream_all": counted({t: f"({closed(t)}) c" for t in STREAMS}),
}

ORACLE = {name: f"{PRELUDE}\n{body}" for name, body in BODIES.items()}
