"""The same questions in SQL, for DuckDB over the same tables.

Every text starts with common table expressions that rebuild the inputs and layers from the given
tables; a query names only the ones it needs.
"""

from __future__ import annotations


def cents(value: str) -> str:
    """``value`` (double) rounded half up to two decimals as written, as a double."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


def total(value: str, kind: str = "DECIMAL(18,2)") -> str:
    """The exact sum of what the values are as written, as a double."""
    return f"CAST(SUM(CAST(CAST({value} AS VARCHAR) AS {kind})) AS DOUBLE)"


def mean(value: str, kind: str = "DECIMAL(18,2)") -> str:
    return cents(f"({total(value, kind)} / COUNT({value}))")


DISTANCE = "DECIMAL(38,20)"

_TRIPS = """
base AS (
  SELECT *, CASE WHEN l_partkey % 101 <> 7 THEN l_shipdate + to_seconds(
    CASE WHEN l_partkey % 499 = 3 THEN 0 WHEN l_partkey % 499 = 4 THEN 13880 ELSE 8401 END * 86400
    + ((l_orderkey * 37 + l_linenumber * 211) % 1440) * 60 + l_partkey % 60) END AS pickup
  FROM lineitem),
trips AS (
  SELECT
    l_suppkey % 2 + 1 AS "VendorID",
    pickup AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 103 = 9 THEN NULL WHEN l_partkey % 107 = 11 THEN pickup
         ELSE pickup + to_seconds(CAST(l_quantity * 47 AS BIGINT) + l_suppkey % 60) END AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 109 <> 13
      THEN CAST(l_linenumber - CASE WHEN l_partkey % 113 = 1 THEN 7 ELSE 0 END AS DOUBLE) END AS passenger_count,
    CASE WHEN l_partkey % 139 = 17 THEN NULL WHEN l_partkey % 127 = 2 THEN 0 WHEN l_partkey % 127 = 5 THEN 500
      ELSE l_quantity / 4 + CASE WHEN l_partkey % 97 = 5 THEN l_linenumber * CAST(4e-7 AS DOUBLE) ELSE 0 END END AS trip_distance,
    l_suppkey AS "PULocationID",
    l_partkey % 265 AS "DOLocationID",
    CASE WHEN l_partkey % 151 = 22 THEN NULL WHEN l_partkey % 131 = 6 THEN -l_extendedprice
      ELSE l_extendedprice / 20 END AS fare_amount,
    CASE WHEN l_partkey % 163 <> 24 THEN l_extendedprice / 20 * l_discount END AS tip_amount,
    CASE WHEN l_partkey % 157 = 23 THEN NULL WHEN l_partkey % 137 = 8 THEN 0 ELSE l_extendedprice / 20 * (1 + l_discount) + l_tax * 100 END AS total_amount,
    CASE WHEN l_orderkey % 167 <> 25 THEN l_orderkey % 6 END AS payment_type,
    l_tax * 100 AS tolls_amount,
    CAST(year(l_shipdate + to_days(8401)) AS INTEGER) AS "year",
    CAST(month(l_shipdate + to_days(8401)) AS INTEGER) AS "month"
  FROM base),
tagged AS (
  SELECT *, CASE WHEN dq_reject_reason IS NULL THEN 'VALID' ELSE 'REJECTED' END AS dq_status
  FROM (SELECT *, CASE
      WHEN passenger_count IS NULL OR passenger_count < 1 OR passenger_count > 6 THEN 'invalid_passenger_count'
      WHEN trip_distance IS NULL OR trip_distance <= 0 OR trip_distance >= 500 THEN 'invalid_trip_distance'
      WHEN fare_amount IS NULL OR fare_amount <= 0 OR fare_amount >= 10000 THEN 'invalid_fare_amount'
      WHEN total_amount IS NULL OR total_amount <= 0 THEN 'invalid_total_amount'
      WHEN tpep_pickup_datetime IS NULL THEN 'null_pickup_datetime'
      WHEN tpep_dropoff_datetime IS NULL THEN 'null_dropoff_datetime'
      WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 'dropoff_before_pickup'
      WHEN year(tpep_pickup_datetime) < 2009 THEN 'pickup_year_too_old'
      WHEN year(tpep_pickup_datetime) > 2030 THEN 'pickup_year_future' END AS dq_reject_reason
    FROM trips)),
valid AS (SELECT * FROM tagged WHERE dq_status = 'VALID'),
"""

_SILVER = f"""
silver AS (
  SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime,
    CAST(trunc(passenger_count) AS INTEGER) AS passenger_count, trip_distance, "PULocationID", "DOLocationID",
    {cents("fare_amount")} AS fare_amount, {cents("tip_amount")} AS tip_amount,
    {cents("total_amount")} AS total_amount, payment_type, {cents("tolls_amount")} AS tolls_amount,
    "year", "month",
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
    {cents("((epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime))) / CAST(60 AS DOUBLE))")}
      AS trip_duration_minutes
  FROM valid),
"""

_GOLD = f"""
daily AS (
  SELECT pickup_date, pickup_year, pickup_month, COUNT(*) AS total_trips,
    CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
    {mean("fare_amount")} AS avg_fare, {cents(total("fare_amount"))} AS total_fare,
    {mean("tip_amount")} AS avg_tip, {cents(total("tip_amount"))} AS total_tip,
    {mean("trip_distance", DISTANCE)} AS avg_distance, {cents(total("trip_distance", DISTANCE))} AS total_distance,
    {mean("trip_duration_minutes")} AS avg_duration_minutes, {cents(total("total_amount"))} AS total_revenue
  FROM silver GROUP BY pickup_date, pickup_year, pickup_month),
hourly AS (
  SELECT pickup_year, pickup_month, pickup_hour, COUNT(*) AS total_trips, {mean("fare_amount")} AS avg_fare,
    {mean("trip_distance", DISTANCE)} AS avg_distance, {mean("trip_duration_minutes")} AS avg_duration_minutes,
    {cents(total("total_amount"))} AS total_revenue
  FROM silver GROUP BY pickup_year, pickup_month, pickup_hour),
location AS (
  SELECT "PULocationID", COUNT(*) AS total_trips, {mean("fare_amount")} AS avg_fare,
    {mean("trip_distance", DISTANCE)} AS avg_distance, {mean("trip_duration_minutes")} AS avg_duration_minutes,
    {cents(total("total_amount"))} AS total_revenue, {mean("tip_amount")} AS avg_tip
  FROM silver GROUP BY "PULocationID"),
payment AS (
  SELECT payment_type, COUNT(*) AS total_trips, {mean("fare_amount")} AS avg_fare, {mean("tip_amount")} AS avg_tip,
    {cents(total("total_amount"))} AS total_revenue, {cents("MAX(fare_amount)")} AS max_fare,
    {cents("MIN(fare_amount)")} AS min_fare
  FROM silver GROUP BY payment_type),
"""

_EVENTS = """
run_events AS (
  SELECT event_id, ts,
    CASE user_id % 3 WHEN 0 THEN 'bronze-job' WHEN 1 THEN 'silver-job' ELSE 'gold-job' END AS job_name,
    CASE WHEN event_type IN ('purchase', 'view') THEN 'SUCCEEDED' WHEN event_type = 'error' THEN 'FAILED'
         WHEN event_type = 'click' THEN 'STOPPED' ELSE 'RUNNING' END AS state,
    CAST(user_id AS VARCHAR) AS job_run_id,
    CASE WHEN event_id % 2 = 1 THEN 'event ' || event_id ELSE '' END AS message,
    '' AS started_on, '' AS completed_on,
    strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' AS event_time
  FROM events),
audit_table AS (
  SELECT * FROM run_events
  QUALIFY row_number() OVER (PARTITION BY job_run_id, event_time ORDER BY event_id DESC) = 1),
"""

_METRICS = """
metrics AS (
  SELECT ts, event_type = 'error' AS is_error, event_id % 4 AS rule,
    CASE event_id % 4
      WHEN 0 THEN CASE user_id % 3 WHEN 0 THEN 'bronze-job' WHEN 1 THEN 'silver-job' ELSE 'gold-job' END
      WHEN 1 THEN CASE user_id % 3 WHEN 0 THEN 'audit-logger' WHEN 1 THEN 'notifier' ELSE 'metadata-validator' END
      WHEN 2 THEN 'trip-audit' ELSE 'trip-run' END AS dimension,
    CASE event_id % 4 WHEN 0 THEN 'failure-alarm' WHEN 1 THEN 'error-alarm' WHEN 2 THEN 'system-errors'
      ELSE 'failed-alarm' END AS suffix,
    CASE WHEN event_id % 4 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 1 MINUTE END AS period
  FROM events),
fired AS (
  SELECT rule, dimension || '-' || suffix AS alarm, dimension, time_bucket(period, ts) AS window_start,
    time_bucket(period, ts) + period AS window_end, CAST(COUNT(*) AS DOUBLE) AS total
  FROM metrics WHERE is_error GROUP BY rule, suffix, dimension, period, time_bucket(period, ts)),
"""

# The same sums over longer periods; an alarm ends a run of breaching windows.
_LONG = """
long_rules(rule, seconds, periods, threshold) AS (VALUES (0, 3600, 1, 2), (1, 10800, 2, 1), (2, 10800, 3, 1), (3, 10800, 2, 2)),
breached AS (
  SELECT dimension || '-' || suffix AS alarm, dimension, seconds, periods,
    time_bucket(to_seconds(seconds), ts) AS window_start, CAST(COUNT(*) FILTER (is_error) AS DOUBLE) AS total
  FROM metrics JOIN long_rules USING (rule)
  GROUP BY ALL HAVING COUNT(*) FILTER (is_error) >= ANY_VALUE(threshold)),
long_fired AS (
  SELECT last.alarm, last.dimension, last.window_start, last.window_start + to_seconds(last.seconds) AS window_end, last.total
  FROM breached last JOIN breached one ON one.alarm = last.alarm AND one.window_start <= last.window_start
    AND one.window_start > last.window_start - to_seconds(last.seconds * last.periods)
  GROUP BY last.alarm, last.dimension, last.window_start, last.seconds, last.periods, last.total
  HAVING COUNT(*) = last.periods),
"""
_CLOSED = "window_end <= (SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 10 MINUTE FROM metrics)"

_FILES = """
files AS (
  SELECT doc_id, 'raw-bucket' AS bucket,
    CASE WHEN doc_id % 11 = 3 THEN 'landing/' ELSE 'raw/yellow_tripdata/' END || 'year=2024/f' || doc_id
      || CASE WHEN doc_id % 13 = 5 THEN '.csv' ELSE '.parquet' END AS key,
    n_chars AS size,
    CASE WHEN doc_id % 29 = 7 THEN 0 ELSE CAST(length("text") AS BIGINT) END AS n_rows,
    CASE WHEN doc_id % 37 = 9 THEN 'not a parquet file' END AS read_error
  FROM documents),
required(position, name) AS (VALUES
  (0, 'VendorID'), (1, 'tpep_pickup_datetime'), (2, 'tpep_dropoff_datetime'), (3, 'passenger_count'),
  (4, 'trip_distance'), (5, 'PULocationID'), (6, 'DOLocationID'), (7, 'fare_amount'), (8, 'tip_amount'),
  (9, 'total_amount'), (10, 'payment_type')),
missing AS (
  SELECT doc_id, string_agg('''' || name || '''', ', ' ORDER BY name) AS names
  FROM files, required
  WHERE (doc_id % 19 = 4 AND position = doc_id % 11) OR (doc_id % 23 = 6 AND position = doc_id % 7)
     OR (doc_id % 31 = 8 AND name <> lower(name))
  GROUP BY doc_id),
findings AS (
  SELECT files.*,
    CASE WHEN NOT ends_with(key, '.parquet') THEN 'Invalid extension — expected .parquet, got: ' || key END
      AS extension_error,
    CASE WHEN NOT starts_with(key, 'raw/yellow_tripdata/')
      THEN 'Invalid S3 prefix — expected raw/yellow_tripdata/, got: ' || key END AS prefix_error,
    CASE WHEN size < 1024 THEN 'File too small — ' || size || ' bytes (min: 1024)' END AS size_error,
    CASE WHEN read_error IS NOT NULL THEN 'Column validation failed: ' || read_error
         WHEN n_rows = 0 THEN 'File is empty — no records found'
         WHEN names IS NOT NULL THEN 'Missing columns: [' || names || ']' END AS columns_error
  FROM files LEFT JOIN missing USING (doc_id)),
"""


def _with(parts: str, select: str) -> str:
    return f"WITH {parts.strip().rstrip(',')}\n{select}"


def over_trips(select: str) -> str:
    return _with(_TRIPS, select)


def over_silver(select: str) -> str:
    return _with(_TRIPS + _SILVER, select)


def over_gold(select: str) -> str:
    return _with(_TRIPS + _SILVER + _GOLD, select)


TRIP = (
    '"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "PULocationID", '
    '"DOLocationID", fare_amount, tip_amount, total_amount, payment_type, tolls_amount'
)
LANDED = f'{TRIP}, "year", "month"'
SILVER = f"{LANDED}, pickup_date, pickup_year, pickup_month, pickup_hour, pickup_dayofweek, trip_duration_minutes"
AUDIT = "job_run_id, event_time, job_name, state, message, started_on, completed_on"
REASONS = (
    "invalid_passenger_count", "invalid_trip_distance", "invalid_fare_amount", "invalid_total_amount",
    "null_pickup_datetime", "null_dropoff_datetime", "dropoff_before_pickup", "pickup_year_too_old",
    "pickup_year_future",
)

_METHOD = (
    "CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge' "
    "WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS payment_method"
)
_MONTHS = over_trips('SELECT "year", "month", COUNT(*) AS "rows" FROM trips GROUP BY "year", "month"')
_STAMPED = 'payment_type, COUNT(*) AS "rows", COUNT(*) AS stamped, TRUE AS same_time'
_ROW_COUNTS = over_gold(
    "SELECT 'daily_trip_summary' AS gold_table, COUNT(*) AS row_count FROM daily "
    "UNION ALL SELECT 'hourly_trip_summary', COUNT(*) FROM hourly "
    "UNION ALL SELECT 'location_trip_summary', COUNT(*) FROM location "
    "UNION ALL SELECT 'payment_type_summary', COUNT(*) FROM payment"
)


def _held(layer: str, rows: str) -> str:
    return f"UNION ALL SELECT '{layer}', 'rows', 'run-1', 'HELD', CAST(COUNT(*) AS VARCHAR) FROM {rows} "


_TABLE_COUNTS = over_gold(
    'SELECT gold_table AS table_name, row_count AS "rows" FROM ('
    "SELECT 'daily_trip_summary' AS gold_table, COUNT(*) AS row_count FROM daily "
    "UNION ALL SELECT 'hourly_trip_summary', COUNT(*) FROM hourly "
    "UNION ALL SELECT 'location_trip_summary', COUNT(*) FROM location "
    "UNION ALL SELECT 'payment_type_summary', COUNT(*) FROM payment "
    "UNION ALL SELECT 'silver', COUNT(*) FROM silver)"
)
_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz", "VendorID": "bigint", "PULocationID": "bigint",
    "DOLocationID": "bigint", "payment_type": "bigint", "year": "int", "month": "int",
}
_SCHEMA = over_trips(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"name\", '{_TYPES.get(name, 'double')}' AS type, COUNT(\"{name}\") AS filled, COUNT(*) AS \"rows\" FROM trips"
        for name in LANDED.replace('"', "").split(", ")
    )
)


def _storage() -> dict[str, str]:
    all_trips = over_trips(f"SELECT {LANDED} FROM trips")
    all_silver = over_silver(f"SELECT {SILVER} FROM silver")
    return {
        "scan_raw": all_trips,
        "scan_bronze": all_trips,
        "scan_silver": all_silver,
        "landing_month": over_trips(f'SELECT {LANDED} FROM trips WHERE "year" = 2024 AND "month" = 1'),
        "stream_landing": _MONTHS,
        "schema_report": _SCHEMA,
        "row_count": over_trips('SELECT COUNT(*) AS "rows" FROM trips'),
        "write_bronze": over_trips(f"SELECT {LANDED}, TRUE AS has_time, TRUE AS has_file FROM trips"),
        "write_silver": all_silver,
        "write_reject": over_trips(f"SELECT {LANDED}, dq_status, dq_reject_reason FROM tagged WHERE dq_status = 'REJECTED'"),
        "write_gold_table": over_gold("SELECT * FROM hourly"),
        "save_query_result": over_gold(
            "SELECT pickup_year, pickup_month, CAST(SUM(total_trips) AS BIGINT) AS total_trips FROM daily GROUP BY ALL"
        ),
        "register_raw": _MONTHS,
        "register_silver": over_silver(
            'SELECT pickup_year, pickup_month, COUNT(*) AS "rows" FROM silver GROUP BY pickup_year, pickup_month'
        ),
        "register_gold": _ROW_COUNTS,
        "list_tables": _TABLE_COUNTS,
        "create_database": over_trips("SELECT 'raw' AS table_name, COUNT(*) AS \"rows\" FROM trips"),
        "add_ingestion_time": over_trips(f"SELECT {_STAMPED} FROM trips GROUP BY payment_type"),
        "add_source_file": _MONTHS,
        "bronze": over_trips(f'SELECT {LANDED}, "year" AS source_year FROM trips'),
    }


def _quality_and_silver() -> dict[str, str]:
    rejects = {
        f"dq{position}": over_trips(f"SELECT {LANDED}, dq_reject_reason FROM tagged WHERE dq_reject_reason = '{reason}'")
        for position, reason in enumerate(REASONS, start=1)
    }
    added = {
        name: over_silver(f'SELECT "VendorID", "PULocationID", tpep_pickup_datetime, {columns} FROM silver')
        for name, columns in {
            "pickup_date": "pickup_date",
            "pickup_year": "pickup_year",
            "pickup_month": "pickup_month",
            "pickup_hour": "pickup_hour",
            "pickup_dayofweek": "pickup_dayofweek",
            "trip_duration_minutes": "tpep_dropoff_datetime, trip_duration_minutes",
            "round_money": "fare_amount, tip_amount, tolls_amount, total_amount",
        }.items()
    }
    return {
        **rejects,
        **added,
        "dq_reason": over_trips(f"SELECT {LANDED}, dq_reject_reason FROM tagged"),
        "dq_status": over_trips(
            'SELECT "PULocationID", dq_status, COUNT(*) AS "rows" FROM tagged GROUP BY "PULocationID", dq_status'
        ),
        "valid_rows": over_trips(f"SELECT {LANDED}, dq_status FROM valid"),
        "rejected_rows": over_trips(
            f"SELECT {LANDED}, dq_status, dq_reject_reason FROM tagged WHERE dq_status = 'REJECTED'"
        ),
        "dq_metrics": over_trips(
            "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (dq_status = 'VALID') AS valid_rows, "
            "COUNT(*) FILTER (dq_status = 'REJECTED') AS rejected_rows, "
            + cents("(COUNT(*) FILTER (dq_status = 'REJECTED') * CAST(100 AS DOUBLE) / COUNT(*))")
            + " AS rejection_rate_pct FROM tagged"
        ),
        "rejects_by_reason": over_trips(
            'SELECT dq_reject_reason, COUNT(*) AS "rows" FROM tagged WHERE dq_status = \'REJECTED\' GROUP BY dq_reject_reason'
        ),
        "cast_types": over_trips(
            f"SELECT * REPLACE (CAST(trunc(passenger_count) AS INTEGER) AS passenger_count) FROM (SELECT {TRIP} FROM valid)"
        ),
        "silver_processed_at": over_trips(f"SELECT {_STAMPED} FROM valid GROUP BY payment_type"),
        "drop_dq_columns": over_trips(f"SELECT {LANDED} FROM valid"),
        "silver": over_silver(
            f"SELECT {SILVER}, 'VALID' AS outcome FROM silver UNION ALL BY NAME "
            f"SELECT {LANDED}, dq_reject_reason AS outcome FROM tagged WHERE dq_status = 'REJECTED'"
        ),
    }


def _gold() -> dict[str, str]:
    january = "pickup_year = 2024 AND pickup_month = 1"
    stored = " UNION ALL BY NAME ".join(
        f"SELECT *, '{name}' AS gold_table FROM {source}"
        for name, source in {
            "daily_trip_summary": "daily",
            "hourly_trip_summary": "hourly",
            "location_trip_summary": "location",
            "payment_type_summary": "payment",
        }.items()
    )
    trips = "CAST(SUM(total_trips) AS BIGINT) AS total_trips"
    place = '"PULocationID" AS pulocationid'
    return {
        "daily_trip_summary": over_gold("SELECT * FROM daily"),
        "hourly_trip_summary": over_gold("SELECT * FROM hourly"),
        "location_trip_summary": over_gold("SELECT * FROM location"),
        "payment_type_summary": over_gold("SELECT * FROM payment"),
        "gold": over_gold(stored),
        "gold_refresh": over_gold(stored),
        "daily_for_month": over_gold(
            "SELECT pickup_date, total_trips, total_revenue, avg_fare, avg_tip, avg_distance, avg_duration_minutes "
            f"FROM daily WHERE {january} ORDER BY pickup_date"
        ),
        "daily_for_month_head": over_gold(
            "SELECT pickup_date, total_trips, total_revenue, avg_fare "
            f"FROM daily WHERE {january} ORDER BY pickup_date LIMIT 5"
        ),
        "top_revenue_days": over_gold(
            "SELECT pickup_date, total_trips, total_revenue FROM daily ORDER BY total_revenue DESC, pickup_date LIMIT 5"
        ),
        "monthly_revenue": over_gold(
            f"SELECT pickup_year, pickup_month, {trips}, {cents(total('total_revenue'))} AS total_revenue, "
            f"{mean('avg_fare')} AS avg_daily_fare FROM daily GROUP BY pickup_year, pickup_month"
        ),
        "busiest_hours": over_gold(
            f"SELECT pickup_hour, {trips}, {mean('avg_fare')} AS avg_fare, "
            f"{mean('avg_duration_minutes')} AS avg_duration_mins FROM hourly WHERE {january} GROUP BY pickup_hour"
        ),
        "busiest_hours_year": over_gold(
            "SELECT pickup_hour, CAST(SUM(h.total_trips) AS BIGINT) AS total_trips, "
            f"{mean('h.avg_fare')} AS avg_fare FROM hourly h WHERE pickup_year = 2024 GROUP BY pickup_hour "
            "ORDER BY SUM(h.total_trips) DESC, pickup_hour LIMIT 5"
        ),
        "rush_hour_slots": over_gold(
            "SELECT CASE WHEN pickup_hour BETWEEN 7 AND 9 THEN 'Morning Rush (7-9am)' "
            "WHEN pickup_hour BETWEEN 17 AND 19 THEN 'Evening Rush (5-7pm)' "
            "WHEN pickup_hour BETWEEN 0 AND 5 THEN 'Late Night (12-5am)' ELSE 'Other Hours' END AS time_slot, "
            f"{trips}, {mean('avg_fare')} AS avg_fare FROM hourly GROUP BY 1"
        ),
        "busiest_locations": over_gold(
            f"SELECT {place}, total_trips, avg_fare, avg_distance, avg_tip, total_revenue FROM location "
            'ORDER BY total_trips DESC, "PULocationID" LIMIT 10'
        ),
        "busiest_locations_short": over_gold(
            f"SELECT {place}, total_trips, avg_fare, total_revenue FROM location "
            'ORDER BY total_trips DESC, "PULocationID" LIMIT 10'
        ),
        "top_revenue_locations": over_gold(
            f"SELECT {place}, total_trips, total_revenue, avg_fare FROM location "
            'ORDER BY total_revenue DESC, "PULocationID" LIMIT 10'
        ),
        "long_distance_hotspots": over_gold(
            f"SELECT {place}, total_trips, avg_distance, avg_fare, avg_duration_minutes FROM location "
            'WHERE avg_distance > 5 ORDER BY avg_distance DESC, "PULocationID" LIMIT 10'
        ),
        "payment_breakdown": over_gold(
            f"SELECT {_METHOD}, total_trips, avg_fare, avg_tip, total_revenue, "
            + cents("(CAST(total_trips AS DOUBLE) * 100 / (SUM(total_trips) OVER ()))")
            + " AS trip_percentage FROM payment"
        ),
        "payment_breakdown_plain": over_gold(
            f"SELECT {_METHOD}, total_trips, avg_fare, avg_tip, total_revenue FROM payment"
        ),
        "card_vs_cash_tips": over_gold(
            f"SELECT {_METHOD}, avg_tip, avg_fare, {cents('(avg_tip / NULLIF(avg_fare, 0) * 100)')} AS tip_percentage "
            "FROM payment WHERE payment_type IN (1, 2)"
        ),
        "gold_row_counts": _ROW_COUNTS,
    }


def _control() -> dict[str, str]:
    def files(select: str) -> str:
        return _with(_FILES, select)

    def events(select: str) -> str:
        return _with(_EVENTS, select)

    def fired(where: str) -> str:
        return _with(_METRICS, f"SELECT alarm, dimension, window_start, window_end, total FROM fired WHERE {where}")

    ok, bad = "state = 'SUCCEEDED'", "state IN ('FAILED', 'ERROR', 'STOPPED')"
    done = f"{ok} AND job_name = 'gold-job'"
    routed = "SELECT event_id, job_name, state"
    marker = f"CASE WHEN {ok} THEN '✅' ELSE '❌' END"
    color = f"CASE WHEN {ok} THEN '#2e7d32' ELSE '#c62828' END"
    background = f"CASE WHEN {ok} THEN '#e8f5e9' ELSE '#ffebee' END"
    details = "COALESCE(NULLIF(message, ''), 'No additional details')"
    subject = f"{marker} || ' Trip Pipeline — ' || state AS subject"
    text_body = (
        "'Trip Pipeline — ' || state || chr(10) || chr(10) || 'Pipeline  : Trip Pipeline' || chr(10) "
        "|| 'Status    : ' || state || chr(10) || 'Job Name  : ' || job_name || chr(10) "
        "|| 'Exec ID   : ' || job_run_id || chr(10) || 'Time      : ' || event_time || chr(10) "
        f"|| 'Message   : ' || {details} AS text_body"
    )

    def row(label: str, value: str) -> str:
        return f"'<tr><td><b>{label}</b></td><td>' || {value} || '</td></tr>'"

    html_body = (
        f"'<html><body><div style=\"background-color: ' || {background} || '; border-left: 5px solid ' || {color} "
        f"|| '\"><h2 style=\"color: ' || {color} || '\">' || {marker} || ' Pipeline ' || state || '</h2></div><table>' || "
        + " || ".join(
            (
                row("Pipeline", "'Trip Pipeline'"),
                row("Status", f"'<strong style=\"color: ' || {color} || '\">' || state || '</strong>'"),
                row("Job Name", "job_name"),
                row("Execution ID", "job_run_id"),
                row("Time", "event_time"),
                row("Message", details),
            )
        )
        + " || '</table><p>Trip Pipeline — Automated Notification</p></body></html>' AS html_body"
    )
    message = (
        "'{\"job_name\":\"' || job_name || '\",\"state\":\"' || state || '\",\"job_run_id\":\"' || job_run_id "
        "|| '\",\"message\":\"' || message || '\",\"event_time\":\"' || event_time || '\"}' AS message"
    )
    return {
        "explode_arrivals": files(
            "SELECT bucket, key, size FROM files WHERE doc_id % 17 <> 0 UNION ALL "
            "SELECT bucket, key || '.copy' AS key, size FROM files WHERE doc_id % 17 <> 0 AND doc_id % 5 = 0"
        ),
        "check_extension": files("SELECT key, extension_error FROM findings"),
        "check_prefix": files("SELECT key, prefix_error FROM findings"),
        "check_size": files("SELECT key, size, size_error FROM findings"),
        "check_columns": files("SELECT key, n_rows, columns_error FROM findings"),
        "validate_files": files(
            "SELECT bucket, key, errors = '' AS is_valid, errors, TRUE AS has_time FROM (SELECT bucket, key, "
            "concat_ws('; ', extension_error, prefix_error, size_error, columns_error) AS errors FROM findings)"
        ),
        "validated_scan": over_trips(
            'SELECT "year", "month", COUNT(*) AS "rows" FROM trips WHERE "month" <> 12 GROUP BY "year", "month"'
        ),
        "stream_arrivals": over_trips(
            'SELECT "year", "month", COUNT(*) AS "rows" FROM trips WHERE "month" <> 12 GROUP BY "year", "month"'
        ),
        "arrival_findings": "SELECT finding, TRUE AS each_file_once FROM (VALUES ('valid'), ('gone'), ('VendorID'), ('other')) AS f(finding)",
        "parse_run_event": events(f"SELECT event_id, {AUDIT} FROM run_events"),
        "audit_upsert": events(f"SELECT {AUDIT} FROM audit_table"),
        "stream_audit": events(f"SELECT {AUDIT} FROM audit_table"),
        "audit_retention": events(
            f"SELECT event_id, {AUDIT}, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS logged_at "
            "FROM run_events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'"
        ),
        "audit_status_counts": events("SELECT job_name, state, COUNT(*) AS runs FROM audit_table GROUP BY job_name, state"),
        "route_success": events(f"{routed} FROM run_events WHERE {ok}"),
        "route_failure": events(f"{routed} FROM run_events WHERE {bad}"),
        "route_complete": events(f"{routed} FROM run_events WHERE {done}"),
        "route_events": events(
            f"{routed}, 'success' AS rule FROM run_events WHERE {ok} UNION ALL "
            f"{routed}, 'failure' FROM run_events WHERE {bad} UNION ALL "
            f"{routed}, 'complete' FROM run_events WHERE {done}"
        ),
        "route_patterns": events(
            f"SELECT event_id, 'success' AS rule FROM run_events WHERE {ok} UNION ALL "
            f"SELECT event_id, 'failure' FROM run_events WHERE {bad} UNION ALL "
            f"SELECT event_id, 'complete' FROM run_events WHERE {done} UNION ALL "
            f"SELECT event_id, 'run-' || job_run_id FROM run_events WHERE {bad} "
            "AND CAST(job_run_id AS BIGINT) BETWEEN 0 AND 999 AND (message = '' OR message LIKE 'event 1%') UNION ALL "
            f"SELECT event_id, 'other-states' FROM run_events WHERE NOT ({ok}) AND NOT ({bad}) AND message <> ''"
        ),
        "parse_notification": events("SELECT event_id, job_name, state, job_run_id, message, event_time FROM run_events"),
        "render_notification": events(f"SELECT event_id, {subject}, {text_body}, {html_body} FROM run_events"),
        "notification_log": events(f"SELECT {message}, TRUE AS by_day, TRUE AS has_time FROM run_events"),
        "notification_outbox": events(
            f"SELECT job_name, state, job_run_id, event_time, {subject}, 'sender@example.com' AS sender, "
            "'recipient@example.com' AS recipient, TRUE AS deliver FROM run_events"
        ),
        "alarm_task_failures": fired("rule = 0"),
        "alarm_function_errors": fired("rule = 1"),
        "alarm_audit_errors": fired("rule = 2"),
        "alarm_run_failures": fired("rule = 3"),
        "alarm_engine": fired("TRUE"),
        "alarm_closed_windows": fired(_CLOSED),
        "alarm_periods": _with(_METRICS + _LONG, f"SELECT * FROM long_fired WHERE {_CLOSED}"),
        "alarm_periods_now": _with(_METRICS + _LONG, "SELECT * FROM long_fired"),
        "stream_audit_table": events(f"SELECT {AUDIT} FROM audit_table"),
        "audit_lookup": events(f"SELECT {AUDIT} FROM audit_table ORDER BY job_run_id, event_time LIMIT 1"),
        "stream_dq_split": over_trips(
            'SELECT "PULocationID", COALESCE(dq_reject_reason, \'VALID\') AS outcome, COUNT(*) AS "rows" '
            "FROM tagged GROUP BY ALL"
        ),
        "run_stages": _ROW_COUNTS,
        "on_success": over_trips(
            "SELECT * FROM (VALUES "
            "('audit', 'trip-run', 'run-1', 'SUCCEEDED', 'All pipeline stages completed successfully'), "
            "('notice', 'trip-run', 'run-1', 'SUCCEEDED', 'Trip Pipeline completed — Bronze → Silver → Gold done')"
            ") AS outcome(channel, job_name, job_run_id, state, message) "
            + _held("bronze", "tagged") + _held("silver", "valid") + _held("reject", "tagged WHERE dq_status = 'REJECTED'")
        ),
        "on_failure": over_trips(
            "SELECT * FROM (VALUES ('audit', 'trip-run', 'run-1', 'FAILED', 'Pipeline failed'), "
            "('notice', 'trip-run', 'run-1', 'FAILED', 'Trip Pipeline FAILED — check logs')"
            ") AS outcome(channel, job_name, job_run_id, state, message) " + _held("bronze", "trips")
        ),
        "post_run_register": _TABLE_COUNTS,
    }


def oracle_sql() -> dict[str, str]:
    return {**_storage(), **_quality_and_silver(), **_gold(), **_control()}
