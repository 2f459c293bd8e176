"""The queries of ``fareline.queries`` once more as plain SQL over the generic tables (DuckDB dialect)."""

from __future__ import annotations

from fareline.fixtures import LIMITS, MONTH, SOURCE_FILE, YEAR
from fareline.functions.rules import Thresholds
from fareline.operators.profile import DURATION_PROBABILITIES, VALUE_PROBABILITIES
from fareline.queries import MIN_ROWS, REASONS, UNREACHED_ROWS


def _trips_cte(name: str, source: str, keep: str = "") -> str:
    """Raw trips out of an events-like relation."""
    return f"""
{name}_keyed AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM {source}
), {name}_timed AS (
  SELECT *, CASE WHEN k = 50 THEN NULL WHEN k = 51 THEN ts - INTERVAL 400 DAY ELSE ts END AS pickup FROM {name}_keyed
), {name} AS (
  SELECT CAST(1 + event_id % 2 AS INTEGER) AS "VendorID",
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'green' END AS service_type,
         pickup AS tpep_pickup_datetime,
         pickup + to_seconds(CAST(floor(value * 360) AS BIGINT) - 1800) AS tpep_dropoff_datetime,
         CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 7 AS INTEGER) END AS passenger_count,
         CASE WHEN k = 97 THEN -value WHEN k >= 98 THEN value * 20 ELSE value / 8 END AS trip_distance,
         CAST(1 + k % 6 AS INTEGER) AS "RatecodeID",
         CASE WHEN k % 40 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(user_id % 27 AS INTEGER) AS "PULocationID",
         CAST(k % 26 AS INTEGER) AS "DOLocationID",
         CAST(1 + k % 4 AS INTEGER) AS payment_type,
         CASE WHEN k = 53 THEN NULL ELSE value END AS fare_amount,
         CAST(0.5 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         CAST(k AS DOUBLE) / 10 AS tip_amount,
         CAST(CASE WHEN k % 20 = 0 THEN 6.55 ELSE 0 END AS DOUBLE) AS tolls_amount,
         CAST(1 AS DOUBLE) AS improvement_surcharge,
         value + CAST(k AS DOUBLE) / 10 + CAST(2.5 AS DOUBLE) AS total_amount,
         CAST(2.5 AS DOUBLE) AS congestion_surcharge,
         CAST(CASE WHEN k % 25 = 0 THEN 1.75 ELSE 0 END AS DOUBLE) AS "Airport_fee"{keep}
  FROM {name}_timed
)"""


RENAMED = """"VendorID" AS vendor_id, service_type, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance, "RatecodeID" AS ratecode_id,
  store_and_fwd_flag, "PULocationID" AS pu_location_id, "DOLocationID" AS do_location_id, payment_type, fare_amount,
  extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  "Airport_fee" AS airport_fee"""

WIDENED = """CAST("VendorID" AS BIGINT) AS vendor_id, service_type, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance,
  CAST("RatecodeID" AS BIGINT) AS ratecode_id, store_and_fwd_flag, CAST("PULocationID" AS BIGINT) AS pu_location_id,
  CAST("DOLocationID" AS BIGINT) AS do_location_id, CAST(payment_type AS BIGINT) AS payment_type, fare_amount,
  extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  "Airport_fee" AS airport_fee"""

RAW = _trips_cte("raw", "events")
RECONCILED = f"""{RAW}, reconciled AS (
  SELECT {WIDENED}, CAST(NULL AS DOUBLE) AS cbd_congestion_fee, '{SOURCE_FILE}' AS source_file,
         CAST({YEAR} AS INTEGER) AS file_year, CAST({MONTH} AS INTEGER) AS file_month
  FROM raw
)"""

# The same rows as three monthly files per service; February lacks one surcharge, March has one more.
MONTHLY = f"""shifted AS (
  SELECT * REPLACE (ts + to_days(CAST(31 * (event_id % 3) AS INTEGER)) AS ts),
         CAST({MONTH} + event_id % 3 AS INTEGER) AS file_month
  FROM events
), {_trips_cte("raw", "shifted", ", file_month")}, reconciled AS (
  SELECT {WIDENED.replace(' congestion_surcharge,',
                          ' CASE WHEN file_month <> 2 THEN congestion_surcharge END AS congestion_surcharge,')},
         CASE WHEN file_month = 3 THEN CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee,
         service_type || '_tripdata_{YEAR}-0' || file_month || '.parquet' AS source_file,
         CAST({YEAR} AS INTEGER) AS file_year, file_month
  FROM raw
)"""

ZONES = """zones AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

SECONDS = "date_diff('second', date_trunc('second', pickup_datetime), date_trunc('second', dropoff_datetime))"
DATETIMES = "(pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL)"
PERIOD = "(year(pickup_datetime) = file_year AND month(pickup_datetime) = file_month)"
DURATION = f"({SECONDS} > 0 AND {SECONDS} <= 86400)"
DISTANCE = "(trip_distance >= 0 AND trip_distance <= 500)"


def _fare(limits: Thresholds) -> str:
    return f"(fare_amount >= {limits.min_fare})"


def _locations(limits: Thresholds) -> str:
    ids = f"BETWEEN {limits.min_location_id} AND {limits.max_location_id}"
    return f"(pu_location_id {ids} AND do_location_id {ids})"


FARE, LOCATIONS = _fare(LIMITS), _locations(LIMITS)
STRICTER = _fare(Thresholds(min_fare=20.0))
VERDICT = f"({DATETIMES} AND {FARE} AND {DURATION} AND {DISTANCE} AND {LOCATIONS} AND {PERIOD})"


def _reason(failed: str) -> str:
    """``failed`` is a template that says when a rule counts as failed."""
    chain = (("null_datetime", DATETIMES), ("wrong_period", PERIOD), ("invalid_fare", FARE),
             ("invalid_duration", DURATION), ("suspicious_distance", DISTANCE), ("invalid_location_id", LOCATIONS))
    return "CASE " + " ".join(f"WHEN {failed.format(rule)} THEN '{code}'" for code, rule in chain) + " END"


FAILED = {"reject": "({} IS NOT TRUE)", "sql": "NOT {}"}


def _rejected(policy: str) -> str:
    return f"""rejected AS (
  SELECT *, {_reason(FAILED[policy])} AS reason_code, make_date(file_year, file_month, 1) AS ingestion_date
  FROM reconciled WHERE {FAILED[policy].format(VERDICT)}
)"""


VALID = f"""{ZONES}, valid AS (
  SELECT r.*, CAST(pickup_datetime AS DATE) AS pickup_date, pu.borough AS pu_borough, pu.zone AS pu_zone,
         dropoff.borough AS do_borough, dropoff.zone AS do_zone,
         make_date(file_year, file_month, 1) AS ingestion_date
  FROM reconciled r LEFT JOIN zones pu ON pu.location_id = pu_location_id
  LEFT JOIN zones dropoff ON dropoff.location_id = do_location_id
  WHERE {VERDICT}
)"""

CONFORMED_COLUMNS = """vendor_id, service_type, pickup_datetime, dropoff_datetime, pickup_date, passenger_count,
  trip_distance, pu_location_id, do_location_id, pu_borough, pu_zone, do_borough, do_zone, ratecode_id,
  store_and_fwd_flag, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
  total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee, ingestion_date, source_file"""

FACT_COLUMNS = """vendor_id, service_type, pu_location_id, do_location_id, pu_borough, pu_zone, do_borough, do_zone,
  payment_type, ratecode_id, pickup_datetime, dropoff_datetime, pickup_date, pickup_hour, day_of_week, pickup_month,
  pickup_year, time_of_day, passenger_count, trip_distance, trip_duration_minutes, fare_amount, tip_amount,
  tolls_amount, congestion_surcharge, airport_fee, cbd_congestion_fee, total_amount, tip_percentage,
  revenue_per_mile, ingestion_date, source_file"""

ENRICHED = f"""{VALID}, enriched AS (
  SELECT {CONFORMED_COLUMNS},
         CAST(date_sub('minute', pickup_datetime, dropoff_datetime) AS BIGINT) AS trip_duration_minutes,
         CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100, 2) END AS tip_percentage,
         CASE WHEN trip_distance > 0 THEN round(total_amount / trip_distance, 2) END AS revenue_per_mile,
         CASE WHEN hour(pickup_datetime) BETWEEN 6 AND 11 THEN 'morning'
              WHEN hour(pickup_datetime) BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN hour(pickup_datetime) BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day,
         CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS day_of_week,
         CAST(month(pickup_date) AS INTEGER) AS pickup_month,
         CAST(year(pickup_date) AS INTEGER) AS pickup_year
  FROM valid
)"""



def _exact(column: str) -> str:
    """The sum of the values' decimal texts, as a double: no order of addition can change it."""
    return f"CAST(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 9))) AS DOUBLE)"


def _sum2(column: str) -> str:
    return f"round({_exact(column)}, 2)"


def _avg2(column: str) -> str:
    return f"round({_exact(column)} / count({column}), 2)"


HOURLY = f"""SELECT pickup_date, pickup_year, pickup_month, pickup_hour, day_of_week, time_of_day, service_type,
  pu_borough, pu_zone, count(*) AS trip_count, CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
  {_avg2("trip_distance")} AS avg_trip_distance, {_avg2("trip_duration_minutes")} AS avg_duration_minutes
FROM enriched WHERE pu_borough IS NOT NULL GROUP BY ALL"""

REVENUE = f"""SELECT pickup_year, pickup_month, CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month_date,
  service_type, pu_borough, pu_zone, count(*) AS trip_count,
  {_sum2("total_amount")} AS total_revenue, {_avg2("total_amount")} AS avg_revenue_per_trip,
  {_avg2("fare_amount")} AS avg_fare, {_sum2("tip_amount")} AS total_tips,
  {_avg2("tip_percentage")} AS avg_tip_percentage, {_avg2("revenue_per_mile")} AS avg_revenue_per_mile,
  {_avg2("trip_distance")} AS avg_trip_distance, {_avg2("trip_duration_minutes")} AS avg_duration_minutes
FROM enriched WHERE pu_borough IS NOT NULL GROUP BY ALL"""

INT_QUALITY = f"""{_rejected("reject")}, quality AS (
  SELECT CAST(date_trunc('month', ingestion_date) AS DATE) AS ingestion_month, service_type, reason_code,
         count(*) AS rejected_count
  FROM rejected GROUP BY ALL
)"""

MONTHLY_QUALITY = f"""{INT_QUALITY}, monthly_quality AS (
  SELECT *, CAST(sum(rejected_count) OVER per_month AS BIGINT) AS total_rejected_that_month,
         round(rejected_count * CAST(100 AS DOUBLE) / nullif(sum(rejected_count) OVER per_month, 0), 2)
           AS pct_of_monthly_rejected
  FROM quality WINDOW per_month AS (PARTITION BY ingestion_month, service_type)
)"""

HEALTH = f"""{ENRICHED}, {INT_QUALITY}, counts AS (
  SELECT ingestion_month, service_type, coalesce(v.n, 0) AS total_valid_trips,
         CAST(coalesce(r.n, 0) AS BIGINT) AS total_rejected_trips
  FROM (SELECT CAST(date_trunc('month', ingestion_date) AS DATE) AS ingestion_month, service_type, count(*) AS n
        FROM enriched GROUP BY ALL) v
  FULL OUTER JOIN (SELECT ingestion_month, service_type, sum(rejected_count) AS n FROM quality GROUP BY ALL) r
  USING (ingestion_month, service_type)
), health AS (
  SELECT *, total_valid_trips + total_rejected_trips AS total_processed,
         round(total_rejected_trips * CAST(100 AS DOUBLE)
               / nullif(total_valid_trips + total_rejected_trips, 0), 2) AS rejection_rate_pct
  FROM counts
)"""


def _counts(policy: str) -> str:
    return f"""WITH {RECONCILED}, c AS (
  SELECT count(*) AS raw_rows, count(*) FILTER (WHERE {VERDICT}) AS valid_rows,
         count(*) FILTER (WHERE {FAILED[policy].format(VERDICT)}) AS rejected_rows FROM reconciled)
SELECT *, raw_rows - valid_rows - rejected_rows AS lost_rows,
       round(rejected_rows * CAST(100 AS DOUBLE) / nullif(raw_rows, 0), 2) AS reject_rate_pct FROM c"""


def _percentiles(metrics: dict[str, str], probabilities: tuple[float, ...]) -> str:
    branches = [
        f"SELECT '{name}' AS metric, CAST({p} AS DOUBLE) AS probability, "
        f"quantile_disc(CAST({expression} AS DOUBLE), {p}) AS value FROM reconciled"
        for name, expression in metrics.items() for p in probabilities]
    return f"WITH {RECONCILED} " + " UNION ALL ".join(branches)


SUSPICIOUS = {
    "fare_negative": "fare_amount < 0",
    "fare_zero": "fare_amount = 0",
    "distance_lte_zero": "trip_distance <= 0",
    "null_pickup_location": "pu_location_id IS NULL",
    "null_dropoff_location": "do_location_id IS NULL",
    "duration_lte_zero": f"{SECONDS} <= 0",
    "duration_gt_24h": f"{SECONDS} > 86400",
}

PROFILE = f"""WITH {RECONCILED}, c AS (
  SELECT count(*) AS total_rows,
         {", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in SUSPICIOUS.items())},
         min(fare_amount) AS fare_min, max(fare_amount) AS fare_max,
         min(trip_distance) AS distance_min, max(trip_distance) AS distance_max
  FROM reconciled)
SELECT *, {", ".join(f"round({n} * CAST(100 AS DOUBLE) / nullif(total_rows, 0), 2) AS {n}_pct" for n in SUSPICIOUS)}
FROM c"""


def _orphans(role: str, column: str) -> str:
    return f"""SELECT '{role}' AS role, count(*) AS total_trips, count(*) FILTER (WHERE {column} NOT IN
  (SELECT location_id FROM zones)) AS orphan_trips FROM reconciled"""


ORPHANS = f"""WITH {RECONCILED}, {ZONES}, c AS ({_orphans("pickup", "pu_location_id")}
UNION ALL {_orphans("dropoff", "do_location_id")})
SELECT *, round(orphan_trips * CAST(100 AS DOUBLE) / nullif(total_trips, 0), 2) AS orphan_pct FROM c"""


def _null_tests(model: str, relation: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failing_rows FROM ({relation})" for c in columns)


NULL_TESTS = " UNION ALL ".join((
    _null_tests("stg_trips", "FROM enriched", (
        "vendor_id", "service_type", "pickup_date", "fare_amount", "pu_location_id", "do_location_id")),
    _null_tests("fact_trips", "FROM enriched", ("pickup_date", "service_type", "total_amount")),
    _null_tests("agg_hourly_demand_by_zone", HOURLY, ("trip_count",)),
    _null_tests("agg_monthly_zone_revenue", REVENUE, ("total_revenue",)),
    _null_tests("agg_monthly_data_quality", "FROM monthly_quality", ("rejected_count",)),
))

REASON_COUNTS = "SELECT reason_code, count(*) AS rejected_count FROM rejected GROUP BY ALL"
RECONCILED_COLUMNS = "* EXCLUDE (source_file, file_year, file_month)"
REJECTED_COLUMNS = "* EXCLUDE (source_file, file_year, file_month, ingestion_date)"
QUARANTINE_COLUMNS = """vendor_id, service_type, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
  pu_location_id, do_location_id, fare_amount, total_amount, reason_code, ingestion_date, source_file"""
STAGED = f"WITH {RECONCILED}, {VALID} SELECT {CONFORMED_COLUMNS} FROM valid"


def _rule(columns: str, holds: str) -> str:
    return f"WITH {RECONCILED} SELECT {columns}, {holds} AS holds FROM reconciled"


def _gate(min_rows: int) -> str:
    return f"""WITH {RECONCILED}, {VALID}, c AS (
  SELECT count(*) AS row_count FROM valid WHERE pickup_date >= make_date({YEAR}, {MONTH}, 1)
  AND pickup_date < make_date({YEAR}, {MONTH} + 1, 1))
SELECT '{YEAR}-0{MONTH}' AS period, row_count, CAST({min_rows} AS BIGINT) AS min_rows,
       row_count >= {min_rows} AS passed FROM c"""


def _measures(month: int) -> str:
    """Everything the profile of one month tells, as rows."""
    counts = {"total_rows": "count(*)", "fare_min": "min(fare_amount)", "fare_max": "max(fare_amount)",
              "distance_min": "min(trip_distance)", "distance_max": "max(trip_distance)"}
    for name, test in SUSPICIOUS.items():
        counts[name] = f"count(*) FILTER (WHERE {test})"
        counts[f"{name}_pct"] = f"round({counts[name]} * CAST(100 AS DOUBLE) / nullif(count(*), 0), 2)"
    for probabilities, metrics in (
            (VALUE_PROBABILITIES, {"fare_amount": "fare_amount", "trip_distance": "trip_distance"}),
            (DURATION_PROBABILITIES, {"duration_minutes": f"{SECONDS} / CAST(60 AS DOUBLE)"})):
        for metric, expression in metrics.items():
            for p in probabilities:
                counts[f"{metric}_p{p}"] = f"quantile_disc(CAST({expression} AS DOUBLE), {p})"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS measure, CAST({value} AS DOUBLE) AS value FROM reconciled WHERE file_month = {month}"
        for name, value in counts.items())


def _compared(left: int, right: int) -> str:
    return f"""WITH {MONTHLY}, a AS ({_measures(left)}), b AS ({_measures(right)})
SELECT measure, a.value AS left_value, b.value AS right_value, b.value - a.value AS change
FROM a FULL OUTER JOIN b USING (measure)"""


def _curve(code: str, value: str, rule: str, fails: str, before: tuple[str, ...], after: tuple[str, ...]) -> str:
    """Counting again for every distinct value of a column as its rule's threshold ``t``."""
    first = " AND ".join(before)
    others = " AND ".join((*before, *after))
    return f"""SELECT '{code}' AS reason_code, t AS threshold,
  (SELECT count(*) FILTER (WHERE ({first}) IS TRUE AND ({fails}) IS NOT FALSE) FROM measured) AS first_failures,
  (SELECT count(*) FILTER (WHERE ({others}) IS NOT TRUE OR ({fails}) IS NOT FALSE) FROM measured) AS rejected
FROM (SELECT DISTINCT CAST({value} AS DOUBLE) AS t FROM measured WHERE {value} IS NOT NULL)"""


_RULES_BEFORE_FARE = ("has_times", "in_period")
CURVE = f"""WITH {RECONCILED}, measured AS MATERIALIZED (
  SELECT fare_amount, {SECONDS} AS seconds, trip_distance, {DATETIMES} AS has_times, {PERIOD} AS in_period, {FARE} AS fare_ok,
         {DURATION} AS duration_ok, {DISTANCE} AS distance_ok, {LOCATIONS} AS locations_ok FROM reconciled
), curve AS (
{_curve("invalid_fare", "fare_amount", "fare", "fare_amount < t", _RULES_BEFORE_FARE,
        ("duration_ok", "distance_ok", "locations_ok"))}
UNION ALL {_curve("invalid_duration", "seconds", "duration", "seconds > t OR seconds <= 0", (*_RULES_BEFORE_FARE, "fare_ok"),
                  ("distance_ok", "locations_ok"))}
UNION ALL {_curve("suspicious_distance", "trip_distance", "distance", "trip_distance > t OR trip_distance < 0",
                  (*_RULES_BEFORE_FARE, "fare_ok", "duration_ok"), ("locations_ok",))}
)
SELECT *, (SELECT count(*) FROM measured) AS total_rows,
       round(rejected * CAST(100 AS DOUBLE) / nullif((SELECT count(*) FROM measured), 0), 2) AS reject_pct FROM curve"""

MEASURED = {"fare_amount": "fare_amount", "trip_distance": "trip_distance", "duration_minutes": f"{SECONDS} / CAST(60 AS DOUBLE)"}


def _drift(left: int, right: int) -> str:
    values = " UNION ALL ".join(f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value, file_month FROM reconciled"
                                for name, value in MEASURED.items())
    return f"""WITH {MONTHLY}, listed AS ({values}), counted AS (
  SELECT metric, value, count(*) FILTER (WHERE file_month = {left}) AS l, count(*) FILTER (WHERE file_month = {right}) AS r
  FROM listed WHERE value IS NOT NULL AND file_month IN ({left}, {right}) GROUP BY ALL
), run AS (
  SELECT metric, value, CAST(sum(l) OVER upto AS BIGINT) AS lc, CAST(sum(r) OVER upto AS BIGINT) AS rc,
         CAST(sum(l) OVER (PARTITION BY metric) AS BIGINT) AS ln, CAST(sum(r) OVER (PARTITION BY metric) AS BIGINT) AS rn
  FROM counted WINDOW upto AS (PARTITION BY metric ORDER BY value)
), apart AS (
  SELECT *, abs(CAST(lc AS DOUBLE) / CAST(ln AS DOUBLE) - CAST(rc AS DOUBLE) / CAST(rn AS DOUBLE)) AS distance FROM run
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY distance DESC, value) AS nth FROM apart
)
SELECT metric, ln AS left_rows, rn AS right_rows, distance, value AS at_value FROM ranked WHERE nth = 1"""


# Column, name as written, type, first and last month of the six files, written by hand; times are named by service.
_TIMELINE = """vendor_id VendorID int 1 1, vendor_id VendorID bigint 2 2, vendor_id VendorID int 3 3,
pickup_datetime {times}_pickup_datetime timestamp_ntz 1 3, dropoff_datetime {times}_dropoff_datetime timestamp_ntz 1 3,
passenger_count passenger_count int 1 2, passenger_count passenger_count double 3 3, trip_distance trip_distance double 1 3,
ratecode_id RatecodeID int 1 3, store_and_fwd_flag store_and_fwd_flag string 1 3, pu_location_id PULocationID int 1 1,
pu_location_id PULocationID bigint 2 2, pu_location_id PULocationID int 3 3, do_location_id DOLocationID int 1 1,
do_location_id DOLocationID bigint 2 2, do_location_id DOLocationID int 3 3, payment_type payment_type int 1 3,
fare_amount fare_amount double 1 3, extra extra double 1 3, mta_tax mta_tax double 1 3, tip_amount tip_amount double 1 3,
tolls_amount tolls_amount double 1 3, improvement_surcharge improvement_surcharge double 1 3, total_amount total_amount double 1 3,
congestion_surcharge congestion_surcharge double 1 1, congestion_surcharge congestion_surcharge double 3 3,
airport_fee Airport_fee double 1 1, airport_fee airport_fee double 2 2, airport_fee Airport_fee double 3 3,
cbd_congestion_fee cbd_congestion_fee double 3 3"""


def _timeline_row(service: str, entry: str) -> str:
    column, raw, kind, first, last = entry.split()
    return (f"('{service}', '{column}', '{raw}', '{kind}', DATE '{YEAR}-0{first}-01', DATE '{YEAR}-0{last}-01', "
            f"CAST({int(last) - int(first) + 1} AS BIGINT))")


TIMELINE = "SELECT * FROM (VALUES " + ", ".join(
    _timeline_row(service, entry) for service, times in (("yellow", "tpep"), ("green", "lpep"))
    for entry in _TIMELINE.format(times=times).split(",")) + (
    ") AS t(service_type, column_name, raw_name, type, first_month, last_month, months)")

QUARTERLY = f"""WITH {MONTHLY}, {ENRICHED} SELECT CAST(date_trunc('quarter', pickup_date) AS DATE) AS period_start,
  {REVENUE[REVENUE.index("service_type"):]}"""


ORACLE_SQL: dict[str, str] = {
    "scan_raw": f"WITH {RAW} SELECT * FROM raw",
    "normalize_columns": f"WITH {RAW} SELECT {RENAMED} FROM raw",
    "cast_types": f"WITH {RAW} SELECT {WIDENED} FROM raw",
    "fill_optional": f"WITH {RECONCILED} SELECT {RECONCILED_COLUMNS} FROM reconciled",
    "add_metadata": f"""WITH {RECONCILED} SELECT pickup_datetime, dropoff_datetime,
  CAST(pickup_datetime AS DATE) AS pickup_date, service_type,
  make_date(file_year, file_month, 1) AS ingestion_date, source_file FROM reconciled""",
    "rule_fare": _rule("fare_amount", FARE),
    "rule_distance": _rule("trip_distance", DISTANCE),
    "rule_duration": _rule("pickup_datetime, dropoff_datetime", DURATION),
    "rule_location": _rule("pu_location_id, do_location_id", LOCATIONS),
    "rule_datetime": _rule("pickup_datetime, dropoff_datetime", DATETIMES),
    "rule_period": _rule("pickup_datetime", PERIOD),
    "split_valid": f"WITH {RECONCILED} SELECT {RECONCILED_COLUMNS} FROM reconciled WHERE {VERDICT}",
    "split_valid_sql_nulls": f"WITH {RECONCILED} SELECT {RECONCILED_COLUMNS} FROM reconciled WHERE {VERDICT}",
    "split_rejected": f"WITH {RECONCILED}, {_rejected('reject')} SELECT {REJECTED_COLUMNS} FROM rejected",
    "split_rejected_sql_nulls": f"WITH {RECONCILED}, {_rejected('sql')} SELECT {REJECTED_COLUMNS} FROM rejected",
    "reason_codes": f"WITH {RECONCILED}, {_rejected('reject')} {REASON_COUNTS}",
    "reason_codes_sql_nulls": f"WITH {RECONCILED}, {_rejected('sql')} {REASON_COUNTS}",
    "local_roundtrip": f"""WITH counted AS ({_counts("reject")})
SELECT outcome, rows, rows AS expected, true AS passed FROM (
  SELECT 'valid' AS outcome, valid_rows AS rows FROM counted
  UNION ALL SELECT 'rejected', rejected_rows FROM counted
  UNION ALL SELECT 'contents', raw_rows FROM counted)""",
    "zone_csv": """SELECT CAST(n_nationkey + 1 AS INTEGER) AS "LocationID", r_name AS "Borough", n_name AS "Zone",
  'all' AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "conform_counts": _counts("reject"),
    "conform_counts_sql_nulls": _counts("sql"),
    "zone_join": f"""WITH {RECONCILED}, {VALID} SELECT pickup_datetime, pu_location_id, pu_borough, pu_zone,
  do_location_id, do_borough, do_zone FROM valid""",
    "conformed_trips": STAGED,
    "stg_trips": STAGED,
    "rejected_trips": f"WITH {RECONCILED}, {_rejected('reject')} SELECT {QUARANTINE_COLUMNS} FROM rejected",
    "int_trips_enriched": f"WITH {RECONCILED}, {ENRICHED} SELECT * FROM enriched",
    "fact_trips": f"WITH {RECONCILED}, {ENRICHED} SELECT {FACT_COLUMNS} FROM enriched",
    "agg_hourly_demand_by_zone": f"WITH {RECONCILED}, {ENRICHED} {HOURLY}",
    "agg_monthly_zone_revenue": f"WITH {RECONCILED}, {ENRICHED} {REVENUE}",
    "int_data_quality": f"WITH {RECONCILED}, {INT_QUALITY} SELECT * FROM quality",
    "agg_monthly_data_quality": f"""WITH {RECONCILED}, {MONTHLY_QUALITY} SELECT * FROM monthly_quality
  ORDER BY ingestion_month DESC, rejected_count DESC, service_type, reason_code""",
    "agg_monthly_pipeline_health": f"WITH {RECONCILED}, {HEALTH} SELECT * FROM health",
    "quality_profile": PROFILE,
    "percentiles": _percentiles({"fare_amount": "fare_amount", "trip_distance": "trip_distance"},
                                VALUE_PROBABILITIES),
    "duration_percentiles": _percentiles({"duration_minutes": f"{SECONDS} / CAST(60 AS DOUBLE)"},
                                         DURATION_PROBABILITIES),
    "orphan_locations": ORPHANS,
    "expect_not_null": f"""WITH {RECONCILED}, {ENRICHED}, {MONTHLY_QUALITY}, tests AS ({NULL_TESTS})
SELECT *, failing_rows = 0 AS passed FROM tests""",
    "expect_accepted_values": f"""WITH {RECONCILED}, {ENRICHED}, tests AS (
  SELECT 'stg_trips' AS model, 'service_type' AS column_name, 'accepted_values' AS test,
         count(*) FILTER (WHERE service_type NOT IN ('yellow', 'green', 'fhv', 'fhvhv')) AS failing_rows
  FROM enriched)
SELECT *, failing_rows = 0 AS passed FROM tests""",
    "row_count_gate": _gate(MIN_ROWS),
    "row_count_gate_failing": _gate(UNREACHED_ROWS),
    "compare_profiles": _compared(1, 2),
    "stored_views": f"""WITH {MONTHLY}, {ENRICHED}, {_rejected("reject")}, refused AS (
  SELECT service_type, count(*) AS rejected FROM rejected GROUP BY ALL)
SELECT service_type, time_of_day, count(*) AS trips, max(trip_duration_minutes) AS longest, max(rejected) AS rejected
FROM enriched JOIN refused USING (service_type) GROUP BY ALL""",
    "multi_month_union": f"WITH {MONTHLY}, {VALID} SELECT {CONFORMED_COLUMNS} FROM valid",
    "replace_period": f"""WITH {RECONCILED}, {VALID}
SELECT service_type, pickup_date, count(*) AS trips, min(fare_amount) AS lowest_fare, max(fare_amount) AS highest_fare
FROM valid WHERE service_type = 'green' OR {STRICTER} GROUP BY ALL""",
    "load_counts": f"""WITH {RECONCILED}, c AS (
  SELECT service_type, count(*) AS raw_rows, count(*) FILTER (WHERE {VERDICT}) AS valid_rows,
         count(*) FILTER (WHERE {VERDICT} IS NOT TRUE) AS rejected_rows FROM reconciled GROUP BY ALL)
SELECT service_type, '{YEAR}-0{MONTH}' AS period, raw_rows, valid_rows, rejected_rows,
       raw_rows - valid_rows - rejected_rows AS lost_rows FROM c""",
    "monthly_run": f"""WITH {MONTHLY}, {ENRICHED} {HOURLY.replace('WHERE', f'WHERE ingestion_date = DATE '
                   f"'{YEAR}-0{MONTH}-01' AND")}""",
    "backfill_revenue": f"WITH {MONTHLY}, {ENRICHED} {REVENUE}",
    "agg_quarterly_zone_revenue": QUARTERLY,
    "threshold_curve": CURVE,
    "period_drift": _drift(1, 2),
    "sketch_percentiles": f"WITH {MONTHLY}, {VALID}, valid_rows AS (SELECT *, {SECONDS} AS seconds FROM valid)" + " UNION ALL ".join(
        f" SELECT '{name}' AS metric, CAST({p} AS DOUBLE) AS probability, count({value}) AS n, true AS within_bound FROM valid_rows"
        for name, value in (("fare_amount", "fare_amount"), ("trip_distance", "trip_distance"), ("duration_minutes", "seconds"))
        for p in DURATION_PROBABILITIES),
    "replay_rejects": f"""WITH {MONTHLY}, {VALID}, {_rejected("reject")}
SELECT service_type, ingestion_date AS month, 'valid' AS outcome, count(*) AS rows, CAST(sum(passenger_count) AS BIGINT) AS passengers
FROM valid GROUP BY ALL
UNION ALL SELECT service_type, ingestion_date, reason_code, count(*), CAST(sum(passenger_count) AS BIGINT) FROM rejected GROUP BY ALL""",
    "schema_timeline": TIMELINE,
    "stored_facts": f"""WITH {MONTHLY}, {ENRICHED}
SELECT service_type, pickup_date, pu_zone, count(*) AS trips, max(trip_duration_minutes) AS longest, max(tip_percentage) AS highest_tip
FROM enriched WHERE ingestion_date = DATE '{YEAR}-0{MONTH}-01' AND pu_borough = 'ASIA' GROUP BY ALL""",
    "described_reasons": f"""WITH {RECONCILED}, {_rejected('reject')}, counted AS ({REASON_COUNTS}), described AS (
  SELECT * FROM (VALUES {", ".join(f"({i}, '{code}', '{text}')" for i, (code, text) in enumerate(REASONS, 1))})
  AS d(priority, reason_code, description))
SELECT CAST(priority AS INTEGER) AS priority, reason_code, description, coalesce(rejected_count, 0) AS rejected_count
FROM described LEFT JOIN counted USING (reason_code)""",
    "lasting_views": f"""WITH {MONTHLY}, {ENRICHED}
SELECT service_type, pickup_month, time_of_day, count(*) AS trips, max(trip_duration_minutes) AS longest,
       max(tip_percentage) AS highest_tip, max(revenue_per_mile) AS highest_revenue
FROM enriched WHERE ingestion_date < DATE '{YEAR}-03-01' GROUP BY ALL""",
    "load_ledger": f"""WITH {MONTHLY}, {VALID}, listed AS (
  SELECT service_type, strftime(ingestion_date, '%Y-%m') AS period, fare_amount FROM valid)
SELECT service_type, period, CAST(CASE WHEN service_type = 'yellow' AND period = '{YEAR}-02' THEN 2 ELSE 1 END AS BIGINT) AS runs,
       true AS done, count(*) FILTER (WHERE service_type <> 'yellow' OR period <> '{YEAR}-02' OR fare_amount >= 20) AS trips
FROM listed GROUP BY ALL""",
    "backfill_health": f"WITH {MONTHLY}, {HEALTH} SELECT * FROM health",
}
