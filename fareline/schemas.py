"""Column names, types and table layouts of the trip data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)


def _struct(*columns: tuple) -> StructType:
    return StructType([StructField(name, kind(), not required) for name, kind, required in columns])


# --- fixed values: names, types and order of all columns, down to the table layouts ------------------
SERVICE_TYPES = ("yellow", "green", "fhv", "fhvhv")

# lower-cased raw name -> conformed name
RAW_NAMES = {
    "vendorid": "vendor_id",
    "ratecodeid": "ratecode_id",
    "pulocationid": "pu_location_id",
    "dolocationid": "do_location_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}

# ids and counts whose width drifts between files
LONG_COLUMNS = ("vendor_id", "passenger_count", "pu_location_id", "do_location_id", "ratecode_id", "payment_type")

# surcharges introduced over the years; absent from older files
LATER_COLUMNS = ("congestion_surcharge", "airport_fee", "cbd_congestion_fee")

CONFORMED = _struct(
    ("vendor_id", LongType, False),
    ("service_type", StringType, True),
    ("pickup_datetime", TimestampNTZType, False),
    ("dropoff_datetime", TimestampNTZType, False),
    ("pickup_date", DateType, True),
    ("passenger_count", LongType, False),
    ("trip_distance", DoubleType, False),
    ("pu_location_id", LongType, False),
    ("do_location_id", LongType, False),
    ("pu_borough", StringType, False),
    ("pu_zone", StringType, False),
    ("do_borough", StringType, False),
    ("do_zone", StringType, False),
    ("ratecode_id", LongType, False),
    ("store_and_fwd_flag", StringType, False),
    ("payment_type", LongType, False),
    ("fare_amount", DoubleType, False),
    ("extra", DoubleType, False),
    ("mta_tax", DoubleType, False),
    ("tip_amount", DoubleType, False),
    ("tolls_amount", DoubleType, False),
    ("improvement_surcharge", DoubleType, False),
    ("total_amount", DoubleType, False),
    ("congestion_surcharge", DoubleType, False),
    ("airport_fee", DoubleType, False),
    ("cbd_congestion_fee", DoubleType, False),
    ("ingestion_date", DateType, True),
    ("source_file", StringType, False),
)

_BY_NAME = {field.name: field for field in CONFORMED.fields}

# What every raw file is brought to before the rules run: the conformed columns a file itself carries.
ADDED_BY_ENGINE = {"service_type", "pickup_date", "ingestion_date", "source_file",
                   "pu_borough", "pu_zone", "do_borough", "do_zone"}
STANDARD_RAW = StructType([f for f in CONFORMED.fields if f.name not in ADDED_BY_ENGINE])

QUARANTINE = StructType([
    *(_BY_NAME[name] for name in (
        "vendor_id", "service_type", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        "pu_location_id", "do_location_id", "fare_amount", "total_amount")),
    StructField("reason_code", StringType(), False),
    _BY_NAME["ingestion_date"],
    _BY_NAME["source_file"],
])

ZONES = _struct(
    ("LocationID", IntegerType, False),
    ("Borough", StringType, False),
    ("Zone", StringType, False),
    ("service_zone", StringType, False),
)

STAGED_COLUMNS = tuple(f.name for f in CONFORMED.fields)

DERIVED = _struct(
    ("trip_duration_minutes", LongType, False),
    ("tip_percentage", DoubleType, False),
    ("revenue_per_mile", DoubleType, False),
    ("time_of_day", StringType, False),
    ("pickup_hour", IntegerType, False),
    ("day_of_week", IntegerType, False),
    ("pickup_month", IntegerType, False),
    ("pickup_year", IntegerType, False),
)

# Column order of the fact table: keys, time, trip, money, provenance.
FACT_COLUMNS = (
    "vendor_id", "service_type", "pu_location_id", "do_location_id", "pu_borough", "pu_zone", "do_borough", "do_zone",
    "payment_type", "ratecode_id",
    "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "day_of_week", "pickup_month", "pickup_year",
    "time_of_day",
    "passenger_count", "trip_distance", "trip_duration_minutes",
    "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "total_amount", "tip_percentage", "revenue_per_mile",
    "ingestion_date", "source_file",
)
_ENRICHED_BY_NAME = {f.name: f for f in (*CONFORMED.fields, *DERIVED.fields)}
FACT = StructType([_ENRICHED_BY_NAME[name] for name in FACT_COLUMNS])

HOURLY = StructType([
    _BY_NAME["pickup_date"],
    *(f for f in DERIVED.fields if f.name in ("pickup_year", "pickup_month", "pickup_hour", "day_of_week",
                                              "time_of_day")),
    _BY_NAME["service_type"], _BY_NAME["pu_borough"], _BY_NAME["pu_zone"],
    *_struct(
        ("trip_count", LongType, True),
        ("total_passengers", LongType, False),
        ("avg_trip_distance", DoubleType, False),
        ("avg_duration_minutes", DoubleType, False),
    ).fields,
])

REVENUE = StructType([
    *(f for f in DERIVED.fields if f.name in ("pickup_year", "pickup_month")),
    StructField("pickup_month_date", DateType(), True),
    _BY_NAME["service_type"], _BY_NAME["pu_borough"], _BY_NAME["pu_zone"],
    StructField("trip_count", LongType(), False),
    *(StructField(name, DoubleType(), True) for name in (
        "total_revenue", "avg_revenue_per_trip", "avg_fare", "total_tips", "avg_tip_percentage",
        "avg_revenue_per_mile", "avg_trip_distance", "avg_duration_minutes")),
])

QUALITY = _struct(
    ("ingestion_month", DateType, True),
    ("service_type", StringType, True),
    ("reason_code", StringType, True),
    ("rejected_count", LongType, True),
    ("total_rejected_that_month", LongType, False),
    ("pct_of_monthly_rejected", DoubleType, False),
)

HEALTH = _struct(
    ("ingestion_month", DateType, True),
    ("service_type", StringType, True),
    ("total_valid_trips", LongType, True),
    ("total_rejected_trips", LongType, True),
    ("total_processed", LongType, True),
    ("rejection_rate_pct", DoubleType, False),
)

# -----------------------------------------------------------------------------------------------------


def _measure(name: str) -> list[StructField]:
    """What is kept of a measure so that groups can be merged: the sum of the values that are added exactly, of the
    others, and how many there are."""
    return [StructField(f"{name}_sum", DecimalType(38, 9)), StructField(f"{name}_rest", DoubleType()),
            StructField(f"{name}_n", LongType(), False)]


MINUTES_STATE = [StructField("minutes_sum", LongType()), StructField("minutes_n", LongType(), False)]
REVENUE_MEASURES = ("total_amount", "fare_amount", "tip_amount", "tip_percentage", "revenue_per_mile", "trip_distance")
# The marts' groups before division and rounding.
HOURLY_STATE = StructType([
    HOURLY["pickup_date"], HOURLY["pickup_hour"], *(HOURLY[name] for name in ("service_type", "pu_borough", "pu_zone")),
    HOURLY["trip_count"], HOURLY["total_passengers"], *_measure("trip_distance"), *MINUTES_STATE])
REVENUE_STATE = StructType([
    *(REVENUE[name] for name in ("pickup_month_date", "service_type", "pu_borough", "pu_zone", "trip_count")),
    *(field for name in REVENUE_MEASURES for field in _measure(name)), *MINUTES_STATE])
# Quantile sketches of one month's values.
SKETCHES = StructType([
    _BY_NAME["service_type"], REVENUE["pickup_month_date"], StructField("metric", StringType(), False),
    StructField("n", LongType(), False), StructField("sketch", BinaryType(), False)])


@dataclass(frozen=True, eq=False)
class TableLayout:
    """How one stored table is laid out.

    ``period_keys`` name one replaceable period and are always given as constants when
    writing; ``day_keys`` are the partitions found in the data itself; ``sort_keys`` order
    rows inside a file so Parquet min/max statistics can skip row groups.
    A sort key that begins with ``-`` is descending. Rows that agree in the sort keys are ordered by the interleaved bits of the
    ``cluster_keys``, whole numbers below 512, so that files can be skipped by any of them.
    A layout key that is not part of ``schema`` (``period``) exists only as a folder level and is the
    month of the column ``period_of``. ``extra`` columns are stored as well, null if a load does not know them, and
    only read where they are asked for. ``read_order`` is the order in which a small table is read.
    """

    name: str
    schema: StructType
    period_keys: tuple[str, ...]
    day_keys: tuple[str, ...] = ()
    sort_keys: tuple[str, ...] = ()
    period_of: str | None = None
    cluster_keys: tuple[str, ...] = ()
    extra: StructType = StructType([])
    read_order: tuple[str, ...] = ()

    @property
    def partition_keys(self) -> tuple[str, ...]:
        return self.period_keys + self.day_keys

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, *self.extra.fields])


# Where a rejected row stands in the raw files: the file from the month's name on, and its place in it.
ROW_ADDRESS = _struct(("raw_file", StringType, False), ("row_index", LongType, False))
LOCATIONS = ("pu_location_id", "do_location_id")
TRIPS_TABLE = TableLayout("trips", CONFORMED, ("service_type", "period"), ("pickup_date",), ("pu_borough",), "pickup_date",
                          LOCATIONS)
REJECTED_TABLE = TableLayout("rejected_trips", QUARANTINE, ("service_type", "ingestion_date"), extra=ROW_ADDRESS)
FACT_TABLE = TableLayout("fact_trips", FACT, ("service_type", "period"), ("pickup_date",), ("pu_borough",), "pickup_date",
                         LOCATIONS)
HOURLY_TABLE = TableLayout("agg_hourly_demand_by_zone", HOURLY, ("service_type", "period"), period_of="pickup_date")
REVENUE_TABLE = TableLayout("agg_monthly_zone_revenue", REVENUE, ("service_type", "period"), period_of="pickup_month_date")
QUALITY_TABLE = TableLayout("agg_monthly_data_quality", QUALITY, ("service_type", "ingestion_month"),
                            sort_keys=("-rejected_count", "reason_code"),
                            read_order=("-ingestion_month", "-rejected_count", "service_type", "reason_code"))
HOURLY_STATE_TABLE = TableLayout("state_hourly_demand", HOURLY_STATE, ("service_type", "period"), period_of="pickup_date")
REVENUE_STATE_TABLE = TableLayout("state_zone_revenue", REVENUE_STATE, ("service_type", "period"),
                                  period_of="pickup_month_date")
SKETCH_TABLE = TableLayout("value_sketches", SKETCHES, ("service_type", "period"), period_of="pickup_month_date")
HEALTH_TABLE = TableLayout("agg_monthly_pipeline_health", HEALTH, ("service_type", "ingestion_month"))
MART_TABLES = (FACT_TABLE, HOURLY_TABLE, REVENUE_TABLE, QUALITY_TABLE, HEALTH_TABLE)
