"""Trip-shaped frames derived from the generic ``events``, ``nation`` and ``region`` tables.

Every event becomes one raw trip, with dirty values spread over the key in ``props``. Raw column
names are used on purpose, so that schema reconciliation has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.functions.rules import Thresholds
from fareline.sources.trips import trip_path

YEAR, MONTH = 2024, 1
MONTHS = ((2024, 1), (2024, 2), (2024, 3))
LIMITS = Thresholds(max_location_id=26)
SOURCE_FILE = "events.parquet"
YELLOW_EVENTS = ("click", "view", "purchase")


# Known schemas, so that reading starts no schema inference job.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 zones: nations as zones, regions as boroughs."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey + 1 AS LocationID", "r_name AS Borough", "n_name AS Zone", "'all' AS service_zone")


def _trips(source: DataFrame, *keep: str) -> DataFrame:
    # Generated rather than projected, so that the key and the times are plain columns: a projection
    # would be pushed into every later filter and the JSON parsed again for each rule that uses it.
    keyed = source.selectExpr("*", "explode(array(CAST(get_json_object(props, '$.k') AS BIGINT))) AS k")
    timed = keyed.selectExpr(
        "*", "CASE k WHEN 50 THEN NULL WHEN 51 THEN timestampadd(DAY, -400, ts) ELSE ts END AS pickup")
    yellow = ", ".join(f"'{kind}'" for kind in YELLOW_EVENTS)
    return timed.selectExpr(
        "CAST(event_id % 2 + 1 AS INT) AS VendorID",
        f"IF(event_type IN ({yellow}), 'yellow', 'green') AS service_type",
        "pickup AS tpep_pickup_datetime",
        "timestampadd(SECOND, floor(value * 360) - 1800, pickup) AS tpep_dropoff_datetime",
        "IF(k % 10 = 0, NULL, CAST(k % 7 AS INT)) AS passenger_count",
        "CASE WHEN k = 97 THEN -value WHEN k >= 98 THEN value * 20 ELSE value / 8 END AS trip_distance",
        "CAST(k % 6 + 1 AS INT) AS RatecodeID",
        "IF(k % 40 = 0, 'Y', 'N') AS store_and_fwd_flag",
        "CAST(user_id % 27 AS INT) AS PULocationID",
        "CAST(k % 26 AS INT) AS DOLocationID",
        "CAST(k % 4 + 1 AS INT) AS payment_type",
        "IF(k = 53, NULL, value) AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "k / 10D AS tip_amount",
        "IF(k % 20 = 0, 6.55D, 0D) AS tolls_amount",
        "1D AS improvement_surcharge",
        "value + k / 10D + 2.5D AS total_amount",
        "2.5D AS congestion_surcharge",
        "IF(k % 25 = 0, 1.75D, 0D) AS Airport_fee",
        *keep)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw trips of January 2024, both services in one frame."""
    return _trips(events(spark, sf_dir))


def raw_trips_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw trips of three months; ``file_month`` is the month of the file they come in."""
    shift = F.col("event_id") % 3
    shifted = events(spark, sf_dir).withColumns({
        "ts": F.timestamp_add("DAY", shift * 31, F.col("ts")), "file_month": (shift + MONTH).cast("int")})
    return _trips(shifted, "file_month")


def _as_of_month(trips: DataFrame, service_type: str, month: int) -> DataFrame:
    """The shape this file would have: names and widths drift by service and month."""
    if month == 2:
        trips = trips.withColumns({name: F.col(name).cast("long") for name in (
            "VendorID", "PULocationID", "DOLocationID")}).withColumnRenamed("Airport_fee", "airport_fee").drop(
            "congestion_surcharge")
    if month == 3:
        trips = trips.withColumns({"cbd_congestion_fee": F.lit(0.75),
                                   "passenger_count": F.col("passenger_count").cast("double")})
    if service_type == "green":
        trips = trips.withColumnsRenamed({
            "tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"})
    return trips


def write_month_files(spark: SparkSession, sf_dir: str, root: str, months=MONTHS, services=("yellow", "green"),
                      only: str = "true") -> list[str]:
    """Write the raw trips of these months (those that hold ``only``) as monthly files below ``root`` and return their paths."""
    trips = raw_trips_by_month(spark, sf_dir).filter(only)
    paths = []
    for service_type in services:
        for year, month in months:
            path = trip_path(root, service_type, year, month)
            one_file = trips.filter((F.col("service_type") == service_type) & (F.col("file_month") == month)).drop(
                "service_type", "file_month")
            _as_of_month(one_file, service_type, month).write.mode("overwrite").parquet(path)
            paths.append(path)
    return paths


def write_zone_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the zones as a CSV with a header."""
    path = f"{root}/zones"
    zones(spark, sf_dir).write.mode("overwrite").csv(path, header=True)
    return path
