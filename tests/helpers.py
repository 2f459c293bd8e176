from datetime import datetime

TRIP_SCHEMA = ("fare_amount double, trip_distance double, pickup_datetime timestamp_ntz, "
               "dropoff_datetime timestamp_ntz, pu_location_id long, do_location_id long")

GOOD = {"fare_amount": 10.5, "trip_distance": 5.0, "pickup_datetime": "2024-01-10 10:00:00",
        "dropoff_datetime": "2024-01-10 10:15:00", "pu_location_id": 132, "do_location_id": 236}


def _value(value):
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def trips(spark, *changes):
    """One row per dict of changes to a good trip."""
    names = list(GOOD)
    rows = [tuple(_value({**GOOD, **change}[name]) for name in names) for change in changes]
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def zone_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "LocationID int, Borough string, Zone string, service_zone string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
