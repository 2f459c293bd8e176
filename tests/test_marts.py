"""Models and marts on rows small enough to work out by hand."""

import math
import random
from datetime import date, datetime

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from fareline.functions.scalars import day_part, hundredths, percent, ratio_when_positive, round2, total2, whole_minutes
from fareline.plans import marts, models
from fareline.schemas import CONFORMED, FACT, HEALTH, HOURLY, QUALITY, REVENUE


def conformed(spark, *changes):
    base = {f.name: None for f in CONFORMED.fields}
    base.update(service_type="yellow", pickup_datetime=datetime(2024, 1, 7, 8), dropoff_datetime=datetime(2024, 1, 7, 9),
                pickup_date=date(2024, 1, 7), pu_borough="Queens", pu_zone="JFK", fare_amount=20.0, tip_amount=5.0,
                trip_distance=4.0, total_amount=30.0, passenger_count=1, ingestion_date=date(2024, 1, 1))
    return spark.createDataFrame([tuple({**base, **c}[n] for n in CONFORMED.names) for c in changes], CONFORMED)


def rejected(spark, *rows):
    return spark.createDataFrame(list(rows), "ingestion_date date, service_type string, reason_code string")


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("hour, part", [(0, "night"), (5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"),
                                        (16, "afternoon"), (17, "evening"), (21, "evening"), (22, "night")])
def test_day_part(spark, hour, part):
    assert one(spark, day_part(F.lit(hour))) == part


def test_rounding(spark):
    assert one(spark, round2(F.lit(1.005))) == 1.0
    assert one(spark, round2(F.lit(-2.5 / 100))) == -0.03
    # the half cent that 61.795 is in binary, reached exactly however its parts are added
    assert one(spark, total2(F.lit(61.795))) == 61.8
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.33


def test_round2_equals_scaled_round(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1000, 1000) for _ in range(2000)] + [n / 200 for n in range(-400, 400)] + [
        0.0049999999999999994, 1e15 + 0.3, -1e17, 4503599627370497.5, 0.0, None, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    scaled = F.round(F.col("x") * 100.0) / 100.0
    assert df.filter(~round2(F.col("x")).eqNullSafe(scaled)).count() == 0
    by_row = df.withColumn("s", F.col("x") * 100.0)
    assert by_row.filter(~hundredths(F.col("s")).eqNullSafe(scaled)).count() == 0


def test_ratio_needs_a_positive_base(spark):
    assert one(spark, ratio_when_positive(F.lit(5.0), F.lit(20.0))) == 0.25
    assert one(spark, ratio_when_positive(F.lit(5.0), F.lit(0.0))) is None
    assert one(spark, ratio_when_positive(F.lit(5.0), F.lit(-1.0))) is None


@pytest.mark.parametrize("start, end, minutes", [
    ("2024-01-01 00:00:00.9", "2024-01-01 00:01:00.1", 0), ("2024-01-01 00:00:00", "2024-01-01 00:01:59.9", 1),
    ("2024-01-01 00:02:30", "2024-01-01 00:00:00", -2), ("2024-03-10 02:30:00", "2024-03-10 03:30:00", 60)])
def test_whole_minutes_do_not_depend_on_the_session_zone(spark, start, end, minutes):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, whole_minutes(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))) == minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_enriched_and_fact(spark):
    enriched = models.int_trips_enriched(models.stg_trips(conformed(spark, {}, {"fare_amount": 0.0,
                                                                               "trip_distance": 0.0})))
    full, zero = enriched.orderBy(F.desc("fare_amount")).collect()
    assert (full.trip_duration_minutes, full.tip_percentage, full.revenue_per_mile) == (60, 25.0, 7.5)
    assert (full.time_of_day, full.pickup_hour, full.day_of_week, full.pickup_month, full.pickup_year) == (
        "morning", 8, 1, 1, 2024)
    assert (zero.tip_percentage, zero.revenue_per_mile) == (None, None)
    fact = models.fact_trips(enriched)
    assert len(fact.columns) == 32
    assert [(f.name, f.dataType) for f in fact.schema.fields] == [(f.name, f.dataType) for f in FACT.fields]


def test_hourly_demand(spark):
    enriched = models.int_trips_enriched(conformed(
        spark, {}, {"passenger_count": None, "trip_distance": 5.0}, {"pu_zone": "LGA"}, {"pu_borough": None},
        {"pickup_datetime": datetime(2024, 1, 7, 22)}))
    mart = marts.agg_hourly_demand_by_zone(enriched)
    assert [(f.name, f.dataType) for f in mart.schema.fields] == [(f.name, f.dataType) for f in HOURLY.fields]
    rows = {(r.pickup_hour, r.pu_zone): r for r in mart.collect()}
    assert set(rows) == {(8, "JFK"), (8, "LGA"), (22, "JFK")}
    jfk = rows[8, "JFK"]
    assert (jfk.trip_count, jfk.total_passengers, jfk.avg_trip_distance, jfk.avg_duration_minutes) == (2, 1, 4.5, 60.0)
    assert (jfk.time_of_day, rows[22, "JFK"].time_of_day, jfk.day_of_week) == ("morning", "night", 1)


def test_revenue_averages_skip_nulls(spark):
    enriched = models.int_trips_enriched(conformed(spark, {}, {"trip_distance": 0.0, "total_amount": 31.0},
                                                   {"pu_borough": None}))
    mart = marts.agg_monthly_zone_revenue(enriched)
    assert [(f.name, f.dataType) for f in mart.schema.fields] == [(f.name, f.dataType) for f in REVENUE.fields]
    row = mart.collect()[0]
    assert (row.pickup_month_date, row.trip_count, row.total_revenue, row.avg_revenue_per_trip) == (
        date(2024, 1, 1), 2, 61.0, 30.5)
    assert (row.avg_revenue_per_mile, row.avg_trip_distance, row.total_tips, row.avg_tip_percentage) == (
        7.5, 2.0, 10.0, 25.0)


def test_quality_and_health(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    quality = marts.int_data_quality(rejected(
        spark, *[(jan, "yellow", "invalid_fare")] * 3, (jan, "yellow", "wrong_period"), (feb, "green", "wrong_period")))
    mart = marts.agg_monthly_data_quality(quality)
    assert mart.columns == QUALITY.names
    assert [tuple(r) for r in mart.collect()] == [
        (feb, "green", "wrong_period", 1, 1, 100.0),
        (jan, "yellow", "invalid_fare", 3, 4, 75.0), (jan, "yellow", "wrong_period", 1, 4, 25.0)]
    facts = models.fact_trips(models.int_trips_enriched(conformed(spark, *[{}] * 12, {"service_type": "green"})))
    health = marts.agg_monthly_pipeline_health(facts, quality)
    assert [(f.name, f.dataType) for f in health.schema.fields] == [(f.name, f.dataType) for f in HEALTH.fields]
    assert sorted(tuple(r) for r in health.collect()) == [
        (jan, "green", 1, 0, 1, 0.0), (jan, "yellow", 12, 4, 16, 25.0), (feb, "green", 0, 1, 1, 100.0)]


def test_marts_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "trips")
    conformed(spark, {}).write.parquet(path)
    built = marts.build_marts(spark.read.parquet(path), rejected(spark, (date(2024, 1, 1), "yellow", "x")))
    hourly = plan_of(built["agg_hourly_demand_by_zone"])
    assert "tip_amount" not in hourly and "total_amount" not in hourly
    assert "PushedFilters: [IsNotNull(pu_borough)]" in hourly
    assert hourly.count("Exchange hashpartitioning") == 1
    health = plan_of(built["agg_monthly_pipeline_health"])
    assert "ReadSchema: struct<service_type:string,ingestion_date:date>" in health
