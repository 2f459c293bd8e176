"""Exact sums at any size, and mart states that merge to coarser grains."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fareline import fixtures
from fareline.functions.scalars import exact_sum, fixed_sum, halved_sum, whole_mean2
from fareline.plans import states
from fareline.plans.marts import agg_hourly_demand_by_zone, agg_monthly_zone_revenue
from fareline.queries import models
from helpers import plan_of

SF = "/root/testdata/sf0.001"


def summed(df, value):
    return df.agg(exact_sum(F.expr(value)).alias("s")).first().s


@pytest.mark.parametrize(("value", "rows", "expected"), [
    ("9.9e14D", 20_000, 1.98e19), ("-9.9e14D", 20_000, -1.98e19), ("4e-10D", 4_000_000, 0.0016), ("0.1D", 100_000, 10_000.0),
    ("1e-6D", 1_000_000, 1.0), ("-0.3D", 30, -9.0), ("0D", 5, 0.0), ("2e15D", 10, 2e16), ("CAST(NULL AS DOUBLE)", 3, None)])
def test_sums_of_many_equal_values(spark, value, rows, expected):
    found = summed(spark.range(rows), value)
    assert found == expected or found == pytest.approx(expected, rel=1e-12)


def test_sums_carry_past_64_bits(spark):
    """What a group of 1e11 rows would reach is made of a few parts near the edge of a long."""
    big = (1 << 62) - 7
    rows = spark.createDataFrame([(big,), (big,), (big,), (-5,), (None,)], "x long")
    assert rows.agg(halved_sum(F.col("x"), 24)).first()[0] == 3 * big - 5
    assert rows.agg(halved_sum(F.col("x"), 15)).first()[0] == 3 * big - 5


def test_fixed_sum_is_the_decimal_sum_in_any_order(spark):
    rng = random.Random(2)
    values = [round(rng.uniform(-1e6, 1e6), rng.randrange(7)) for _ in range(3000)] + [1e14 + 0.5, -1e14, 999_999_999.999]
    expected = sum((Decimal(v).quantize(Decimal("1e-9")) for v in values), Decimal(0))
    for seed in range(3):
        random.Random(seed).shuffle(values)
        rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
        assert rows.agg(fixed_sum(F.col("x"))).first()[0] == expected
    assert summed(spark.createDataFrame([(1.5,), (float("nan"),)], "x double"), "x") != 0
    assert summed(spark.createDataFrame([(1.5,), (float("inf"),)], "x double"), "x") == float("inf")


def test_means_of_whole_numbers(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,), (2,)], "x long")
    assert rows.agg(whole_mean2(F.col("x"))).first()[0] == 1.67


def test_views_of_the_states_are_the_marts(spark):
    enriched = models(spark, SF)["int_trips_enriched"]
    for view, state, mart in ((states.hourly_view, states.hourly_state, agg_hourly_demand_by_zone),
                              (states.revenue_view, states.revenue_state, agg_monthly_zone_revenue)):
        found, expected = view(state(enriched)), mart(enriched)
        assert found.dtypes == expected.dtypes
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def trips(spark, rng, n):
    rows = []
    for i in range(n):
        when = datetime(2023, 11, 1) + timedelta(minutes=rng.randrange(60 * 24 * 180))
        money = [None if rng.random() < 0.05 else round(rng.uniform(-50, 500), 2) for _ in range(3)]
        rows.append((when.date(), when.hour, "yellow", rng.choice(["Q", "M", None]), rng.choice(["a", "b", None]), 1, *money,
                     rng.choice([None, 12.5, 33.33]), rng.choice([None, 1e15, 2.5, float("nan")]) if i % 50 == 0 else 2.25,
                     rng.uniform(0, 20), rng.choice([None, 3, 70])))
    return spark.createDataFrame(
        rows, "pickup_date date, pickup_hour int, service_type string, pu_borough string, pu_zone string, passenger_count long, "
              "total_amount double, fare_amount double, tip_amount double, tip_percentage double, revenue_per_mile double, "
              "trip_distance double, trip_duration_minutes long")


@pytest.mark.parametrize("unit", ["quarter", "year"])
def test_coarser_grains_come_from_months(spark, unit):
    """Quarters and years over a turn of the year, from merged states and from the trips at once, values that are no numbers too."""
    rows = trips(spark, random.Random(7), 2000)
    months = states.revenue_state(rows)
    found = states.revenue_by_period(months, unit)
    moved = rows.withColumn("pickup_date", F.trunc("pickup_date", unit))
    expected = states.revenue_columns(states.revenue_state(moved)).withColumnRenamed("pickup_month_date", "period_start")
    assert sorted(map(str, found.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert len({r.period_start for r in found.collect()}) == {"quarter": 3, "year": 2}[unit]
    by_borough = states.merged(months, ["pu_borough"])
    assert {r.pu_borough: r.trip_count for r in by_borough.collect()} == {
        r.pu_borough: r["count"] for r in rows.filter("pu_borough IS NOT NULL").groupBy("pu_borough").count().collect()}
    with pytest.raises(ValueError):
        states.revenue_by_period(months, "week")


def test_empty_states(spark):
    empty = states.revenue_state(trips(spark, random.Random(1), 1).limit(0))
    assert states.revenue_view(empty).collect() == states.revenue_by_period(empty, "year").collect() == []
    assert fixtures.MONTHS[0] == (2024, 1) and date(2024, 1, 1).month == 1


def test_a_state_scan_is_aggregated_before_its_shuffle(spark):
    plan = plan_of(states.revenue_state(models(spark, SF)["int_trips_enriched"]))
    assert "partial_sum" in plan
