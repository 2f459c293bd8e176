"""Single rules, their limits, NULL and NaN, and the reason-code priority."""

from datetime import datetime, timedelta

import pytest
from helpers import trips
from pyspark.sql import functions as F

from fareline.functions import rules as R
from fareline.operators.quality import count_outcomes, keep_rejected, keep_valid

NAN = float("nan")


def verdicts(spark, rule, column, values):
    df = trips(spark, *({column: value} for value in values))
    return [row[0] for row in df.select(rule).collect()]


@pytest.mark.parametrize("value, expected", [
    (10.5, True), (2.5, True), (2.49, False), (0.0, False), (0.01, False), (-5.0, False), (None, None), (NAN, True)])
def test_fare(spark, value, expected):
    assert verdicts(spark, R.fare_valid(), "fare_amount", [value]) == [expected]


def test_nan_fare_fails_when_nulls_are_rejected(spark):
    assert verdicts(spark, R.fare_valid(null_policy=R.REJECT), "fare_amount", [NAN, 3.0]) == [False, True]


@pytest.mark.parametrize("value, expected", [
    (5.0, True), (0.0, True), (500.0, True), (500.01, False), (-1.0, False), (312722.0, False), (None, None),
    (NAN, False)])
def test_distance(spark, value, expected):
    assert verdicts(spark, R.distance_valid(), "trip_distance", [value]) == [expected]


@pytest.mark.parametrize("seconds, expected", [
    (900, True), (1, True), (0, False), (-3600, False), (86400, True), (86401, False), (172800, False)])
def test_duration(spark, seconds, expected):
    start = datetime(2024, 1, 10, 10)
    df = trips(spark, {"pickup_datetime": start, "dropoff_datetime": start + timedelta(seconds=seconds)})
    assert df.select(R.duration_valid()).first()[0] is expected


def test_duration_floors_each_time_to_the_second(spark):
    early, late = datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)
    same = datetime(2024, 1, 1, 0, 0, 1, 900000)
    df = trips(spark, {"pickup_datetime": early, "dropoff_datetime": late},
               {"pickup_datetime": late, "dropoff_datetime": same})
    assert [r[0] for r in df.select(R.duration_valid()).collect()] == [True, False]


def test_duration_of_missing_times_is_unknown(spark):
    assert verdicts(spark, R.duration_valid(), "dropoff_datetime", [None]) == [None]


@pytest.mark.parametrize("pickup, dropoff, expected", [
    (132, 236, True), (1, 265, True), (999, 1, False), (0, 1, False), (1, 266, False), (None, 1, None),
    (None, 999, False)])
def test_location(spark, pickup, dropoff, expected):
    df = trips(spark, {"pu_location_id": pickup, "do_location_id": dropoff})
    assert df.select(R.locations_valid()).first()[0] is expected


@pytest.mark.parametrize("pickup, expected", [
    ("2024-01-01 00:00:00", True), ("2024-01-31 23:59:59.999999", True), ("2024-02-01 00:00:00", False),
    ("2023-12-31 23:59:59", False), ("2002-12-31 10:00:00", False), (None, None)])
def test_period(spark, pickup, expected):
    df = trips(spark, {"pickup_datetime": pickup})
    assert df.select(R.pickup_in_period(2024, 1)).first()[0] is expected
    by_column = R.pickup_in_period(F.lit(2024), F.lit(1))
    assert df.select(by_column).first()[0] is expected


def test_december_period_ends_with_the_year(spark):
    df = trips(spark, {"pickup_datetime": "2024-12-31 23:59:59"}, {"pickup_datetime": "2025-01-01 00:00:00"})
    assert [r[0] for r in df.select(R.pickup_in_period(2024, 12)).collect()] == [True, False]


def test_no_period_means_no_period_rule(spark):
    old = trips(spark, {"pickup_datetime": "2002-12-31 10:00:00", "dropoff_datetime": "2002-12-31 10:10:00"})
    assert keep_valid(old, R.trip_rules()).count() == 1
    assert keep_rejected(old, R.trip_rules(2024, 1)).first()["reason_code"] == R.WRONG_PERIOD


BROKEN = [
    ({"fare_amount": -10.0}, R.INVALID_FARE, R.INVALID_FARE),
    ({"trip_distance": 99999.0}, R.SUSPICIOUS_DISTANCE, R.SUSPICIOUS_DISTANCE),
    ({"pu_location_id": 0}, R.INVALID_LOCATION_ID, R.INVALID_LOCATION_ID),
    ({"dropoff_datetime": "2024-01-10 09:00:00"}, R.INVALID_DURATION, R.INVALID_DURATION),
    ({"pickup_datetime": None}, R.NULL_DATETIME, R.NULL_DATETIME),
    ({"dropoff_datetime": None}, R.NULL_DATETIME, R.NULL_DATETIME),
    ({"fare_amount": 1.0, "trip_distance": -1.0, "pu_location_id": 0}, R.INVALID_FARE, R.INVALID_FARE),
    ({"fare_amount": None}, R.INVALID_FARE, None),
    ({"fare_amount": NAN}, R.INVALID_FARE, None),
    ({"fare_amount": None, "trip_distance": -1.0}, R.INVALID_FARE, R.SUSPICIOUS_DISTANCE),
    ({"trip_distance": None}, R.SUSPICIOUS_DISTANCE, None),
    ({"do_location_id": None}, R.INVALID_LOCATION_ID, None),
]


@pytest.mark.parametrize("change, under_reject, under_sql", BROKEN)
def test_reason_code(spark, change, under_reject, under_sql):
    df = trips(spark, change)
    for policy, expected in ((R.REJECT, under_reject), (R.SQL, under_sql)):
        rows = keep_rejected(df, R.trip_rules(2024, 1, null_policy=policy), policy).collect()
        assert [r["reason_code"] for r in rows] == ([] if expected is None else [expected])


@pytest.mark.parametrize("policy, lost", [(R.REJECT, 0), (R.SQL, 3)])
def test_every_row_is_accounted_for(spark, policy, lost):
    df = trips(spark, {}, {}, *(change for change, _, _ in BROKEN))
    rules = R.trip_rules(2024, 1, null_policy=policy)
    valid, rejected = keep_valid(df, rules), keep_rejected(df, rules, policy)
    counts = count_outcomes(df, rules, policy).first()
    assert counts["raw_rows"] == len(BROKEN) + 2
    assert counts["valid_rows"] == valid.count()
    assert counts["rejected_rows"] == rejected.count()
    assert rejected.filter("reason_code IS NULL").count() == 0
    # plain SQL filters lose the three rows with a null verdict; the NaN fare counts as valid there
    assert counts["lost_rows"] == lost


def test_counting_no_rows_gives_no_rate(spark):
    counts = count_outcomes(trips(spark, {}).limit(0), R.trip_rules()).first()
    assert (counts["raw_rows"], counts["reject_rate_pct"]) == (0, None)


def test_unknown_null_policy_is_refused(spark):
    with pytest.raises(ValueError):
        R.trip_rules(null_policy="drop")


def test_rules_are_data(spark):
    rules = [*R.trip_rules(), R.Rule("no_free_rides", F.col("fare_amount") > 20)]
    assert keep_rejected(trips(spark, {}), rules).first()["reason_code"] == "no_free_rides"
