"""Random dirty trips judged by Spark and by a plain loop."""

import math
import random
from datetime import datetime, timedelta

import pytest
from helpers import trips

from fareline.functions import rules as R
from fareline.operators.quality import keep_rejected, keep_valid

NAN = float("nan")


def random_trip(rng):
    pickup = rng.choice((None, datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 2, 1))) if rng.random() < 0.3 else (
        datetime(2024, 1, 1) + timedelta(microseconds=rng.randrange(31 * 86400 * 10**6)))
    gap = timedelta(microseconds=rng.choice((0, 1, 10**6, 9 * 10**8, 86400 * 10**6, 86401 * 10**6, -10**6)))
    return {
        "fare_amount": rng.choice((None, NAN, 2.49, 2.5, 10.0, -1.0, 0.0, 30.0)),
        "trip_distance": rng.choice((None, NAN, 0.0, -0.1, 3.0, 500.0, 500.1, 7.0)),
        "pickup_datetime": pickup,
        "dropoff_datetime": None if pickup is None or rng.random() < 0.1 else pickup + gap,
        "pu_location_id": rng.choice((None, 0, 1, 265, 266, 100, 7)),
        "do_location_id": rng.choice((None, 0, 1, 265, 266, 100, 7)),
    }


def both(a, b):
    """SQL's AND."""
    if a is False or b is False:
        return False
    return None if a is None or b is None else True


def verdicts(trip, null_policy):
    fare, distance = trip["fare_amount"], trip["trip_distance"]
    pickup, dropoff = trip["pickup_datetime"], trip["dropoff_datetime"]

    def in_range(x):
        return None if x is None else 1 <= x <= 265

    # Spark orders NaN above every number
    enough = None if fare is None else (True if math.isnan(fare) else fare >= 2.5)
    if null_policy == R.REJECT and fare is not None and math.isnan(fare):
        enough = False
    duration = None
    if pickup is not None and dropoff is not None:
        seconds = (dropoff.replace(microsecond=0) - pickup.replace(microsecond=0)).total_seconds()
        duration = 0 < seconds <= 86400
    return [
        (R.NULL_DATETIME, pickup is not None and dropoff is not None),
        (R.WRONG_PERIOD, None if pickup is None else (pickup.year, pickup.month) == (2024, 1)),
        (R.INVALID_FARE, enough),
        (R.INVALID_DURATION, duration),
        (R.SUSPICIOUS_DISTANCE, None if distance is None else 0 <= distance <= 500),
        (R.INVALID_LOCATION_ID, both(in_range(trip["pu_location_id"]), in_range(trip["do_location_id"]))),
    ]


def outcome(trip, null_policy):
    """'valid', a reason code, or 'lost'."""
    judged = verdicts(trip, null_policy)
    broken = [code for code, holds in judged if holds is False or (holds is None and null_policy == R.REJECT)]
    if broken:
        return broken[0]
    return "valid" if all(holds for _, holds in judged) else "lost"


@pytest.mark.parametrize("null_policy", R.NULL_POLICIES)
def test_outcomes_match_a_plain_loop(spark, null_policy):
    rng = random.Random(42)
    rows = [random_trip(rng) for _ in range(1500)] + [{}] * 3
    full = [{**dict(fare_amount=10.5, trip_distance=5.0, pickup_datetime=datetime(2024, 1, 10, 10),
                    dropoff_datetime=datetime(2024, 1, 10, 10, 15), pu_location_id=132, do_location_id=236), **row}
            for row in rows]
    expected = {}
    for trip in full:
        key = outcome(trip, null_policy)
        expected[key] = expected.get(key, 0) + 1
    df = trips(spark, *full)
    rules = R.trip_rules(2024, 1, null_policy=null_policy)
    got = {r.reason_code: r["count"] for r in
           keep_rejected(df, rules, null_policy).groupBy("reason_code").count().collect()}
    got["valid"] = keep_valid(df, rules).count()
    lost = len(full) - sum(got.values())
    if lost:
        got["lost"] = lost
    assert got == expected
    assert ("lost" in got) == (null_policy == R.SQL)
