"""Trip quality rules as data: an ordered list of (reason code, predicate).

The order is the priority of the reason codes: a row that breaks several rules carries the
code of the first one. Predicates are plain three-valued column expressions.

Two null policies decide what a rule that evaluates to NULL means:

``"reject"``  NULL fails the rule, so every input row ends up either valid or rejected.
              NaN fares fail too (Spark orders NaN above every number).
``"sql"``     plain SQL filters: a row whose verdict is NULL is neither valid nor rejected.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline.functions.scalars import elapsed_seconds

REJECT = "reject"
SQL = "sql"
NULL_POLICIES = (REJECT, SQL)

# --- fixed values: reason codes ---
NULL_DATETIME = "null_datetime"
WRONG_PERIOD = "wrong_period"
INVALID_FARE = "invalid_fare"
INVALID_DURATION = "invalid_duration"
SUSPICIOUS_DISTANCE = "suspicious_distance"
INVALID_LOCATION_ID = "invalid_location_id"


@dataclass(frozen=True)
class Thresholds:
    """Limits of the rules (fixed values of production)."""

    min_fare: float = 2.5
    max_distance_miles: float = 500.0
    max_duration_minutes: int = 1440
    min_location_id: int = 1
    max_location_id: int = 265


@dataclass(frozen=True)
class Rule:
    reason_code: str
    holds: Column


def check_null_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {null_policy!r}")


def next_month(year: int, month: int) -> date:
    return date(year + month // 12, month % 12 + 1, 1)


def datetimes_present() -> Column:
    return F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull()


def pickup_in_period(year: int | Column | None = None, month: int | Column | None = None) -> Column:
    """Pickup lies in the month being loaded; always true when no month is expected.

    A constant month becomes a half-open range on the raw column, which Parquet can check
    against row-group statistics. Columns serve reads that span files of several months.
    """
    if year is None or month is None:
        return F.lit(True)
    pickup = F.col("pickup_datetime")
    if isinstance(year, Column) or isinstance(month, Column):
        return (F.year(pickup) == year) & (F.month(pickup) == month)
    return between_months((year, month), (year, month))


def between_months(first: tuple[int, int], last: tuple[int, int]) -> Column:
    """Pickup from the begin of the first month to the end of the last one."""
    pickup = F.col("pickup_datetime")
    begin, end = date(*first, 1), next_month(*last)
    return (pickup >= F.lit(f"{begin} 00:00:00").cast("timestamp_ntz")) & (
        pickup < F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))


def fare_valid(limits: Thresholds = Thresholds(), null_policy: str = SQL) -> Column:
    enough = F.col("fare_amount") >= limits.min_fare
    return enough & ~F.isnan("fare_amount") if null_policy == REJECT else enough


def duration_valid(limits: Thresholds = Thresholds()) -> Column:
    seconds = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (seconds > 0) & (seconds <= limits.max_duration_minutes * 60)


def distance_valid(limits: Thresholds = Thresholds()) -> Column:
    return F.col("trip_distance").between(0.0, limits.max_distance_miles)


def locations_valid(limits: Thresholds = Thresholds()) -> Column:
    return reduce(operator.and_, (
        F.col(name).between(limits.min_location_id, limits.max_location_id)
        for name in ("pu_location_id", "do_location_id")))


def trip_rules(year: int | Column | None = None, month: int | Column | None = None,
               limits: Thresholds = Thresholds(), null_policy: str = REJECT) -> list[Rule]:
    """The standard rules in reason-code priority."""
    check_null_policy(null_policy)
    return [
        Rule(NULL_DATETIME, datetimes_present()),
        Rule(WRONG_PERIOD, pickup_in_period(year, month)),
        Rule(INVALID_FARE, fare_valid(limits, null_policy)),
        Rule(INVALID_DURATION, duration_valid(limits)),
        Rule(SUSPICIOUS_DISTANCE, distance_valid(limits)),
        Rule(INVALID_LOCATION_ID, locations_valid(limits)),
    ]


def all_hold(rules: Sequence[Rule]) -> Column:
    """Three-valued conjunction; as a filter it splits into single pushable predicates."""
    return reduce(operator.and_, (rule.holds for rule in rules))


def any_broken(rules: Sequence[Rule], null_policy: str = REJECT) -> Column:
    """True for rows to quarantine under the given null policy."""
    check_null_policy(null_policy)
    verdict = all_hold(rules)
    return ~(F.coalesce(verdict, F.lit(False)) if null_policy == REJECT else verdict)


def first_broken(rules: Sequence[Rule], null_policy: str = REJECT) -> Column:
    """Reason code of the first broken rule, null when none is broken."""
    check_null_policy(null_policy)

    def broken(rule: Rule) -> Column:
        return ~(F.coalesce(rule.holds, F.lit(False)) if null_policy == REJECT else rule.holds)

    return F.coalesce(*(F.when(broken(rule), F.lit(rule.reason_code)) for rule in rules))
