"""Mart groups as states that can be merged: exact sums and counts, divided and rounded only when they are read.

A month's averages cannot be averaged to a year's. Sums and counts can be added, so any coarser grain, a quarter, a year or a
borough, comes from the stored months without reading a trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.scalars import day_part, fixed_sum, joined_sum, month_start, other_sum, round2
from fareline.schemas import HOURLY, HOURLY_STATE, REVENUE, REVENUE_MEASURES, REVENUE_STATE

HOURLY_KEYS = ("pickup_date", "pickup_hour", "service_type", "pu_borough", "pu_zone")
REVENUE_KEYS = ("pickup_month_date", "service_type", "pu_borough", "pu_zone")


def _measured(name: str) -> list[Column]:
    value = F.col(name)
    return [fixed_sum(value).alias(f"{name}_sum"), other_sum(value).alias(f"{name}_rest"), F.count(value).alias(f"{name}_n")]


def _minutes() -> list[Column]:
    minutes = F.col("trip_duration_minutes")
    return [F.sum(minutes).alias("minutes_sum"), F.count(minutes).alias("minutes_n")]


def hourly_state(enriched: DataFrame) -> DataFrame:
    """The groups of the hourly demand mart."""
    return enriched.filter(F.col("pu_borough").isNotNull()).groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("passenger_count").alias("total_passengers"),
        *_measured("trip_distance"), *_minutes()).select(*HOURLY_STATE.names)


def revenue_state(enriched: DataFrame) -> DataFrame:
    """The groups of the zone revenue mart."""
    keyed = enriched.filter(F.col("pu_borough").isNotNull()).groupBy(
        month_start(F.col("pickup_date")).alias("pickup_month_date"), *REVENUE_KEYS[1:])
    return keyed.agg(F.count(F.lit(1)).alias("trip_count"), *(c for name in REVENUE_MEASURES for c in _measured(name)),
                     *_minutes()).select(*REVENUE_STATE.names)


def merged(state: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """States of a coarser grain: all sums and counts added up by ``keys``."""
    names = [n for n in state.columns if n in ("trip_count", "total_passengers") or n.endswith(("_sum", "_rest", "_n"))]
    types = dict(state.dtypes)
    return state.groupBy(*keys).agg(*(F.sum(n).cast(types[n]).alias(n) for n in names))


def _total(name: str) -> Column:
    if name == "minutes":
        return F.col("minutes_sum").cast("double")
    return joined_sum(F.col(f"{name}_sum"), F.col(f"{name}_rest"))


def _total2(name: str) -> Column:
    return round2(_total(name))


def _mean2(name: str) -> Column:
    return round2(F.try_divide(_total(name), F.col(f"{name}_n").cast("double")))


def hourly_view(state: DataFrame) -> DataFrame:
    """The hourly demand mart out of its states."""
    return state.withColumns({
        "pickup_year": F.year("pickup_date"), "pickup_month": F.month("pickup_date"),
        "day_of_week": F.dayofweek("pickup_date"), "time_of_day": day_part(F.col("pickup_hour")),
        "avg_trip_distance": _mean2("trip_distance"), "avg_duration_minutes": _mean2("minutes"),
    }).select(*HOURLY.names)


def revenue_columns(state: DataFrame) -> DataFrame:
    """The state's keys and the revenue mart's measures, whatever the grain."""
    keys = [n for n in state.columns if n != "trip_count" and not n.endswith(("_sum", "_rest", "_n"))]
    return state.select(
        *keys, "trip_count", _total2("total_amount").alias("total_revenue"), _mean2("total_amount").alias("avg_revenue_per_trip"),
        _mean2("fare_amount").alias("avg_fare"), _total2("tip_amount").alias("total_tips"),
        _mean2("tip_percentage").alias("avg_tip_percentage"), _mean2("revenue_per_mile").alias("avg_revenue_per_mile"),
        _mean2("trip_distance").alias("avg_trip_distance"), _mean2("minutes").alias("avg_duration_minutes"))


def revenue_view(state: DataFrame) -> DataFrame:
    """The monthly zone revenue mart out of its states."""
    return revenue_columns(state).withColumns({
        "pickup_year": F.year("pickup_month_date"), "pickup_month": F.month("pickup_month_date")}).select(*REVENUE.names)


def revenue_by_period(state: DataFrame, unit: str) -> DataFrame:
    """Zone revenue by quarter or year (``unit``), from the months' states; ``period_start`` is its first day."""
    if unit not in ("quarter", "year"):
        raise ValueError(f"unit {unit!r} is neither quarter nor year")
    start = F.trunc("pickup_month_date", unit).alias("period_start")
    return revenue_columns(merged(state, [start, *REVENUE_KEYS[1:]]))
