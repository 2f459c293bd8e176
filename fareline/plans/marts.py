"""Aggregate marts.

All measures are counts, sums and averages, so every group is pre-aggregated before the
shuffle and a hot zone or month sends one row per task, not its trips. Grouping uses the
minimal keys; columns that depend on them are derived after the aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.functions.scalars import day_part, mean2, month_start, percent, total2, whole_mean2
from fareline.plans.models import fact_trips, int_trips_enriched, stg_trips
from fareline.schemas import HEALTH, HOURLY, QUALITY, REVENUE


def _names(schema) -> list[str]:
    return [field.name for field in schema.fields]


def _mean(column: str) -> Column:
    return mean2(F.col(column))


def _total(column: str) -> Column:
    return total2(F.col(column))


def agg_hourly_demand_by_zone(enriched: DataFrame) -> DataFrame:
    """Demand per day, hour, service and pickup zone. Trips without a pickup borough are left out."""
    grouped = enriched.filter(F.col("pu_borough").isNotNull()).groupBy(
        "pickup_date", "pickup_hour", "service_type", "pu_borough", "pu_zone"
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("passenger_count").alias("total_passengers"),
        _mean("trip_distance").alias("avg_trip_distance"),
        whole_mean2(F.col("trip_duration_minutes")).alias("avg_duration_minutes"),
    )
    return grouped.withColumns({
        "pickup_year": F.year("pickup_date"),
        "pickup_month": F.month("pickup_date"),
        "day_of_week": F.dayofweek("pickup_date"),
        "time_of_day": day_part(F.col("pickup_hour")),
    }).select(*_names(HOURLY))


def agg_monthly_zone_revenue(enriched: DataFrame) -> DataFrame:
    """Revenue, tips and trip shape per month, service and pickup zone.

    Averages skip nulls: tip share counts trips with a positive fare, revenue per mile those
    with a positive distance.
    """
    grouped = enriched.filter(F.col("pu_borough").isNotNull()).groupBy(
        month_start(F.col("pickup_date")).alias("pickup_month_date"), "service_type", "pu_borough", "pu_zone"
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        _total("total_amount").alias("total_revenue"),
        _mean("total_amount").alias("avg_revenue_per_trip"),
        _mean("fare_amount").alias("avg_fare"),
        _total("tip_amount").alias("total_tips"),
        _mean("tip_percentage").alias("avg_tip_percentage"),
        _mean("revenue_per_mile").alias("avg_revenue_per_mile"),
        _mean("trip_distance").alias("avg_trip_distance"),
        whole_mean2(F.col("trip_duration_minutes")).alias("avg_duration_minutes"),
    )
    return grouped.withColumns({
        "pickup_year": F.year("pickup_month_date"),
        "pickup_month": F.month("pickup_month_date"),
    }).select(*_names(REVENUE))


def int_data_quality(rejected: DataFrame) -> DataFrame:
    """Rejected rows per ingestion month, service and reason."""
    return rejected.groupBy(
        month_start(F.col("ingestion_date")).alias("ingestion_month"), "service_type", "reason_code"
    ).agg(F.count(F.lit(1)).alias("rejected_count"))


def agg_monthly_data_quality(quality: DataFrame) -> DataFrame:
    """Each reason's share of the month's rejects, newest month and largest reason first.

    Reads the already aggregated counts, so window partitions hold one row per reason code.
    """
    monthly = F.sum("rejected_count").over(Window.partitionBy("ingestion_month", "service_type"))
    return (
        quality.withColumn("total_rejected_that_month", monthly)
        .withColumn("pct_of_monthly_rejected", percent(F.col("rejected_count"), F.col("total_rejected_that_month")))
        .select(*_names(QUALITY))
        .orderBy(F.desc("ingestion_month"), F.desc("rejected_count"), "service_type", "reason_code")
    )


def agg_monthly_pipeline_health(facts: DataFrame, quality: DataFrame) -> DataFrame:
    """Valid and rejected rows and the reject rate per ingestion month and service.

    Both sides are aggregated to one row per month and service before the full outer join.
    """
    keys = ["ingestion_month", "service_type"]
    valid = facts.groupBy(month_start(F.col("ingestion_date")).alias("ingestion_month"), "service_type").agg(
        F.count(F.lit(1)).alias("valid"))
    rejected = quality.groupBy(*keys).agg(F.sum("rejected_count").alias("rejected"))
    counts = valid.join(rejected, keys, "full_outer").select(
        *keys,
        F.coalesce("valid", F.lit(0)).alias("total_valid_trips"),
        F.coalesce("rejected", F.lit(0)).alias("total_rejected_trips"))
    processed = F.col("total_valid_trips") + F.col("total_rejected_trips")
    return counts.withColumn("total_processed", processed).withColumn(
        "rejection_rate_pct", percent(F.col("total_rejected_trips"), F.col("total_processed"))
    ).select(*_names(HEALTH))


class Models:
    """Every model and mart over stored trips and rejects, each built on first use.

    Nothing is cached: each mart is its own column-pruned scan of the stored trips, which at
    scale is cheaper than materialising the enriched rows once more.
    """

    NAMES = ("stg_trips", "int_trips_enriched", "fact_trips", "agg_hourly_demand_by_zone",
             "agg_monthly_zone_revenue", "int_data_quality", "agg_monthly_data_quality",
             "agg_monthly_pipeline_health")

    def __init__(self, conformed: Callable[[], DataFrame], rejected: Callable[[], DataFrame]):
        self._conformed = conformed
        self._rejected = rejected

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return stg_trips(self._conformed())

    @cached_property
    def int_trips_enriched(self) -> DataFrame:
        return int_trips_enriched(self.stg_trips)

    @cached_property
    def fact_trips(self) -> DataFrame:
        return fact_trips(self.int_trips_enriched)

    @cached_property
    def agg_hourly_demand_by_zone(self) -> DataFrame:
        return agg_hourly_demand_by_zone(self.int_trips_enriched)

    @cached_property
    def agg_monthly_zone_revenue(self) -> DataFrame:
        return agg_monthly_zone_revenue(self.int_trips_enriched)

    @cached_property
    def int_data_quality(self) -> DataFrame:
        return int_data_quality(self._rejected())

    @cached_property
    def agg_monthly_data_quality(self) -> DataFrame:
        return agg_monthly_data_quality(self.int_data_quality)

    @cached_property
    def agg_monthly_pipeline_health(self) -> DataFrame:
        return agg_monthly_pipeline_health(self.fact_trips, self.int_data_quality)


def build_marts(conformed: DataFrame, rejected: DataFrame) -> dict[str, DataFrame]:
    """Every model and mart by name."""
    models = Models(lambda: conformed, lambda: rejected)
    return {name: models[name] for name in Models.NAMES}
