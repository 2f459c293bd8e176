"""Staging, enriched and fact models: lazy frames, so consumers read only the columns they use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.scalars import day_part, hundredths, ratio_when_positive, whole_minutes
from fareline.schemas import FACT_COLUMNS, STAGED_COLUMNS


def stg_trips(conformed: DataFrame) -> DataFrame:
    """The conformed columns, nothing else; layout-only columns of the stored table stay behind."""
    return conformed.select(*STAGED_COLUMNS)


def int_trips_enriched(staged: DataFrame) -> DataFrame:
    """Staged trips plus duration, ratios and calendar parts."""
    hour = F.hour("pickup_datetime")
    # The ratios stay a projection of their own: each is used several times by the rounding above it.
    scaled = staged.withColumns({
        "scaled_tip": ratio_when_positive(F.col("tip_amount"), F.col("fare_amount")) * F.lit(100.0) * F.lit(100.0),
        "scaled_revenue": ratio_when_positive(F.col("total_amount"), F.col("trip_distance")) * F.lit(100.0),
    })
    return scaled.withColumns({
        "trip_duration_minutes": whole_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")),
        "tip_percentage": hundredths(F.col("scaled_tip")),
        "revenue_per_mile": hundredths(F.col("scaled_revenue")),
        "time_of_day": day_part(hour),
        "pickup_hour": hour,
        "day_of_week": F.dayofweek("pickup_date"),
        "pickup_month": F.month("pickup_date"),
        "pickup_year": F.year("pickup_date"),
    }).drop("scaled_tip", "scaled_revenue")


def fact_trips(enriched: DataFrame) -> DataFrame:
    """One row per trip, without the columns no mart consumer uses."""
    return enriched.select(*FACT_COLUMNS)
