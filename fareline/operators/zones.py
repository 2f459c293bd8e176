"""Joins with the zone dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.rules import Thresholds
from fareline.functions.scalars import percent

# Up to this width of the valid id range, and so up to this many rows, the dimension is broadcast by default.
BROADCAST_MAX_KEYS = 100_000


def _failing(condition: Column, message: Column, value: Column) -> Column:
    """``value``, or an error where the condition holds."""
    return F.when(condition, F.raise_error(message)).otherwise(value)


def zone_dimension(zones: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """One row per location id inside the valid id range.

    Valid trips only carry ids of that range, so the filter never changes their join result,
    and it bounds the dimension: at most ``max_location_id - min_location_id + 1`` rows. An id
    with several rows and a row without id end the job that uses the dimension: a join would
    otherwise multiply trips, or one of the rows be taken for no reason.
    """
    zone_id = F.col("LocationID").cast("long")
    inside = _failing(zone_id.isNull(), F.lit("zone without location id"),
                      zone_id.between(limits.min_location_id, limits.max_location_id))
    grouped = zones.filter(inside).groupBy(zone_id.alias("location_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.first("Borough").alias("borough"), F.first("Zone").alias("zone"))
    several = F.concat(F.lit("several zones for location id "), F.col("location_id").cast("string"))
    return grouped.select(
        _failing(F.col("rows") > 1, several, F.col("location_id")).alias("location_id"), "borough", "zone")


def join_zones(trips: DataFrame, zones: DataFrame, limits: Thresholds = Thresholds(),
               broadcast_max_keys: int = BROADCAST_MAX_KEYS) -> DataFrame:
    """Add borough and zone of pickup and drop-off; a trip without a match keeps nulls.

    Expects trips that passed the location rule. The same small dimension is used in both
    roles, so one broadcast serves both joins and the trips are not shuffled. An id range wider than
    ``broadcast_max_keys`` gets no hint; Spark then chooses the join by the measured size, with the same result.
    """
    dimension = zone_dimension(zones, limits)
    if limits.max_location_id - limits.min_location_id < broadcast_max_keys:
        dimension = F.broadcast(dimension)
    for role in ("pu", "do"):
        side = dimension.withColumnsRenamed({
            "location_id": f"{role}_location_id", "borough": f"{role}_borough", "zone": f"{role}_zone"})
        trips = trips.join(side, f"{role}_location_id", "left")
    return trips


def orphan_locations(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose location id is not in the zone dimension, per role, with their share of all trips.

    Ids are counted first, so the anti-membership check runs on distinct ids instead of trips
    and no dimension size has to be assumed. A null id is not an orphan.
    """
    roles = {"pu_location_id": "pickup", "do_location_id": "dropoff"}
    uses = trips.select(*roles).unpivot([], list(roles), "role", "location_id")
    counted = uses.groupBy("role", "location_id").agg(F.count(F.lit(1)).alias("trips"))
    known = zones.select(F.col("LocationID").cast("long").alias("location_id")).distinct().withColumn("known", F.lit(1))
    orphan = F.col("location_id").isNotNull() & F.col("known").isNull()
    totals = counted.join(known, "location_id", "left").groupBy("role").agg(
        F.sum("trips").alias("total_trips"),
        F.coalesce(F.sum(F.when(orphan, F.col("trips"))), F.lit(0)).alias("orphan_trips"))
    return totals.select(
        F.when(F.col("role") == "pu_location_id", roles["pu_location_id"]).otherwise(roles["do_location_id"])
        .alias("role"),
        "total_trips", "orphan_trips", percent(F.col("orphan_trips"), F.col("total_trips")).alias("orphan_pct"))
