"""Profile of a raw file: where its values lie and how many look wrong. Used to choose rule thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareline.functions.rules import Thresholds
from fareline.functions.scalars import elapsed_seconds, percent
from fareline.operators.zones import orphan_locations
from fareline.sources.scratch import new_scratch_dir

# --- fixed values: probabilities reported ---
VALUE_PROBABILITIES = (0.01, 0.25, 0.5, 0.75, 0.99)
DURATION_PROBABILITIES = (0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999)


def quality_profile(trips: DataFrame) -> DataFrame:
    """One row: suspicious-value counts with their share of all rows, and value ranges; one pass."""
    seconds = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    # --- fixed values: the report's measures ---
    suspicious = {
        "fare_negative": F.col("fare_amount") < 0,
        "fare_zero": F.col("fare_amount") == 0,
        "distance_lte_zero": F.col("trip_distance") <= 0,
        "null_pickup_location": F.col("pu_location_id").isNull(),
        "null_dropoff_location": F.col("do_location_id").isNull(),
        "duration_lte_zero": seconds <= 0,
        "duration_gt_24h": seconds > Thresholds().max_duration_minutes * 60,
    }
    measured = trips.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count_if(condition).alias(name) for name, condition in suspicious.items()),
        F.min("fare_amount").alias("fare_min"), F.max("fare_amount").alias("fare_max"),
        F.min("trip_distance").alias("distance_min"), F.max("trip_distance").alias("distance_max"),
    )
    return measured.withColumns({
        f"{name}_pct": percent(F.col(name), F.col("total_rows")) for name in suspicious})


def ranged_values(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """The distinct values of each metric with their ``copies``, stored in ranges of about equal size.

    Ranges are cut where a sample of the values says, so their sizes do not depend on how values are distributed; equal
    values were counted before, so none weighs more than another.
    """
    values = df.select(*(expression.cast("double").alias(name) for name, expression in metrics.items())).unpivot(
        [], list(metrics), "metric", "value").filter(F.col("value").isNotNull())
    counted = values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("copies"))
    ranged = counted.repartitionByRange("metric", "value").withColumn("range", F.spark_partition_id())
    # Stored, so that the ranges are the same for their sizes and for what is read of them.
    path = new_scratch_dir(df.sparkSession, "ranges")
    ranged.write.parquet(path)
    return df.sparkSession.read.schema("metric string, value double, copies long, range int").parquet(path)


def exact_percentiles(df: DataFrame, metrics: dict[str, Column], probabilities: Sequence[float]) -> DataFrame:
    """Discrete percentiles of several double expressions: rows (metric, probability, value).

    The value at probability p is the smallest one whose rank reaches ``ceil(p * n)``; nulls do
    not count, NaN comes last. ``percentile_approx`` answers the same question, but merges one sketch per input
    partition in a single task, which does not hold up over very many partitions. Here equal
    values are counted on the map side first and stored in ranges of about equal size; the sizes of the ranges tell
    in which one each rank lies, and only the ranges wanted are ordered, each by a task of its own.
    """
    stored = ranged_values(df, metrics)

    # One row per metric and range from here on; with the probabilities, a broadcast of known size.
    sizes = stored.groupBy("metric", "range").agg(F.sum("copies").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("metric").orderBy("range"))
    total = F.sum("size").over(Window.partitionBy("metric"))
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in probabilities)))
    ranks = sizes.withColumns({"before": upto - F.col("size"), "total": total}).withColumn(
        "probability", wanted).withColumn("rank", F.greatest(F.ceil(F.col("probability") * F.col("total")), F.lit(1)))
    holding = ranks.filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("size")))
    wanted_in = F.broadcast(holding.select("metric", "range", "probability", "rank", "before"))

    finalists = stored.join(F.broadcast(holding.select("metric", "range").distinct()), ["metric", "range"])
    reached = F.sum("copies").over(Window.partitionBy("metric", "range").orderBy("value"))
    placed = finalists.withColumn("reached", reached)
    position = F.col("rank") - F.col("before")
    return placed.join(wanted_in, ["metric", "range"]).filter(
        (position > F.col("reached") - F.col("copies")) & (position <= F.col("reached"))).select(
        "metric", "probability", "value")


def value_percentiles(trips: DataFrame) -> DataFrame:
    """Percentiles of fare and distance."""
    return exact_percentiles(trips, {"fare_amount": F.col("fare_amount"), "trip_distance": F.col("trip_distance")},
                             VALUE_PROBABILITIES)


def duration_percentiles(trips: DataFrame) -> DataFrame:
    """Percentiles of the trip duration in minutes (fractions of a minute, from whole seconds)."""
    minutes = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")) / F.lit(60.0)
    return exact_percentiles(trips, {"duration_minutes": minutes}, DURATION_PROBABILITIES)


def schema_diff(left: StructType, right: StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, left type, right type) for every column that differs in presence or type; no data is read."""
    a = {f.name: f.dataType.simpleString() for f in left.fields}
    b = {f.name: f.dataType.simpleString() for f in right.fields}
    return [(name, a.get(name), b.get(name)) for name in dict.fromkeys([*a, *b]) if a.get(name) != b.get(name)]


def profile_measures(trips: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Everything the profile tells as rows (measure, value): counts, ranges, percentiles, orphans if zones are given."""
    profiled = quality_profile(trips)
    measures = profiled.select(*(F.col(name).cast("double").alias(name) for name in profiled.columns)).unpivot(
        [], profiled.columns, "measure", "value")
    for ranked in (value_percentiles(trips), duration_percentiles(trips)):
        measures = measures.unionByName(ranked.select(
            F.concat("metric", F.lit("_p"), F.col("probability").cast("string")).alias("measure"), "value"))
    if zones is not None:
        measures = measures.unionByName(orphan_locations(trips, zones).select(
            F.concat(F.lit("orphan_"), "role", F.lit("_pct")).alias("measure"), F.col("orphan_pct").alias("value")))
    return measures


def compare_profiles(left: DataFrame, right: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Two periods side by side: rows (measure, left_value, right_value, change), null where one has no value."""
    a = profile_measures(left, zones).withColumnRenamed("value", "left_value")
    b = profile_measures(right, zones).withColumnRenamed("value", "right_value")
    return a.join(b, "measure", "full_outer").withColumn("change", F.col("right_value") - F.col("left_value"))
