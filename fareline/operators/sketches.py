"""Quantile sketches that are stored once a month and merged over any months without reading a trip."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.scalars import elapsed_seconds

# Size of a sketch: about 2,000 items per level kept, some 33 KB.
K = 2000
# A rank is off by more than this share of the rows with a chance of about 1 in 100 (2.296 / k^0.9723 for k items).
RANK_ERROR_99 = 2.296 / K ** 0.9723
# Four times that: what tests and the comparison with exact ranks allow, out of reach in practice.
RANK_BOUND = 4 * RANK_ERROR_99
# Partial sketches of one group are merged in this many groups first.
FIRST_MERGES = 32


def trip_metrics() -> dict[str, Column]:
    """The profile's values: fare, distance and duration in minutes."""
    return {"fare_amount": F.col("fare_amount"), "trip_distance": F.col("trip_distance"),
            "duration_minutes": elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")) / F.lit(60.0)}


def value_sketches(df: DataFrame, metrics: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """``(keys, metric, n, sketch)``: one sketch of each metric in every group; nulls and NaN do not count.

    Values are sketched map-side. As a group can have as many partial sketches as there are tasks, they are merged in
    ``FIRST_MERGES`` groups and then once more, so no task merges all of a hot month. A metric without values in a group has no row.
    """
    values = df.select(*keys, *(c.cast("double").alias(name) for name, c in metrics.items())).unpivot(
        list(keys), list(metrics), "metric", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    part = F.pmod(F.spark_partition_id(), F.lit(FIRST_MERGES)).alias("part")
    first = values.withColumn("part", part).groupBy(*keys, "metric", "part").agg(
        F.count(F.lit(1)).alias("n"), F.call_function("kll_sketch_agg_double", "value", F.lit(K)).alias("sketch"))
    return merged_sketches(first, [*keys, "metric"])


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n, sketch)`` of coarser groups."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.call_function("kll_merge_agg_double", "sketch").alias("sketch"))


def sketch_percentiles(sketches: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, metric, probability, n, value)`` over all given sketches, of whatever months.

    The value at probability p has a rank of p times n, off by at most ``RANK_ERROR_99`` of n in 99 of 100 cases. It is one of the
    values; the exact operator's answer for the same probability may be another one that close in rank.
    """
    whole = merged_sketches(sketches, [*keys, "metric"])
    wanted = F.array(*(F.lit(float(p)) for p in probabilities))
    told = F.arrays_zip(wanted.alias("probability"), F.call_function(
        "kll_sketch_get_quantile_double", F.col("sketch"), wanted).alias("value"))
    return whole.select(*keys, "metric", "n", F.explode(told).alias("told")).select(
        *keys, "metric", F.col("told.probability").alias("probability"), "n", F.col("told.value").alias("value"))
