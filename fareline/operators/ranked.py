"""Running totals over ranked values: what a threshold would do, and how far two periods lie apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.functions.rules import (
    INVALID_DURATION, INVALID_FARE, REJECT, SUSPICIOUS_DISTANCE, Rule, Thresholds, trip_rules,
)
from fareline.functions.scalars import elapsed_seconds, percent
from fareline.sources.scratch import new_scratch_dir


def running_totals(counted: DataFrame, key: str, value: str, measures: Sequence[str]) -> DataFrame:
    """``counted`` with, for each measure m, ``m_upto`` (of all values up to the row's) and ``m_all`` by key.

    ``counted`` has one row per key and value. Rows are stored in ranges of about equal size; a range's own running totals are
    a window within it, and what came before it is a sum over the sizes of the ranges, a few rows a task.
    """
    path = new_scratch_dir(counted.sparkSession, "ranked")
    counted.repartitionByRange(key, value).withColumn("range", F.spark_partition_id()).write.parquet(path)
    schema = counted.withColumn("range", F.lit(0)).schema
    stored = counted.sparkSession.read.schema(schema).parquet(path)

    sizes = stored.groupBy(key, "range").agg(*(F.sum(m).alias(m) for m in measures))
    earlier = Window.partitionBy(key).orderBy("range")
    whole = Window.partitionBy(key)
    offsets = sizes.select(key, "range", *(
        (F.sum(m).over(earlier) - F.col(m)).alias(f"{m}_before") for m in measures), *(
        F.sum(m).over(whole).alias(f"{m}_all") for m in measures))
    inside = Window.partitionBy(key, "range").orderBy(value)
    run = stored.select("*", *(F.sum(m).over(inside).alias(f"{m}_inside") for m in measures))
    # One row per key and task of the range partitioning.
    met = run.join(F.broadcast(offsets), [key, "range"])
    return met.select(*counted.columns, *(
        (F.col(f"{m}_before") + F.col(f"{m}_inside")).alias(f"{m}_upto") for m in measures), *(f"{m}_all" for m in measures))


def judged_values(limits: Thresholds = Thresholds()) -> dict[str, tuple[Column, bool, Column]]:
    """By reason code the value its threshold judges, whether the threshold is a lower bound, and what fails at any threshold.

    Fares fail below it; durations (in seconds) and distances fail above it, and at their other, fixed end.
    """
    seconds = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return {INVALID_FARE: (F.col("fare_amount"), True, F.lit(False)),
            INVALID_DURATION: (seconds, False, seconds <= 0),
            SUSPICIOUS_DISTANCE: (F.col("trip_distance"), False, F.col("trip_distance") < 0)}


def threshold_curve(trips: DataFrame, year: int | Column | None = None, month: int | Column | None = None,
                    limits: Thresholds = Thresholds()) -> DataFrame:
    """What rejecting would look like with every value of a column as its threshold; all other thresholds as in ``limits``.

    Rows ``(reason_code, threshold, first_failures, rejected, total_rows, reject_pct)``, one for each distinct value of fare, duration
    in seconds, and distance. ``first_failures`` counts the rows that would carry this reason code (all rules before it hold),
    ``rejected`` all rows that would be rejected for whatever reason, and ``reject_pct`` their share. Nulls and NaN fail at any
    threshold and are none themselves (the ``"reject"`` policy). An empty frame gives no rows.

    One pass counts each value, with how many of its rows the rules before it and all other rules let through; the curve is their
    running total, so a threshold costs a row and not a scan.
    """
    rules = trip_rules(year, month, limits, REJECT)

    def passed(rule: Rule) -> Column:
        return F.coalesce(rule.holds, F.lit(False))

    described = judged_values(limits)
    judged = []
    for i, rule in enumerate(rules):
        if rule.reason_code not in described:
            continue
        value, low, never = described[rule.reason_code]
        value = value.cast("double")
        lost = F.coalesce(never | F.isnan(value), F.lit(True)) | value.isNull()
        before = _all(passed(r) for r in rules[:i])
        others = before & _all(passed(r) for r in rules[i + 1:])
        judged.append(F.struct(
            F.lit(rule.reason_code).alias("reason_code"), F.lit(low).alias("low"),
            F.when(~F.isnan(value), value).alias("threshold"), lost.alias("lost"), before.alias("before"), others.alias("others")))
    rows = trips.select(F.explode(F.array(*judged)).alias("j")).select("j.*")

    def count(condition: Column) -> Column:
        return F.count_if(condition)

    counted = rows.groupBy("reason_code", "low", "threshold").agg(
        F.count(F.lit(1)).alias("n"), count(F.col("before") & ~F.col("lost")).alias("first"),
        count(F.col("others") & ~F.col("lost")).alias("only"), count(F.col("before") & F.col("lost")).alias("first_lost"),
        count(F.col("others")).alias("others"), count(F.col("others") & F.col("lost")).alias("only_lost"))
    measures = ["n", "first", "only", "first_lost", "others", "only_lost"]
    run = running_totals(counted, "reason_code", "threshold", measures).filter(F.col("threshold").isNotNull())

    def failing(name: str) -> Column:
        """Rows of ``name`` that the threshold itself fails: those below it, or those above it."""
        below = F.col(f"{name}_upto") - F.col(name)
        return F.when(F.col("low"), below).otherwise(F.col(f"{name}_all") - F.col(f"{name}_upto"))

    first = failing("first") + F.col("first_lost_all")
    rejected = F.col("n_all") - F.col("others_all") + failing("only") + F.col("only_lost_all")
    return run.select(
        "reason_code", "threshold", first.alias("first_failures"), rejected.alias("rejected"), F.col("n_all").alias("total_rows")
    ).withColumn("reject_pct", percent(F.col("rejected"), F.col("total_rows")))


def _all(conditions) -> Column:
    held = F.lit(True)
    for condition in conditions:
        held = held & condition
    return held


def period_drift(left: DataFrame, right: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """The largest distance between the distributions of two periods, metric by metric.

    Rows ``(metric, left_rows, right_rows, distance, at_value)``: the two-sample maximum distance of the cumulative shares, and
    the smallest value where it is reached. Nulls do not count, NaN comes last. A metric that one period has no values of has no
    distance. Values are counted before they are ranked, so periods of any size meet as counts.
    """
    def values(df: DataFrame, side: str) -> DataFrame:
        return df.select(*(c.cast("double").alias(name) for name, c in metrics.items())).unpivot(
            [], list(metrics), "metric", "value").filter(F.col("value").isNotNull()).withColumn("side", F.lit(side))

    both = values(left, "left").unionByName(values(right, "right"))
    counted = both.groupBy("metric", "value").agg(
        F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r"))
    run = running_totals(counted, "metric", "value", ["l", "r"])
    apart = F.abs(F.try_divide(F.col("l_upto").cast("double"), F.col("l_all").cast("double"))
                  - F.try_divide(F.col("r_upto").cast("double"), F.col("r_all").cast("double")))
    far = run.withColumn("distance", apart).groupBy("metric").agg(
        F.max("l_all").alias("left_rows"), F.max("r_all").alias("right_rows"),
        F.max(F.when(F.col("distance").isNotNull(), F.struct("distance", (-F.col("value")).alias("minus")))).alias("far"))
    return far.select("metric", "left_rows", "right_rows", F.col("far.distance").alias("distance"),
                      (-F.col("far.minus")).alias("at_value"))
