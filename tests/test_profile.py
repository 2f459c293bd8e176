import math
import random

import pytest
from helpers import trips
from pyspark.sql import functions as F

from fareline.operators.profile import (
    duration_percentiles, exact_percentiles, quality_profile, ranged_values, value_percentiles,
)

PROBABILITIES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0)


def brute_force(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    rows = exact_percentiles(df, {"v": F.col("v")}, PROBABILITIES).collect()
    assert {r.probability: r.value for r in rows} == {p: brute_force(values, p) for p in PROBABILITIES}
    assert len(rows) == len(PROBABILITIES)


def test_percentiles_against_brute_force(spark):
    rng = random.Random(7)
    check(spark, [round(rng.expovariate(0.1), 2) for _ in range(3000)] + [None] * 50)


def test_percentiles_with_one_hot_value(spark):
    rng = random.Random(8)
    check(spark, [2.5] * 1500 + [rng.uniform(-50, 50) for _ in range(1500)])


def test_percentiles_over_many_magnitudes(spark):
    rng = random.Random(9)
    check(spark, [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(2000)]
          + [0.0, -0.0, 1.7e308, -1.7e308, math.inf, -math.inf])


def test_percentiles_inside_one_bucket(spark):
    rng = random.Random(10)
    check(spark, [10 + rng.random() * 1e-6 for _ in range(2000)])


def test_percentiles_of_a_constant_and_of_nothing(spark):
    check(spark, [3.0] * 10)
    empty = spark.createDataFrame([(None,)], "v double")
    assert exact_percentiles(empty, {"v": F.col("v")}, PROBABILITIES).count() == 0


def test_nan_orders_last(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (math.inf,)], "v double")
    rows = exact_percentiles(df, {"v": F.col("v")}, (0.3, 0.6, 1.0)).collect()
    values = {r.probability: r.value for r in rows}
    assert values[0.3] == 1.0 and values[0.6] == math.inf and math.isnan(values[1.0])


def test_agrees_with_percentile_approx_at_full_accuracy(spark):
    rng = random.Random(11)
    df = spark.createDataFrame([(round(rng.gauss(12, 9), 2),) for _ in range(4000)], "fare_amount double")
    df = df.withColumn("trip_distance", F.col("fare_amount") / 3)
    probabilities = [0.01, 0.25, 0.5, 0.75, 0.99]
    expected = df.agg(*(F.percentile_approx(c, probabilities, 1_000_000).alias(c) for c in df.columns)).first()
    got = {(r.metric, r.probability): r.value for r in value_percentiles(df).collect()}
    for column in df.columns:
        assert [got[column, p] for p in probabilities] == expected[column]


def test_profile_counts(spark):
    df = trips(spark, {}, {"fare_amount": -1.0}, {"fare_amount": 0.0, "trip_distance": 0.0}, {"pu_location_id": None},
               {"dropoff_datetime": "2024-01-12 10:00:00"}, {"dropoff_datetime": "2024-01-10 10:00:00"},
               {"dropoff_datetime": None}, {"fare_amount": None})
    row = quality_profile(df).first()
    assert (row.total_rows, row.fare_negative, row.fare_zero, row.distance_lte_zero) == (8, 1, 1, 1)
    assert (row.null_pickup_location, row.null_dropoff_location) == (1, 0)
    assert (row.duration_lte_zero, row.duration_gt_24h, row.fare_min, row.fare_max) == (1, 1, -1.0, 10.5)
    assert (row.fare_negative_pct, row.distance_min, row.distance_max) == (12.5, 0.0, 5.0)


def test_profile_of_an_empty_file(spark):
    row = quality_profile(trips(spark, {}).limit(0)).first()
    assert (row.total_rows, row.fare_negative, row.fare_negative_pct) == (0, 0, None)


def test_duration_percentiles(spark):
    rows = duration_percentiles(trips(spark, {}, {"dropoff_datetime": "2024-01-10 10:00:30"})).collect()
    values = {r.probability: r.value for r in rows}
    assert values[0.5] == 0.5 and values[0.999] == 15.0


@pytest.mark.parametrize("metrics", [1, 2])
def test_percentiles_scan_the_rows_once(spark, tmp_path, metrics):
    path = str(tmp_path / "t")
    trips(spark, {}, {"fare_amount": 3.0}).write.parquet(path)
    names = ("fare_amount", "trip_distance")[:metrics]
    df = exact_percentiles(spark.read.parquet(path), {n: F.col(n) for n in names}, (0.5,))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    reused = final.count("ReusedExchange")
    # three uses of the counted values, of which all but one reuse the first one's shuffle
    assert final.count("FileScan parquet") - reused <= 1


@pytest.mark.parametrize("expression", [
    "pow(10D, -12D + 9D * rand(3))",                              # log-uniform, all below a thousandth
    "IF(id = 7, 1e12, 5D + rand(4) * 1e-9)",                      # a tight cluster and an outlier
    "IF(id % 3 = 0, 1D, id + 0D)",                                # one value with a third of the rows
])
def test_no_range_holds_much_more_than_its_share(spark, expression):
    """Ranges are as even for tiny, clustered and repeated values as for others."""
    values = spark.range(200_000).selectExpr(f"{expression} AS v")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged_values(values, {"v": F.col("v")}).groupBy("range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
