"""Stored quantile sketches against exact ranks."""

import uuid

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from fareline import fixtures
from fareline.operators import sketches
from fareline.operators.profile import exact_percentiles
from fareline.plans.monthly import load_months, store_sketches
from fareline.schemas import SKETCH_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake
from fareline.sources.zones import read_zones

SF = "/root/testdata/sf0.01"
PROBABILITIES = (0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999)


def test_ranks_are_within_the_bound(spark):
    """200,000 skewed values in 12 months: sketches of any months are as near as one of them all."""
    rows = spark.range(200_000, numPartitions=7).select(
        (F.col("id") % 12).alias("month"), F.exp(F.rand(5) * 10).alias("x"), (F.col("id") % 3).cast("double").alias("few"))
    rows = rows.withColumn("x", F.when(F.col("month") == 3, F.lit(None)).otherwise(F.col("x")))
    stored = sketches.value_sketches(rows, {"x": F.col("x"), "few": F.col("few")}, ["month"])
    assert {(r.month, r.metric) for r in stored.collect()} == {(m, k) for m in range(12) for k in ("x", "few")} - {(3, "x")}
    for months in ([0], [1, 2, 3], list(range(12))):
        told = sketches.sketch_percentiles(stored.filter(F.col("month").isin(months)), PROBABILITIES).collect()
        chosen = rows.filter(F.col("month").isin(months))
        for r in told:
            known = chosen.filter(F.col(r.metric).isNotNull()).agg(
                F.count(F.lit(1)), F.count_if(F.col(r.metric) < r.value), F.count_if(F.col(r.metric) <= r.value)).first()
            assert r.n == known[0]
            assert known[1] / r.n - sketches.RANK_BOUND <= r.probability <= known[2] / r.n + sketches.RANK_BOUND
    assert sketches.RANK_ERROR_99 < 0.002


def test_small_tables_are_exact(spark):
    """Below k values nothing is left out of a sketch, so the exact operator gives the same."""
    rows = spark.range(1500).select((F.col("id") % 2).alias("month"), (F.col("id") * 7 % 1500).cast("double").alias("x"))
    told = sketches.sketch_percentiles(sketches.value_sketches(rows, {"x": F.col("x")}, ["month"]), PROBABILITIES)
    exact = exact_percentiles(rows, {"x": F.col("x")}, PROBABILITIES)
    assert {(r.probability, r.value) for r in told.collect()} == {(r.probability, r.value) for r in exact.collect()}


def test_values_that_are_none(spark):
    rows = spark.createDataFrame([(1, None), (1, float("nan")), (2, 3.0)], "month int, x double")
    stored = sketches.value_sketches(rows, {"x": F.col("x")}, ["month"])
    assert [(r.month, r.n) for r in stored.collect()] == [(2, 1)]
    assert sketches.sketch_percentiles(stored.limit(0), PROBABILITIES).collect() == []


def test_percentiles_of_stored_months_read_sketches_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    paths = fixtures.write_month_files(spark, SF, root)
    zones = read_zones(spark, fixtures.write_zone_csv(spark, SF, root))
    lake = Lake(spark, str(tmp_path / "lake"), f"s{uuid.uuid4().hex}")
    load_months(lake, paths, zones, fixtures.LIMITS)
    months = [(s, *m) for s in ("yellow", "green") for m in fixtures.MONTHS]
    store_sketches(lake, months)
    stored = lake.read(SKETCH_TABLE)
    assert stored.count() == 18
    told = sketches.sketch_percentiles(stored.filter("pickup_month_date < DATE '2024-03-01'"), (0.5,), ["service_type"])
    plan = plan_of(told)
    assert f"{SKETCH_TABLE.name}" in plan and f"/{TRIPS_TABLE.name}" not in plan
    assert "PartitionFilters: [" in plan or "pickup_month_date" in plan
    assert len(told.collect()) == 6
    before = {(r.service_type, r.pickup_month_date, r.metric): r.n for r in stored.collect()}
    store_sketches(lake, months[:1])
    assert {(r.service_type, r.pickup_month_date, r.metric): r.n for r in lake.read(SKETCH_TABLE).collect()} == before


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_groups(spark, n):
    rows = spark.range(n).select(F.lit(1).alias("month"), F.lit(2.0).alias("x"))
    told = sketches.sketch_percentiles(sketches.value_sketches(rows, {"x": F.col("x")}, ["month"]), (0.0, 1.0)).collect()
    assert [r.value for r in told] == [2.0] * 2 * n
