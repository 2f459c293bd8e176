"""Stored tables: replacing one period leaves every other row alone."""

import uuid
from datetime import date, datetime

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from fareline.operators.expectations import volume_gate
from fareline.plans.monthly import rejects_period, trips_period
from fareline.schemas import CONFORMED, FACT_TABLE, QUARANTINE, REJECTED_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake, run_together, write_checked
from fareline.sources.scratch import CHECKPOINT_DIR, new_scratch_dir


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"t{uuid.uuid4().hex}")


def conformed(spark, service_type, *days, **more):
    base = {f.name: None for f in CONFORMED.fields}
    rows = []
    for day in days:
        when = datetime.fromisoformat(day)
        rows.append({**base, "service_type": service_type, "pickup_datetime": when, "pickup_date": when.date(),
                     "ingestion_date": when.date().replace(day=1), "pu_borough": "Queens", **more})
    return spark.createDataFrame([tuple(r[n] for n in CONFORMED.names) for r in rows], CONFORMED)


def days(lake, **period):
    return sorted((r.service_type, str(r.pickup_date)) for r in lake.read(TRIPS_TABLE, **period).collect())


def load(lake, service_type, year, month, *picked, **more):
    lake.replace_period(TRIPS_TABLE, conformed(lake.spark, service_type, *picked, **more) if picked else
                        conformed(lake.spark, service_type, "2024-01-01").limit(0),
                        trips_period(service_type, year, month))


def test_first_load_creates_the_table(lake):
    assert not lake.exists(TRIPS_TABLE)
    load(lake, "yellow", 2024, 1, "2024-01-01", "2024-01-02")
    assert days(lake) == [("yellow", "2024-01-01"), ("yellow", "2024-01-02")]
    assert lake.read(TRIPS_TABLE).columns == CONFORMED.names


def test_same_month_again_leaves_no_stale_day(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01", "2024-01-02", "2024-01-31")
    load(lake, "yellow", 2024, 1, "2024-01-02")
    assert days(lake) == [("yellow", "2024-01-02")]


def test_other_months_and_services_stay(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01")
    load(lake, "green", 2024, 1, "2024-01-01")
    load(lake, "yellow", 2024, 2, "2024-02-01")
    load(lake, "yellow", 2024, 1, "2024-01-05")
    assert days(lake) == [("green", "2024-01-01"), ("yellow", "2024-01-05"), ("yellow", "2024-02-01")]


def test_an_empty_load_empties_the_period(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01")
    load(lake, "green", 2024, 1, "2024-01-01")
    load(lake, "yellow", 2024, 1)
    assert days(lake) == [("green", "2024-01-01")]


def test_a_session_in_dynamic_mode_replaces_the_same_way(lake):
    lake.spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        load(lake, "yellow", 2024, 1, "2024-01-01", "2024-01-02")
        load(lake, "yellow", 2024, 1, "2024-01-03")
        assert days(lake) == [("yellow", "2024-01-03")]
        assert lake.spark.conf.get(OVERWRITE_MODE) == "dynamic"
    finally:
        lake.spark.conf.set(OVERWRITE_MODE, "static")


def test_rejects_are_replaced_by_ingestion_date(lake):
    base = {f.name: None for f in QUARANTINE.fields}

    def rejects(service_type, month, n):
        rows = [{**base, "service_type": service_type, "reason_code": "invalid_fare",
                 "ingestion_date": date(2024, month, 1)}] * n
        df = lake.spark.createDataFrame([tuple(r[c] for c in QUARANTINE.names) for r in rows], QUARANTINE)
        lake.replace_period(REJECTED_TABLE, df, rejects_period(service_type, 2024, month))

    rejects("yellow", 1, 3)
    rejects("green", 1, 2)
    rejects("yellow", 2, 4)
    rejects("yellow", 1, 1)
    counts = lake.read(REJECTED_TABLE).groupBy("service_type", "ingestion_date").count().collect()
    assert sorted((r[0], r[1].month, r[2]) for r in counts) == [("green", 1, 2), ("yellow", 1, 1), ("yellow", 2, 4)]


def test_rows_of_another_service_are_refused(lake):
    with pytest.raises(Exception, match="not among those loaded"):
        lake.replace_period(TRIPS_TABLE, conformed(lake.spark, "green", "2024-01-01"), trips_period("yellow", 2024, 1))


def test_a_null_in_a_required_column_is_refused(lake):
    bad = conformed(lake.spark, "yellow", "2024-01-01").withColumn("ingestion_date", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="null in required column ingestion_date"):
        lake.replace_period(TRIPS_TABLE, bad, trips_period("yellow", 2024, 1))


def test_the_whole_period_must_be_named(lake):
    with pytest.raises(ValueError):
        lake.replace_period(TRIPS_TABLE, conformed(lake.spark, "yellow", "2024-01-01"), {"service_type": "yellow"})


def test_a_new_catalog_finds_the_stored_partitions(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01")
    again = Lake(lake.spark, lake.root, f"t{uuid.uuid4().hex}")
    again.register(TRIPS_TABLE)
    again.register(TRIPS_TABLE)
    assert again.spark.table(again.qualified(TRIPS_TABLE)).count() == 1
    assert days(again) == [("yellow", "2024-01-01")]
    load(again, "yellow", 2024, 1, "2024-01-09")
    assert days(again) == [("yellow", "2024-01-09")]


def test_a_period_and_a_day_prune_partitions(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01", "2024-01-02")
    load(lake, "yellow", 2024, 2, "2024-02-01")
    one = lake.read(TRIPS_TABLE, **trips_period("yellow", 2024, 1)).filter(F.col("pickup_date") == date(2024, 1, 2))
    plan = plan_of(one)
    assert "PartitionFilters" in plan and "period" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert one.count() == 1
    assert len(one.inputFiles()) >= 1


def test_the_volume_gate_reads_one_month_of_partitions(lake):
    load(lake, "yellow", 2024, 1, "2024-01-01", "2024-01-31")
    load(lake, "yellow", 2024, 2, "2024-02-01")
    gate = volume_gate(lake.read(TRIPS_TABLE), 2024, 1, 2)
    filters = plan_of(gate).split("PartitionFilters: [")[1].split("]")[0]
    assert "pickup_date" in filters and "2024-01-01" in filters and "2024-02-01" in filters
    assert "ReadSchema: struct<>" in plan_of(gate)
    assert gate.first() == ("2024-01", 2, 2, True)


def test_a_hot_day_becomes_several_files(lake):
    """One day holds nearly all rows: its partition is split instead of landing in one task."""
    spark = lake.spark
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 100 == 0, F.lit(date(2024, 1, 2))).otherwise(F.lit(date(2024, 1, 1))).alias("pickup_date"),
        F.lit("yellow").alias("service_type"), F.lit(date(2024, 1, 1)).alias("ingestion_date"),
        F.rand(1).alias("fare_amount"), F.rand(2).alias("tip_amount"), F.rand(3).alias("total_amount"))
    rows = rows.repartition(8).select(*(F.col(f.name) if f.name in rows.columns else
                                        F.lit(None).cast(f.dataType).alias(f.name) for f in CONFORMED.fields))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "512k")
    try:
        lake.replace_period(TRIPS_TABLE, rows, trips_period("yellow", 2024, 1))
    finally:
        spark.conf.set(size, before)
    files = lake.read(TRIPS_TABLE).inputFiles()
    hot = [f for f in files if "pickup_date=2024-01-01" in f]
    assert len(hot) > 2
    assert lake.read(TRIPS_TABLE).count() == 200_000


def test_files_are_sorted_for_row_group_skipping(lake):
    """Days are gathered and boroughs ordered inside each file, with one sort in the insert."""
    spark = lake.spark
    boroughs = spark.range(3000).select(
        F.expr("date_add(DATE'2024-01-01', CAST(id % 2 AS INT))").alias("pickup_date"),
        F.element_at(F.array(*map(F.lit, ("Queens", "Bronx", "EWR"))), (F.col("id") % 3 + 1).cast("int"))
        .alias("pu_borough"),
        F.lit("yellow").alias("service_type"), F.lit(date(2024, 1, 1)).alias("ingestion_date"))
    rows = boroughs.repartition(6).select(*(F.col(f.name) if f.name in boroughs.columns else
                                            F.lit(None).cast(f.dataType).alias(f.name) for f in CONFORMED.fields))
    lake.replace_period(TRIPS_TABLE, rows, trips_period("yellow", 2024, 1))
    for path in lake.read(TRIPS_TABLE).inputFiles():
        stored = [r[0] for r in spark.read.parquet(path).select("pu_borough").collect()]
        assert stored == sorted(stored) and len(set(stored)) == 3


def test_fact_layout_keeps_month_number_and_period_apart(lake):
    rows = lake.spark.createDataFrame([], FACT_TABLE.schema)
    lake.replace_period(FACT_TABLE, rows, trips_period("yellow", 2024, 1))
    assert "pickup_month" in lake.read(FACT_TABLE).columns and "period" not in lake.read(FACT_TABLE).columns


def test_writes_run_together_and_failures_surface(spark):
    done = []

    def fail():
        raise RuntimeError("broken write")

    with pytest.raises(RuntimeError, match="broken write"):
        run_together(spark, fail, lambda: done.append(spark.range(3).count()))
    assert done == [3]


def test_plain_parquet_overwrite_is_read_back(spark, tmp_path):
    path = str(tmp_path / "plain")
    assert write_checked(spark.range(5), path).count() == 5
    assert write_checked(spark.range(3), path).count() == 3


def test_scratch_folder_follows_the_session(spark):
    before = spark.conf.get(CHECKPOINT_DIR, None)
    first, second = new_scratch_dir(spark, "x"), new_scratch_dir(spark, "x")
    assert first != second
    if before is not None:
        assert first.startswith(before)
