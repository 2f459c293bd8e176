"""The monthly run and the backfill from raw files to marts, and their gates."""

import uuid

import pytest
from pyspark.sql import functions as F

from fareline import fixtures
from fareline.operators.expectations import ExpectationFailed
from fareline.plans.monthly import backfill, load_months, rebuild_marts, register_models, run_month, trips_period
from fareline.schemas import FACT_TABLE, HEALTH_TABLE, HOURLY_TABLE, MART_TABLES, REJECTED_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake
from fareline.sources.zones import read_zones

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    fixtures.write_month_files(spark, SF, root)
    return root, read_zones(spark, fixtures.write_zone_csv(spark, SF, root))


def new_lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"m{uuid.uuid4().hex}")


def bag(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_backfill_then_repeat_the_middle_month(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    loads = backfill(lake, root, zones, "yellow", fixtures.MONTHS, limits=fixtures.LIMITS, min_rows=10)
    assert [c.period for c in loads] == ["2024-01", "2024-02", "2024-03"]
    for counts in loads:
        assert counts.lost_rows == 0 and counts.raw_rows == counts.valid_rows + counts.rejected_rows > 0
        assert 0 < counts.reject_rate_pct < 100
    before = {t.name: bag(lake.read(t)) for t in (TRIPS_TABLE, *MART_TABLES)}
    run_month(lake, root, zones, "yellow", 2024, 2, limits=fixtures.LIMITS, min_rows=10)
    assert {t.name: bag(lake.read(t)) for t in (TRIPS_TABLE, *MART_TABLES)} == before
    assert lake.read(TRIPS_TABLE).select("ingestion_date").distinct().count() == 3

    # refreshing month by month gives what rebuilding everything gives
    rebuilt = rebuild_marts(lake)
    for layout in MART_TABLES:
        assert bag(rebuilt[layout.name]) == before[layout.name], layout.name

    # a second service leaves the first one's rows as they were
    run_month(lake, root, zones, "green", 2024, 1, limits=fixtures.LIMITS, min_rows=10)
    assert bag(lake.read(HOURLY_TABLE).filter("service_type = 'yellow'")) == before[HOURLY_TABLE.name]
    assert lake.read(HEALTH_TABLE).count() == 4


def test_volume_gate_stops_before_the_marts(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    with pytest.raises(ExpectationFailed, match="expected at least"):
        run_month(lake, root, zones, "yellow", 2024, 1, limits=fixtures.LIMITS)
    assert lake.read(TRIPS_TABLE, **trips_period("yellow", 2024, 1)).count() > 0
    assert not lake.exists(FACT_TABLE)


def test_duplicate_zones_stop_before_loading(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    for load in (lambda z: run_month(lake, root, z, "yellow", 2024, 1, limits=fixtures.LIMITS, min_rows=1),
                 lambda z: load_months(lake, [fixtures.trip_path(root, "yellow", 2024, 1)], z, fixtures.LIMITS)):
        with pytest.raises(Exception, match="several zones for location id"):
            load(zones.unionByName(zones))
    assert not lake.exists(TRIPS_TABLE)


def test_missing_input_changes_nothing(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_month(lake, root, zones, "yellow", 2019, 1, limits=fixtures.LIMITS, min_rows=1)
    assert not lake.exists(TRIPS_TABLE)


def test_backfill_stores_what_single_months_store(spark, tmp_path, raw):
    root, zones = raw
    at_once, one_by_one = new_lake(spark, tmp_path / "a"), new_lake(spark, tmp_path / "b")
    # a month that was fuller before loses the days the new load lacks
    run_month(at_once, root, zones, "green", 2024, 2, limits=fixtures.Thresholds(
        min_fare=0, max_location_id=26), min_rows=1)
    loads = backfill(at_once, root, zones, ("yellow", "green"), fixtures.MONTHS, limits=fixtures.LIMITS, min_rows=1)
    singly = [run_month(one_by_one, root, zones, service, year, month, limits=fixtures.LIMITS, min_rows=1)
              for service, year, month in ((c.service_type, *map(int, c.period.split("-"))) for c in loads)]
    assert loads == singly
    for table in (TRIPS_TABLE, REJECTED_TABLE, *MART_TABLES):
        assert bag(at_once.read(table)) == bag(one_by_one.read(table)), table.name


def test_backfill_jobs_do_not_grow_with_the_months(spark, tmp_path, raw):
    root, zones = raw

    def jobs(months):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "")
        try:
            backfill(new_lake(spark, tmp_path / group), root, zones, "yellow", months, limits=fixtures.LIMITS, min_rows=1)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, three = jobs(fixtures.MONTHS[:1]), jobs(fixtures.MONTHS)
    # each of the three files has a schema of its own: a footer and the broadcast of its file names in two loads
    assert 0 < three <= one + 3 * (len(fixtures.MONTHS) - 1)


def test_every_month_below_the_gate_is_named(spark, tmp_path, raw):
    root, zones = raw
    with pytest.raises(ExpectationFailed, match="2024-01.*2024-02.*2024-03"):
        backfill(new_lake(spark, tmp_path), root, zones, "yellow", fixtures.MONTHS, limits=fixtures.LIMITS)


def test_another_session_reads_what_was_stored(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    run_month(lake, root, zones, "yellow", 2024, 1, limits=fixtures.LIMITS, min_rows=1)
    other = Lake(spark.newSession(), lake.root, f"m{uuid.uuid4().hex}")
    before = bag(other.read(HOURLY_TABLE))
    assert before == bag(rebuild_marts(other)["agg_hourly_demand_by_zone"]) != []
    run_month(lake, root, zones, "yellow", 2024, 2, limits=fixtures.LIMITS, min_rows=1)
    assert len(bag(other.read(HOURLY_TABLE))) > len(before)
    register_models(other)
    assert bag(other.spark.table("stg_trips")) == bag(lake.read(TRIPS_TABLE))
    assert other.spark.table(other.qualified(HOURLY_TABLE)).count() == lake.read(HOURLY_TABLE).count()
    assert other.spark.sql("SELECT 1 FROM int_data_quality").count() > 0


def test_a_failed_write_leaves_the_old_month(spark, tmp_path, raw):
    root, zones = raw
    lake = new_lake(spark, tmp_path)
    run_month(lake, root, zones, "yellow", 2024, 1, limits=fixtures.LIMITS, min_rows=1)
    before = bag(lake.read(TRIPS_TABLE))
    # the last row in order fails after others have been written
    bad = lake.read(TRIPS_TABLE).withColumn("tip_amount", F.when(
        F.col("pickup_datetime") == F.lit(max(r.pickup_datetime for r in lake.read(TRIPS_TABLE).collect())),
        F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("tip_amount")))
    with pytest.raises(Exception, match="broken row"):
        lake.replace_period(TRIPS_TABLE, bad, trips_period("yellow", 2024, 1))
    assert bag(lake.read(TRIPS_TABLE)) == before
