"""The command line, and independence from session settings."""

import logging
import uuid

import oracle_compare
import pytest

import __spark_entry__ as entry_point
from fareline import fixtures, jobs
from fareline.schemas import HOURLY_TABLE, REJECTED_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    fixtures.write_month_files(spark, SF, root)
    return ["--raw-root", root, "--zones", fixtures.write_zone_csv(spark, SF, root), "--year", "2024", "--month", "1"]


def test_conform_and_backfill(spark, tmp_path, files):
    database = f"j{uuid.uuid4().hex}"
    target = ["--lake", str(tmp_path / "lake"), "--database", database, "--min-rows", "10"]
    lake = Lake(spark, str(tmp_path / "lake"), database)
    jobs.main(["conform", *files, *target[:-2], "--service-type", "green"])
    assert lake.read(TRIPS_TABLE).count() > 0 and not lake.exists(HOURLY_TABLE)
    jobs.main(["backfill", *files, *target, "--months", "2"])
    loaded = lake.read(TRIPS_TABLE).select("service_type", "ingestion_date").distinct().collect()
    assert sorted((r[0], r[1].month) for r in loaded) == [("green", 1), ("yellow", 1), ("yellow", 2)]
    assert lake.read(HOURLY_TABLE).select("service_type").distinct().count() == 1
    assert lake.read(REJECTED_TABLE).filter("reason_code IS NULL").count() == 0


def test_backfill_resumes(spark, tmp_path, files, caplog):
    target = ["--lake", str(tmp_path / "lake"), "--database", f"j{uuid.uuid4().hex}", "--min-rows", "1", "--resume"]
    jobs.main(["backfill", *files, *target, "--months", "1"])
    with caplog.at_level(logging.INFO, logger="fareline"):
        jobs.main(["backfill", *files, *target, "--months", "2"])
    assert "period='2024-02'" in caplog.text and "period='2024-01'" not in caplog.text


def test_profile(spark, files, caplog):
    with caplog.at_level(logging.INFO, logger="fareline"):
        jobs.main(["profile", *files])
    text = caplog.text
    assert "fare_negative" in text and "duration_minutes" in text and "orphan_trips" in text


def test_profile_compares_two_months(spark, files, caplog):
    with caplog.at_level(logging.INFO, logger="fareline"):
        jobs.main(["profile", *files, "--other-year", "2024", "--other-month", "2"])
    assert "column congestion_surcharge: double, None" in caplog.text
    assert "fare_amount_p0.5" in caplog.text and "orphan_pickup_pct" in caplog.text


@pytest.mark.parametrize("setting, value", [("spark.sql.session.timeZone", "America/New_York"),
                                            ("spark.sql.ansi.enabled", "false")])
@pytest.mark.parametrize("name", ["rule_duration", "int_trips_enriched", "agg_hourly_demand_by_zone",
                                  "duration_percentiles", "rejected_trips"])
def test_results_do_not_depend_on_the_session(spark, setting, value, name):
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        problems, _ = oracle_compare.compare(spark, oracle_compare.connect(SF), entry_point.queries()[name],
                                             entry_point.oracle_sql()[name], SF)
        assert not problems
    finally:
        spark.conf.set(setting, before)
