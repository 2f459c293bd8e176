"""Every registered query against its SQL, and the shape of the plans."""

import oracle_compare
import pytest
from helpers import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from fareline import fixtures, queries
from fareline.functions.scalars import mean2, total2
from fareline.plans.conform import conform_files, conform_month
from fareline.plans.marts import build_marts
from fareline.sources.lake import Lake
from fareline.sources.trips import read_months

SF = "/root/testdata/sf0.001"
QUERIES = queries.QUERIES
ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return oracle_compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    problems, rows = oracle_compare.compare(spark, duck, QUERIES[name], ORACLE[name], SF)
    assert not problems
    assert rows > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_expected_counts_of_the_fixture(spark):
    sf = "/root/testdata/sf0.01"
    reject = {r.reason_code: r.rejected_count for r in QUERIES["reason_codes"](spark, sf).collect()}
    assert reject == {"null_datetime": 91, "wrong_period": 100, "invalid_fare": 565, "invalid_duration": 539,
                      "suspicious_distance": 234, "invalid_location_id": 668}
    counts = QUERIES["conform_counts_sql_nulls"](spark, sf).first()
    assert (counts.raw_rows, counts.valid_rows, counts.rejected_rows, counts.lost_rows) == (10_000, 7_803, 2_116, 81)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_in_any_plan(spark, name, monkeypatch):
    """Neither in what a query returns nor in what it stores on the way."""
    frames, store = [], Lake.replace_periods

    def watched(lake, layout, df, periods):
        frames.append(df)
        store(lake, layout, df, periods)

    monkeypatch.setattr(Lake, "replace_periods", watched)
    frames.append(QUERIES[name](spark, SF))
    if name in ("load_counts", "monthly_run", "backfill_revenue", "backfill_health", "replace_period", "stored_views"):
        assert len(frames) > 2
    for plan in map(plan_of, frames):
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_marts_do_not_depend_on_partitioning(spark):
    """Rounded averages come out equal however rows are spread over tasks."""
    sf = "/root/testdata/sf0.01"
    raw = fixtures.raw_trips(spark, sf)

    def mart(trips):
        outcome = conform_month(trips, fixtures.zones(spark, sf), F.col("service_type"), 2024, 1, "f", queries.LIMITS)
        return sorted(map(tuple, build_marts(outcome.valid, outcome.rejected)["agg_monthly_zone_revenue"].collect()))

    expected = mart(raw)
    assert len(expected) == 50
    for spread in (raw.repartition(7), raw.repartition(5, "fare_amount"), raw.orderBy(F.desc("total_amount"))):
        assert mart(spread) == expected


@pytest.fixture(scope="module")
def month_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("file") / "yellow_tripdata_2024-01.parquet")
    fixtures.raw_trips(spark, SF).drop("service_type").write.parquet(path)
    return path


def test_conforming_a_file_prunes_pushes_down_and_does_not_shuffle_trips(spark, month_file):
    outcome = conform_month(spark.read.parquet(month_file), fixtures.zones(spark, SF), "yellow", 2024, 1, "f",
                            queries.LIMITS)
    valid = plan_of(outcome.valid)
    trips_scan = next(line for line in valid.splitlines() if "FileScan parquet" in line and "fare_amount" in line)
    pushed = trips_scan.split("PushedFilters: ")[1]
    for predicate in ("GreaterThanOrEqual(fare_amount,2.5)", "IsNotNull(tpep_pickup_datetime)",
                      "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)"):
        assert predicate in pushed
    # the only shuffle groups the zone dimension
    assert valid.count("Exchange hashpartitioning") <= 2
    assert all("location_id" in line or "groupingexpression" in line
               for line in valid.splitlines() if "Exchange hashpartitioning" in line)
    rejected = plan_of(outcome.rejected)
    assert "Exchange" not in rejected
    assert "tip_amount" not in rejected


def test_many_files_push_the_months_down_and_match_no_text_per_row(spark, tmp_path):
    paths = fixtures.write_month_files(spark, SF, str(tmp_path))
    valid = plan_of(conform_files(read_months(spark, paths), fixtures.zones(spark, SF), queries.LIMITS,
                                  months=fixtures.MONTHS).valid)
    assert "regexp_extract" not in valid
    scans = [line.split("PushedFilters: ")[1] for line in valid.splitlines() if "_pickup_datetime" in line
             and "FileScan parquet" in line]
    assert scans
    for pushed in scans:
        assert "pickup_datetime,2024-01-01T00:00)" in pushed and "pickup_datetime,2024-04-01T00:00)" in pushed


def test_totals_do_not_depend_on_the_order_of_addition(spark):
    """Two million amounts that together pass 1e7, over several partitionings."""
    rows = spark.range(2_000_000).select((F.pmod(F.xxhash64("id"), F.lit(2_062_001)) / 100.0).alias("x"))
    found = {rows.repartition(n).agg(total2(F.col("x")), mean2(F.col("x"))).first() for n in (1, 3, 7, 16, 40)}
    assert len(found) == 1
    cents = rows.agg(F.sum(F.rint(F.col("x") * 100).cast("long"))).first()[0]
    assert found.pop()[0] == cents / 100 > 1e7


def test_totals_of_odd_values(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(total2(F.col("x")), mean2(F.col("x"))).first()

    assert tuple(total(None, None)) == (None, None)
    assert tuple(total(0.1, 0.2, None)) == (0.3, 0.15)
    assert tuple(total(-0.1, -2.55)) == (-2.65, -1.33)
    assert str(total(1.0, float("nan"))[0]) == "nan"
    assert total(1.0, float("inf"))[0] == float("inf")
    assert total(1e16, 1.0)[0] == 1e16 + 1.0
    assert total(61.794999999999995, 0.0)[0] == 61.79 or total(61.795, 0.0)[0] in (61.79, 61.8)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_files_with_instants_do_not_depend_on_the_session(spark, tmp_path, zone):
    """Times stored as instants are judged and stored as UTC wall clock times on both paths."""
    path = str(tmp_path / "trip-data/yellow/2024/01/yellow_tripdata_2024-01.parquet")
    raw = fixtures.raw_trips(spark, SF).drop("service_type")
    names = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    raw.withColumns({n: F.col(n).cast("timestamp") for n in names}).write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        zones = fixtures.zones(spark, SF)
        expected = conform_month(raw, zones, "yellow", 2024, 1, "f", queries.LIMITS).valid
        single = conform_month(spark.read.parquet(path), zones, "yellow", 2024, 1, "f", queries.LIMITS).valid
        many = conform_files(read_months(spark, [path]), zones, queries.LIMITS).valid
        bags = [sorted(str(tuple(r)[:-1]) for r in df.collect()) for df in (expected, single, many)]
        assert bags[0] == bags[1] == bags[2] != []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
