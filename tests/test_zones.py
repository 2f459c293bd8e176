import pytest
from helpers import plan_of, trips, zone_rows

from fareline.functions.rules import Thresholds
from fareline.operators.zones import join_zones, orphan_locations
from fareline.sources.zones import read_zones


def test_join_fills_both_roles_and_keeps_unmatched_trips(spark):
    zones = zone_rows(spark, (132, "Queens", "JFK", "Airports"), (236, "Manhattan", "UES", "Yellow"))
    df = join_zones(trips(spark, {}, {"do_location_id": 5}), zones)
    assert sorted((r.pu_borough, r.pu_zone, r.do_borough or "-", r.do_zone or "-") for r in df.collect()) == [
        ("Queens", "JFK", "-", "-"), ("Queens", "JFK", "Manhattan", "UES")]


@pytest.mark.parametrize("rows, message", [
    (((132, "Queens", "JFK", "a"), (132, "Bronx", "B", "b")), "several zones for location id 132"),
    (((132, "Queens", "JFK", "a"), (132, None, "GHOST", None)), "several zones for location id 132"),
    (((132, "Queens", "JFK", "a"), (None, "Bronx", "B", "b")), "zone without location id"),
])
def test_repeated_and_absent_ids_end_the_join(spark, rows, message):
    with pytest.raises(Exception, match=message):
        join_zones(trips(spark, {}), zone_rows(spark, *rows)).collect()


def test_repeated_ids_outside_the_range_do_not_matter(spark):
    zones = zone_rows(spark, (132, "Queens", "JFK", "a"), (999, "x", "y", "z"), (999, "x", "y", "z"))
    assert join_zones(trips(spark, {}), zones).count() == 1


def test_one_broadcast_serves_both_joins_without_shuffling_trips(spark, tmp_path):
    path = str(tmp_path / "t")
    trips(spark, {}).write.parquet(path)
    zones = zone_rows(spark, (132, "Queens", "JFK", "a"))
    df = join_zones(spark.read.parquet(path), zones)
    df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    assert "ReusedExchange" in plan


def test_a_wide_id_range_is_not_forced_into_a_broadcast(spark):
    zones = zone_rows(spark, (132, "Queens", "JFK", "a"))
    df = join_zones(trips(spark, {}), zones, Thresholds(max_location_id=10_000_000))
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    assert df.first()["pu_borough"] == "Queens"


def test_orphans_ignore_nulls(spark):
    zones = zone_rows(spark, (1, "a", "b", "c"), (2, "a", "b", "c"))
    df = trips(spark, {"pu_location_id": 1, "do_location_id": 9}, {"pu_location_id": None, "do_location_id": 2},
               {"pu_location_id": 5, "do_location_id": 9})
    assert sorted(tuple(r) for r in orphan_locations(df, zones).collect()) == [
        ("dropoff", 3, 2, 66.67), ("pickup", 3, 1, 33.33)]


def test_zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                    '264,"Unknown","N/A","N/A"\n265,"N/A","Outside","N/A"\n')
    rows = {r.LocationID: (r.Borough, r.Zone) for r in read_zones(spark, str(path)).collect()}
    assert rows == {1: ("EWR", "Newark Airport"), 264: ("Unknown", None), 265: (None, "Outside")}
    as_text = {r.LocationID: r.Borough for r in read_zones(spark, str(path), missing=None).collect()}
    assert as_text[265] == "N/A"


def test_zone_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("locationid,Zone,Borough,service_zone\n1,Newark Airport,EWR,EWR\n")
    assert [tuple(r) for r in read_zones(spark, str(path)).collect()] == [(1, "EWR", "Newark Airport", "EWR")]


@pytest.mark.parametrize("text, message", [
    ("LocationID,Borough,Zone,service_zone\nabc,Queens,JFK,x\n", "unreadable location id: abc"),
    ("LocationID,Borough,Zone,service_zone\n,Queens,JFK,x\n", "unreadable location id"),
    ("LocationID,Borough,Zone\n1,Queens,JFK\n", "lacks the columns"),
])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_zone_csv_fails(spark, tmp_path, text, message, ansi):
    path = tmp_path / "zones.csv"
    path.write_text(text)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=message):
            read_zones(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
