"""The ledger: what is done is not done again, what was cut off or changed is."""

import time
import uuid
from dataclasses import replace

import pytest

from fareline import fixtures
from fareline.plans import monthly
from fareline.plans.ledger import Ledger, input_prints, settings_print
from fareline.plans.monthly import backfill
from fareline.schemas import MART_TABLES, REJECTED_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake
from fareline.sources.trips import trip_path
from fareline.sources.zones import read_zones

SF = "/root/testdata/sf0.001"
MONTHS = fixtures.MONTHS[:2]


@pytest.fixture
def place(spark, tmp_path):
    root = str(tmp_path / "raw")
    fixtures.write_month_files(spark, SF, root, MONTHS)
    zones = read_zones(spark, fixtures.write_zone_csv(spark, SF, root))
    lake = Lake(spark, str(tmp_path / "lake"), f"l{uuid.uuid4().hex}")
    return root, zones, lake, Ledger(spark, f"{lake.root}/load_ledger")


def run(place, months=MONTHS, **options):
    root, zones, lake, ledger = place
    settings = {"limits": fixtures.LIMITS, "min_rows": 0, **options}
    return [(c.service_type, c.period) for c in backfill(lake, root, zones, ["yellow"], months, ledger=ledger, **settings)]


def stored(lake):
    return {t.name: sorted(str(tuple(r)) for r in lake.read(t).collect()) for t in (TRIPS_TABLE, REJECTED_TABLE, *MART_TABLES)}


def test_what_is_done_is_skipped(spark, place):
    assert run(place, MONTHS[:1]) == [("yellow", "2024-01")]
    assert run(place) == [("yellow", "2024-02")]
    before = stored(place[2])
    assert run(place) == []
    assert stored(place[2]) == before
    assert {(r.period, r.runs, r.done) for r in place[3].states().collect()} == {("2024-01", 1, True), ("2024-02", 1, True)}


def test_a_run_that_died_between_two_tables_is_redone(spark, place, monkeypatch):
    """February's trips are stored, its rejects are not: only February is loaded again, to what one whole run gives."""
    assert run(place) == [("yellow", "2024-01"), ("yellow", "2024-02")]
    expected = stored(place[2])
    fixtures.write_month_files(spark, SF, place[0], MONTHS[1:], ("yellow",))  # the same rows in a new file
    real = Lake.replace_periods

    def dying(self, layout, df, periods):
        if layout is REJECTED_TABLE:
            raise RuntimeError("the driver is gone")
        real(self, layout, df, periods)

    monkeypatch.setattr(Lake, "replace_periods", dying)
    with pytest.raises(RuntimeError):
        run(place)
    state = {r.period: (r.steps, r.done) for r in place[3].states().collect()}
    assert state["2024-01"] == (["marts", "rejects", "trips"], True)
    assert "rejects" not in state["2024-02"][0] and not state["2024-02"][1]
    monkeypatch.setattr(Lake, "replace_periods", real)
    loaded = []
    load = monthly.load_months
    monkeypatch.setattr(monthly, "load_months", lambda lake, paths, *rest: loaded.append(list(paths)) or load(lake, paths, *rest))
    assert run(place) == [("yellow", "2024-02")]
    assert loaded == [[trip_path(place[0], "yellow", 2024, 2)]]
    assert stored(place[2]) == expected
    assert run(place) == []


def test_a_run_that_died_before_its_marts_is_redone(place, monkeypatch):
    monkeypatch.setattr(monthly, "refresh_marts", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        run(place, MONTHS[:1])
    monkeypatch.undo()
    assert run(place, MONTHS[:1]) == [("yellow", "2024-01")]


def test_changed_input_and_settings_are_loaded_again(spark, place):
    run(place)
    fixtures.write_month_files(spark, SF, place[0], MONTHS[1:], ("yellow",), "fare_amount > 20")
    assert run(place) == [("yellow", "2024-02")]
    stricter = replace(fixtures.LIMITS, min_fare=5.0)
    assert run(place, limits=stricter) == [("yellow", "2024-01"), ("yellow", "2024-02")]
    assert run(place, limits=stricter) == []
    assert run(place) == [("yellow", "2024-01"), ("yellow", "2024-02")]


def test_fingerprints(spark, place):
    root, zones, _, _ = place
    paths = [trip_path(root, s, *m) for s in ("yellow", "green") for m in MONTHS]
    first = input_prints(spark, paths)
    assert first == input_prints(spark, list(reversed(paths))) and len(set(first.values())) == 4
    time.sleep(0.01)
    fixtures.write_month_files(spark, SF, root, MONTHS[:1], ("green",))
    second = input_prints(spark, paths)
    assert {k for k in first if first[k] != second[k]} == {("green", 2024, 1)}
    told = settings_print(zones, fixtures.LIMITS, "reject")
    assert told == settings_print(zones.repartition(3), fixtures.LIMITS, "reject")
    assert told != settings_print(zones.filter("LocationID > 1"), fixtures.LIMITS, "reject")
    assert told != settings_print(zones, fixtures.LIMITS, "sql")


def test_an_empty_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "none"))
    assert ledger.states().collect() == []
    assert ledger.pending([("yellow", 2024, 1)], {("yellow", 2024, 1): "x"}, "y") == [("yellow", 2024, 1)]
