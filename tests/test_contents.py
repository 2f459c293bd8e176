"""The contents check, the schema timeline, lasting views, and how tables are clustered and ordered."""

import random
import uuid
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareline import fixtures
from fareline.functions.scalars import interleaved
from fareline.operators.contents import SHARED_COLUMNS, multiset_checksum, same_contents
from fareline.plans import monthly
from fareline.plans.marts import Models
from fareline.plans.monthly import backfill, load_months, register_models, write_outcome
from fareline.plans.views import create_views
from fareline.queries import conformed
from fareline.schemas import CONFORMED, QUALITY_TABLE, REJECTED_TABLE, TRIPS_TABLE
from fareline.sources.lake import Lake
from fareline.sources.timeline import intervals, schema_timeline
from fareline.sources.trips import trip_path
from fareline.sources.zones import read_zones

SF = "/root/testdata/sf0.001"


# --- contents ---
def test_checksums_know_rows_not_their_order(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, 1.5), (None, "", 0.0)]
    kind = "x long, y string, z double"
    names = ["x", "y", "z"]

    def told(some):
        return tuple(multiset_checksum(spark.createDataFrame(some, kind).repartition(3), names).first())

    first = told(rows)
    assert first == told(rows[::-1]) and first[0] == 4
    for changed in (rows[1:], [*rows[:3], (None, None, 0.0)], [(1, "a", None), (2, None, None), (2, None, 1.5), (None, "", 0.0)],
                    [(2, "a", None), (1, "a", None), (1, None, 1.5), (None, "", 0.0)]):
        assert told(changed) != first
    assert told([]) == (0, 0, 0)
    whole = spark.createDataFrame(rows, kind)
    parts = [spark.createDataFrame(some, kind) for some in (rows[:1], rows[1:])]
    assert tuple(same_contents(whole, *parts, columns=names).first()) == (4, 4, True)
    assert same_contents(whole, parts[0], parts[0], columns=names).first().passed is False


def test_one_swapped_value_after_the_write_is_found(spark, tmp_path, monkeypatch):
    """Two fares change places in the stored rows: all counts hold, the contents do not."""
    real = monthly.write_checked

    def swapping(df, path):
        stored = real(df, path)
        if not path.endswith("valid"):
            return stored
        a, b = (r.fare_amount for r in stored.select("fare_amount").distinct().orderBy("fare_amount").limit(2).collect())
        fare = F.col("fare_amount")
        changed = stored.withColumn("fare_amount", F.when(fare == a, b).when(fare == b, a).otherwise(fare))
        return real(changed, f"{path}-changed")

    def report():
        return {r.outcome: r for r in write_outcome(conformed(spark, SF), str(tmp_path / uuid.uuid4().hex)).collect()}

    clean = report()
    assert all(r.passed for r in clean.values()) and set(clean) == {"valid", "rejected", "contents"}
    monkeypatch.setattr(monthly, "write_checked", swapping)
    found = report()
    assert found["valid"].passed and found["rejected"].passed and not found["contents"].passed
    assert found["contents"].rows == found["contents"].expected
    assert "fare_amount" in SHARED_COLUMNS and "service_type" in SHARED_COLUMNS


def test_contents_under_sql_nulls(spark, tmp_path):
    """Rows without a verdict are in neither outcome and are not missed."""
    outcome = conformed(spark, SF, "sql")
    assert outcome.counts.first().lost_rows > 0
    assert all(r.passed for r in write_outcome(outcome, str(tmp_path)).collect())


# --- timeline ---
def test_intervals_end_where_a_column_changes_or_is_gone(spark):
    rows = [("yellow", date(2024, m, 1), "fee", name, kind, 0) for m, name, kind in (
        (1, "Fee", "int"), (2, "Fee", "int"), (4, "Fee", "int"), (5, "fee", "int"), (6, "fee", "bigint"), (8, "fee", "bigint"))]
    rows += [("yellow", date(2024, m, 1), "id", "id", "int", 1) for m in (1, 2, 4, 5, 6, 7, 8)]  # no file in March
    rows += [("green", date(2024, 3, 1), "fee", "Fee", "int", 0), ("green", date(2024, 3, 1), "fee", "fee", "int", 1)]
    columns = spark.createDataFrame(rows, "service_type string, month date, column_name string, raw_name string, type string, position int")
    found = sorted((r.service_type, r.column_name, r.raw_name, r.type, r.first_month.month, r.last_month.month, r.months)
                   for r in intervals(columns).collect())
    assert found == sorted([
        ("yellow", "fee", "Fee", "int", 1, 4, 3), ("yellow", "fee", "fee", "int", 5, 5, 1), ("yellow", "fee", "fee", "bigint", 6, 6, 1),
        ("yellow", "fee", "fee", "bigint", 8, 8, 1), ("yellow", "id", "id", "int", 1, 8, 7),
        ("green", "fee", "Fee", "int", 3, 3, 1), ("green", "fee", "fee", "int", 3, 3, 1)])


def test_timeline_reads_footers_only(spark, tmp_path):
    paths = fixtures.write_month_files(spark, SF, str(tmp_path))
    jobs = "timeline" + uuid.uuid4().hex
    spark.sparkContext.setJobGroup(jobs, "")
    try:
        rows = schema_timeline(spark, paths).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.type for r in rows if r.column_name == "passenger_count"} == {"int", "double"}
    assert schema_timeline(spark, []).collect() == []


# --- clustering ---
def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (511, 511), (900, -4), (None, 2)], "a long, b long")
    found = [r[0] for r in rows.select(interleaved(F.col("a"), F.col("b"))).collect()]

    def plain(a, b):
        return sum(((a >> i) & 1) << (2 * i + 1) | ((b >> i) & 1) << (2 * i) for i in range(9))

    assert found == [plain(*pair) for pair in ((0, 0), (1, 0), (0, 1), (3, 5), (511, 511), (511, 0), (0, 2))]


def row_groups(lake, layout, column, value):
    """Row groups of the stored files, and those whose range of the column holds the value."""
    every, hit = 0, 0
    for file in lake.read(layout).inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for group in range(meta.num_row_groups):
            told = meta.row_group(group).column(at).statistics
            every, hit = every + 1, hit + (told is None or not told.has_min_max or told.min <= value <= told.max)
    return every, hit


def test_location_filters_skip_row_groups(spark, tmp_path):
    """The interleaved key lets a filter on either location skip most row groups, without more files."""
    boroughs = F.element_at(F.array(*map(F.lit, ("Bronx", "Brooklyn", "Manhattan", "Queens"))), (F.col("pu") % 4 + 1).cast("int"))
    rows = spark.range(60_000, numPartitions=4).select(
        (F.rand(1) * 260 + 1).cast("long").alias("pu"), (F.rand(2) * 260 + 1).cast("long").alias("do"), F.rand(3).alias("fare_amount"))
    rows = rows.select(
        F.lit("yellow").alias("service_type"), F.lit(date(2024, 1, 5)).alias("pickup_date"), F.lit(date(2024, 1, 1)).alias("ingestion_date"),
        F.col("pu").alias("pu_location_id"), F.col("do").alias("do_location_id"), boroughs.alias("pu_borough"), "fare_amount")
    rows = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CONFORMED.fields))
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(1 << 14))
    shares = {}
    try:
        for name, keys in (("plain", ()), ("clustered", TRIPS_TABLE.cluster_keys)):
            layout = type(TRIPS_TABLE)(**{**TRIPS_TABLE.__dict__, "cluster_keys": keys})
            lake = Lake(spark, str(tmp_path / name), f"c{uuid.uuid4().hex}")
            lake.replace_period(layout, rows, {"service_type": "yellow", "period": "2024-01"})
            found = {column: row_groups(lake, layout, column, value) for column, value in (
                ("pu_location_id", 77), ("do_location_id", 77), ("pu_borough", "Queens"))}
            shares[name] = {column: hit / every for column, (every, hit) in found.items()}
            shares[name]["files"] = len(lake.read(layout).inputFiles())
            assert found["pu_location_id"][0] > 30
    finally:
        conf.unset("parquet.block.size")
    plain, clustered = shares["plain"], shares["clustered"]
    assert clustered["files"] <= plain["files"]
    assert clustered["pu_borough"] <= plain["pu_borough"] + 0.05 < 0.4
    assert clustered["pu_location_id"] < 0.3 < 0.9 < plain["pu_location_id"], shares
    assert clustered["do_location_id"] < 0.6 < 0.9 < plain["do_location_id"], shares


# --- views and order ---
@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    fixtures.write_month_files(spark, SF, root)
    return root, read_zones(spark, fixtures.write_zone_csv(spark, SF, root))


def bag(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_views_last_and_show_what_is_stored_now(spark, tmp_path, raw):
    root, zones = raw
    lake = Lake(spark, str(tmp_path / "lake"), f"v{uuid.uuid4().hex}")
    load_months(lake, [trip_path(root, "yellow", 2024, 1)], zones, fixtures.LIMITS)
    assert create_views(lake) == ["stg_trips", "int_trips_enriched", "int_data_quality"]
    other = spark.newSession()
    first = other.sql(f"SELECT count(*) FROM `{lake.database}`.`int_trips_enriched`").first()[0]
    load_months(lake, [trip_path(root, "yellow", 2024, 2)], zones, fixtures.LIMITS)
    models = Models(lambda: lake.read(TRIPS_TABLE), lambda: lake.read(REJECTED_TABLE))
    for name in ("stg_trips", "int_trips_enriched", "int_data_quality"):
        view = other.table(f"`{lake.database}`.`{name}`")
        assert view.dtypes == models[name].dtypes
        assert bag(view) == bag(models[name]) != []
    assert other.sql(f"SELECT count(*) FROM `{lake.database}`.`int_trips_enriched`").first()[0] > first > 0
    register_models(lake)
    assert spark.table("stg_trips").count() == lake.read(TRIPS_TABLE).count()


def test_the_quality_mart_is_read_in_order(spark, tmp_path, raw):
    root, zones = raw
    lake = Lake(spark, str(tmp_path / "lake"), f"o{uuid.uuid4().hex}")
    backfill(lake, root, zones, ("yellow", "green"), fixtures.MONTHS, limits=fixtures.LIMITS, min_rows=0)
    rows = [tuple(r) for r in lake.read(QUALITY_TABLE).collect()]
    key = QUALITY_TABLE.schema.names.index
    assert rows == sorted(rows, key=lambda r: (-r[key("ingestion_month")].toordinal(), -r[key("rejected_count")], r[key("service_type")],
                                               r[key("reason_code")]))
    create_views(lake)
    assert [tuple(r) for r in spark.sql(f"SELECT * FROM `{lake.database}`.`monthly_data_quality`").collect()] == rows
    for file in lake.read_whole(QUALITY_TABLE).inputFiles():
        counts = [r[0] for r in spark.read.parquet(file).select("rejected_count").collect()]
        assert counts == sorted(counts, reverse=True)


def test_random_rows_replace_and_add(spark, tmp_path):
    rng = random.Random(1)
    lake = Lake(spark, str(tmp_path / "lake"), f"a{uuid.uuid4().hex}")
    base = {f.name: None for f in CONFORMED.fields}
    rows = spark.createDataFrame([tuple({**base, "service_type": "yellow", "pickup_date": date(2024, 1, rng.randrange(1, 4)),
                                         "ingestion_date": date(2024, 1, 1)}[n] for n in CONFORMED.names) for _ in range(20)], CONFORMED)
    period = {"service_type": "yellow", "period": "2024-01"}
    lake.replace_period(TRIPS_TABLE, rows, period)
    lake.add_rows(TRIPS_TABLE, rows.limit(5), [period])
    assert lake.read(TRIPS_TABLE).count() == 25
    with pytest.raises(Exception, match="not among those loaded"):
        lake.add_rows(TRIPS_TABLE, rows, [{**period, "period": "2024-02"}])
