"""Every operator as a query over one folder of the generic tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import fixtures
from fareline.functions import rules as R
from fareline.operators import expectations, profile, quality, ranked, reconcile, sketches
from fareline.operators.zones import join_zones, orphan_locations
from fareline.plans.conform import Conformed, conform_files, conform_month
from fareline.plans.ledger import Ledger
from fareline.plans.marts import Models
from fareline.plans.monthly import (
    backfill, load_month, load_months, rebuild_marts, refresh_marts, register_models, run_month, store_sketches, trips_period,
    write_outcome,
)
from fareline.plans.replay import replay_rejects as replay
from fareline.plans.states import revenue_by_period
from fareline.schemas import (
    FACT_TABLE, HOURLY_TABLE, REJECTED_TABLE, REVENUE_STATE_TABLE, REVENUE_TABLE, SKETCH_TABLE, TRIPS_TABLE,
)
from fareline.sources.lake import Lake
from fareline.sources.scratch import new_scratch_dir
from fareline.sources.timeline import schema_timeline as timeline
from fareline.sources.trips import read_months, trip_path
from fareline.sources.zones import read_zones

Query = Callable[[SparkSession, str], DataFrame]

LIMITS = fixtures.LIMITS
MIN_ROWS = 50
UNREACHED_ROWS = 1_000_000_000
SERVICES = ("yellow", "green")


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(fixtures.raw_trips(spark, sf_dir))


def january_rules(null_policy: str = R.REJECT) -> list[R.Rule]:
    return R.trip_rules(fixtures.YEAR, fixtures.MONTH, LIMITS, null_policy)


def conformed(spark: SparkSession, sf_dir: str, null_policy: str = R.REJECT) -> Conformed:
    return conform_month(fixtures.raw_trips(spark, sf_dir), fixtures.zones(spark, sf_dir), F.col("service_type"),
                         fixtures.YEAR, fixtures.MONTH, fixtures.SOURCE_FILE, LIMITS, null_policy)


def models(spark: SparkSession, sf_dir: str) -> Models:
    outcome = conformed(spark, sf_dir)
    return Models(lambda: outcome.valid, lambda: outcome.rejected)


def model(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir)[name]


def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.normalize_columns(fixtures.raw_trips(spark, sf_dir))


def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.cast_types(normalize_columns(spark, sf_dir))


def add_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The added columns with the drop-off they belong to."""
    df = reconcile.add_metadata(reconciled(spark, sf_dir), F.col("service_type"), fixtures.SOURCE_FILE,
                                date(fixtures.YEAR, fixtures.MONTH, 1))
    return df.select("pickup_datetime", "dropoff_datetime", "pickup_date", "service_type", "ingestion_date",
                     "source_file")


def rule_verdicts(columns: tuple[str, ...], holds: Callable[[], Column], spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-valued verdict of one rule with the columns it looks at, for every row."""
    return reconciled(spark, sf_dir).select(*columns, holds().alias("holds"))


def split_valid(null_policy: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_valid(reconciled(spark, sf_dir), january_rules(null_policy))


def split_rejected(null_policy: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_rejected(reconciled(spark, sf_dir), january_rules(null_policy), null_policy)


def reason_codes(null_policy: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_reasons(split_rejected(null_policy, spark, sf_dir))


def conform_counts(null_policy: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(spark, sf_dir, null_policy).counts


def zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = quality.keep_valid(reconciled(spark, sf_dir), january_rules())
    return join_zones(valid, fixtures.zones(spark, sf_dir), LIMITS).select(
        "pickup_datetime", "pu_location_id", "pu_borough", "pu_zone", "do_location_id", "do_borough", "do_zone")


def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = models(spark, sf_dir)
    reports = expectations.check_models({name: every[name] for name in expectations.EXPECTATIONS})
    return reports.filter(F.col("test") == "not_null")


def expect_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = models(spark, sf_dir)[expectations.STAGED]
    tests = [e for e in expectations.EXPECTATIONS[expectations.STAGED] if e.accepted is not None]
    return expectations.check(expectations.STAGED, staged, tests)


def row_count_gate(min_rows: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.volume_gate(conformed(spark, sf_dir).valid, fixtures.YEAR, fixtures.MONTH, min_rows)


def zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones written as a CSV with its columns in another order, and read back by name."""
    path = new_scratch_dir(spark, "zones")
    fixtures.zones(spark, sf_dir).select("service_zone", "Zone", "LocationID", "Borough").write.csv(path, header=True)
    return read_zones(spark, path)


def compare_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the first two months, side by side."""
    trips = fixtures.raw_trips_by_month(spark, sf_dir)
    left, right = (reconcile.reconcile(trips.filter(F.col("file_month") == month)) for _, month in fixtures.MONTHS[:2])
    return profile.compare_profiles(left, right)


def multi_month_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six raw files of three shapes, read as one frame and conformed in one plan."""
    root = new_scratch_dir(spark, "months")
    paths = fixtures.write_month_files(spark, sf_dir, root)
    return conform_files(read_months(spark, paths), fixtures.zones(spark, sf_dir), LIMITS,
                         months=fixtures.MONTHS).valid


def _new_lake(spark: SparkSession, label: str) -> Lake:
    root = new_scratch_dir(spark, label)
    return Lake(spark, f"{root}/lake", root.rsplit("/", 1)[-1].replace("-", "_"))


def replace_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load January of both services, then load yellow again under a stricter fare rule.

    The second load must replace all of yellow's January and nothing of green's.
    """
    lake = _new_lake(spark, "replace")
    zones = fixtures.zones(spark, sf_dir)
    trips = fixtures.raw_trips(spark, sf_dir)
    stricter = R.Thresholds(min_fare=20.0, max_location_id=LIMITS.max_location_id)
    for service_type, limits in (("yellow", LIMITS), ("green", LIMITS), ("yellow", stricter)):
        raw = trips.filter(F.col("service_type") == service_type)
        outcome = conform_month(raw, zones, service_type, fixtures.YEAR, fixtures.MONTH, fixtures.SOURCE_FILE, limits)
        lake.replace_period(TRIPS_TABLE, outcome.valid, trips_period(service_type, fixtures.YEAR, fixtures.MONTH))
    return lake.read(TRIPS_TABLE).groupBy("service_type", "pickup_date").agg(
        F.count(F.lit(1)).alias("trips"), F.min("fare_amount").alias("lowest_fare"),
        F.max("fare_amount").alias("highest_fare"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load one month of each service and report what the loads counted on the stored tables."""
    lake = _new_lake(spark, "load")
    zones = fixtures.zones(spark, sf_dir)
    trips = fixtures.raw_trips(spark, sf_dir)
    loaded = []
    for service_type in ("yellow", "green"):
        raw = trips.filter(F.col("service_type") == service_type)
        loaded.append(load_month(lake, raw, zones, service_type, fixtures.YEAR, fixtures.MONTH,
                                 fixtures.SOURCE_FILE, LIMITS))
    rows = [(c.service_type, c.period, c.raw_rows, c.valid_rows, c.rejected_rows, c.lost_rows) for c in loaded]
    return spark.createDataFrame(
        rows, "service_type string, period string, raw_rows long, valid_rows long, rejected_rows long, lost_rows long")


def _month_files(spark: SparkSession, sf_dir: str, months=fixtures.MONTHS) -> tuple[str, DataFrame]:
    """Raw monthly files of both services below a new folder, and the zones read from a CSV there."""
    root = new_scratch_dir(spark, "raw")
    fixtures.write_month_files(spark, sf_dir, root, months)
    return root, read_zones(spark, fixtures.write_zone_csv(spark, sf_dir, root))


def monthly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full runs of January for both services from raw files; the stored hourly mart."""
    root, zones = _month_files(spark, sf_dir, fixtures.MONTHS[:1])
    lake = _new_lake(spark, "month")
    for service_type in SERVICES:
        run_month(lake, root, zones, service_type, *fixtures.MONTHS[0], limits=LIMITS, min_rows=MIN_ROWS)
    return lake.read(HOURLY_TABLE)


def backfill_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill of three months of both services from raw files; the stored revenue mart."""
    root, zones = _month_files(spark, sf_dir)
    lake = _new_lake(spark, "backfill")
    backfill(lake, root, zones, SERVICES, fixtures.MONTHS, limits=LIMITS, min_rows=MIN_ROWS)
    return lake.read(REVENUE_TABLE)


def _loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    root, zones = _month_files(spark, sf_dir)
    lake = _new_lake(spark, "history")
    load_months(lake, [trip_path(root, service, *month) for service in SERVICES for month in fixtures.MONTHS], zones,
                LIMITS)
    return lake


def backfill_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load three months of both services, then build the health mart over the whole stored history."""
    return rebuild_marts(_loaded_lake(spark, sf_dir))["agg_monthly_pipeline_health"]


def stored_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per part of the day out of the enriched view, next to the months' rejects, in SQL."""
    lake = _loaded_lake(spark, sf_dir)
    register_models(lake)
    return spark.sql(f"""
        SELECT service_type, time_of_day, count(*) AS trips, max(trip_duration_minutes) AS longest,
               max(rejected) AS rejected
        FROM int_trips_enriched JOIN (
          SELECT service_type, count(*) AS rejected FROM {lake.qualified(REJECTED_TABLE)} GROUP BY service_type)
        USING (service_type) GROUP BY service_type, time_of_day""")


def local_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected rows written to plain Parquet, read back and checked against the counts of the raw rows."""
    root = new_scratch_dir(spark, "roundtrip")
    return write_outcome(conformed(spark, sf_dir), root)


def _all_months() -> list[tuple[str, int, int]]:
    return [(service, *month) for service in SERVICES for month in fixtures.MONTHS]


def agg_quarterly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone revenue of the quarter out of the stored sums and counts of its months."""
    lake = _loaded_lake(spark, sf_dir)
    refresh_marts(lake, _all_months())
    return revenue_by_period(lake.read(REVENUE_STATE_TABLE), "quarter")


def sketch_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of three months from stored sketches, and whether their exact rank in the trips is within the bound."""
    lake = _loaded_lake(spark, sf_dir)
    store_sketches(lake, _all_months())
    told = sketches.sketch_percentiles(lake.read(SKETCH_TABLE), profile.DURATION_PROBABILITIES)
    metrics = sketches.trip_metrics()
    values = lake.read(TRIPS_TABLE).select(*(c.cast("double").alias(name) for name, c in metrics.items())).unpivot(
        [], list(metrics), "metric", "x")
    ranks = values.join(F.broadcast(told), "metric").groupBy("metric", "probability", "n").agg(  # a row a percentile
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto"))
    within = (F.col("below") / F.col("n") - sketches.RANK_BOUND <= F.col("probability")) & (
        F.col("probability") <= F.col("upto") / F.col("n") + sketches.RANK_BOUND)
    return ranks.select("metric", "probability", "n", within.alias("within_bound"))


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months of both services loaded, one raw file replaced, and the same backfill again: what the ledger and the trips tell."""
    root, zones = _month_files(spark, sf_dir)
    lake = _new_lake(spark, "resumed")
    ledger = Ledger(spark, f"{lake.root}/load_ledger")

    def run() -> None:
        backfill(lake, root, zones, SERVICES, fixtures.MONTHS, limits=LIMITS, min_rows=0, ledger=ledger)

    run()
    fixtures.write_month_files(spark, sf_dir, root, fixtures.MONTHS[1:2], ("yellow",), "fare_amount >= 20")
    run()
    stored = lake.read(TRIPS_TABLE).groupBy("service_type", F.date_format("pickup_date", "yyyy-MM").alias("period")).agg(
        F.count(F.lit(1)).alias("trips"))
    return ledger.states().join(stored, ["service_type", "period"]).select("service_type", "period", "runs", "done", "trips")


REASONS = (
    (R.NULL_DATETIME, "no pickup or drop-off time"), (R.WRONG_PERIOD, "picked up in another month"),
    (R.INVALID_FARE, "fare below the least"), (R.INVALID_DURATION, "not longer than nothing or longer than a day"),
    (R.SUSPICIOUS_DISTANCE, "negative or very long distance"), (R.INVALID_LOCATION_ID, "unknown location"),
    ("not_a_reason", "no row has it"))
STRICT = R.Thresholds(min_fare=20.0, max_distance_miles=6.0, max_duration_minutes=120, max_location_id=24)


def replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months of both services loaded under strict thresholds, their rejects judged again under the usual ones; valid rows
    and rejects by reason then."""
    root, zones = _month_files(spark, sf_dir)
    lake = _new_lake(spark, "replayed")
    ledger = Ledger(spark, f"{lake.root}/load_ledger")
    backfill(lake, root, zones, SERVICES, fixtures.MONTHS, limits=STRICT, min_rows=0, ledger=ledger)
    replay(lake, ledger, root, zones, _all_months(), STRICT, LIMITS)
    month = F.col("ingestion_date").alias("month")
    valid = lake.read(TRIPS_TABLE).groupBy("service_type", month).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("passenger_count").alias("passengers")).withColumn("outcome", F.lit("valid"))
    refused = lake.read(REJECTED_TABLE).groupBy("service_type", month, F.col("reason_code").alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("passenger_count").alias("passengers"))
    return valid.unionByName(refused)


def schema_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, cases and types of the columns of six raw files over their months, from the footers."""
    root, _ = _month_files(spark, sf_dir)
    return timeline(spark, [trip_path(root, *one) for one in _all_months()])


def lasting_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by borough and part of the day out of the enriched view, in another session, with a month stored after the view was made."""
    root, zones = _month_files(spark, sf_dir)
    lake = _new_lake(spark, "views")
    load_months(lake, [trip_path(root, service, *fixtures.MONTHS[0]) for service in SERVICES], zones, LIMITS)
    register_models(lake)
    load_months(lake, [trip_path(root, service, *fixtures.MONTHS[1]) for service in SERVICES], zones, LIMITS)
    return spark.newSession().sql(f"""
        SELECT service_type, pickup_month, time_of_day, count(*) AS trips, max(trip_duration_minutes) AS longest,
               max(tip_percentage) AS highest_tip, max(revenue_per_mile) AS highest_revenue
        FROM `{lake.database}`.`int_trips_enriched` GROUP BY ALL""")


def stored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact table, partitioned by day and clustered: one month's rows of one borough, by day and zone."""
    root, zones = _month_files(spark, sf_dir, fixtures.MONTHS[:1])
    lake = _new_lake(spark, "facts")
    backfill(lake, root, zones, SERVICES, fixtures.MONTHS[:1], limits=LIMITS, min_rows=0)
    facts = lake.read(FACT_TABLE, *(trips_period(service, *fixtures.MONTHS[0]) for service in SERVICES))
    return facts.filter(F.col("pu_borough") == "ASIA").groupBy("service_type", "pickup_date", "pu_zone").agg(
        F.count(F.lit(1)).alias("trips"), F.max("trip_duration_minutes").alias("longest"),
        F.max("tip_percentage").alias("highest_tip"))


def described_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows given in memory, a description of each reason code in its order, with the rejects that carry it, none included."""
    described = spark.createDataFrame(
        [(i, code, text) for i, (code, text) in enumerate(REASONS, 1)], "priority int, reason_code string, description string")
    counted = reason_codes(R.REJECT, spark, sf_dir)
    return described.join(counted, "reason_code", "left").select(
        "priority", "reason_code", "description", F.coalesce("rejected_count", F.lit(0)).alias("rejected_count"))


def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.threshold_curve(reconciled(spark, sf_dir), fixtures.YEAR, fixtures.MONTH, LIMITS)


def period_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the values of the first two months lie apart."""
    trips = fixtures.raw_trips_by_month(spark, sf_dir)
    left, right = (reconcile.reconcile(trips.filter(F.col("file_month") == month)) for _, month in fixtures.MONTHS[:2])
    return ranked.period_drift(left, right, sketches.trip_metrics())


QUERIES: dict[str, Query] = {
    "scan_raw": fixtures.raw_trips,
    "normalize_columns": normalize_columns,
    "cast_types": cast_types,
    "fill_optional": reconciled,
    "add_metadata": add_metadata,
    "rule_fare": partial(rule_verdicts, ("fare_amount",), R.fare_valid),
    "rule_distance": partial(rule_verdicts, ("trip_distance",), partial(R.distance_valid, LIMITS)),
    "rule_duration": partial(rule_verdicts, ("pickup_datetime", "dropoff_datetime"), R.duration_valid),
    "rule_location": partial(rule_verdicts, ("pu_location_id", "do_location_id"), partial(R.locations_valid, LIMITS)),
    "rule_datetime": partial(rule_verdicts, ("pickup_datetime", "dropoff_datetime"), R.datetimes_present),
    "rule_period": partial(rule_verdicts, ("pickup_datetime",),
                           partial(R.pickup_in_period, fixtures.YEAR, fixtures.MONTH)),
    "split_valid": partial(split_valid, R.REJECT),
    "split_rejected": partial(split_rejected, R.REJECT),
    "reason_codes": partial(reason_codes, R.REJECT),
    "split_valid_sql_nulls": partial(split_valid, R.SQL),
    "split_rejected_sql_nulls": partial(split_rejected, R.SQL),
    "reason_codes_sql_nulls": partial(reason_codes, R.SQL),
    "conform_counts": partial(conform_counts, R.REJECT),
    "conform_counts_sql_nulls": partial(conform_counts, R.SQL),
    "zone_join": zone_join,
    "conformed_trips": lambda spark, sf_dir: conformed(spark, sf_dir).valid,
    "rejected_trips": lambda spark, sf_dir: conformed(spark, sf_dir).rejected,
    "stg_trips": partial(model, "stg_trips"),
    "int_trips_enriched": partial(model, "int_trips_enriched"),
    "fact_trips": partial(model, "fact_trips"),
    "agg_hourly_demand_by_zone": partial(model, "agg_hourly_demand_by_zone"),
    "agg_monthly_zone_revenue": partial(model, "agg_monthly_zone_revenue"),
    "int_data_quality": partial(model, "int_data_quality"),
    "agg_monthly_data_quality": partial(model, "agg_monthly_data_quality"),
    "agg_monthly_pipeline_health": partial(model, "agg_monthly_pipeline_health"),
    "quality_profile": lambda spark, sf_dir: profile.quality_profile(reconciled(spark, sf_dir)),
    "percentiles": lambda spark, sf_dir: profile.value_percentiles(reconciled(spark, sf_dir)),
    "duration_percentiles": lambda spark, sf_dir: profile.duration_percentiles(reconciled(spark, sf_dir)),
    "orphan_locations": lambda spark, sf_dir: orphan_locations(reconciled(spark, sf_dir),
                                                               fixtures.zones(spark, sf_dir)),
    "expect_not_null": expect_not_null,
    "expect_accepted_values": expect_accepted_values,
    "row_count_gate": partial(row_count_gate, MIN_ROWS),
    "row_count_gate_failing": partial(row_count_gate, UNREACHED_ROWS),
    "zone_csv": zone_csv,
    "compare_profiles": compare_profiles,
    "multi_month_union": multi_month_union,
    "replace_period": replace_period,
    "load_counts": load_counts,
    "local_roundtrip": local_roundtrip,
    "monthly_run": monthly_run,
    "backfill_revenue": backfill_revenue,
    "backfill_health": backfill_health,
    "stored_views": stored_views,
    "load_ledger": load_ledger,
    "sketch_percentiles": sketch_percentiles,
    "agg_quarterly_zone_revenue": agg_quarterly_zone_revenue,
    "threshold_curve": threshold_curve,
    "period_drift": period_drift,
    "replay_rejects": replay_rejects,
    "schema_timeline": schema_timeline,
    "lasting_views": lasting_views,
    "stored_facts": stored_facts,
    "described_reasons": described_reasons,
}
