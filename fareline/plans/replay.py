"""Judging quarantined rows again when thresholds are loosened, without loading their months anew."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.rules import (
    INVALID_DURATION, INVALID_FARE, INVALID_LOCATION_ID, REJECT, SUSPICIOUS_DISTANCE, Thresholds,
)
from fareline.plans.conform import conform_files
from fareline.plans.ledger import MARTS, REJECTS, TRIPS, Ledger, Month, input_prints, settings_print
from fareline.plans.monthly import refresh_marts, rejects_period, trips_period
from fareline.schemas import REJECTED_TABLE, ROW_ADDRESS, TRIPS_TABLE
from fareline.sources.lake import Lake
from fareline.sources.scratch import new_scratch_dir
from fareline.sources.trips import read_months, trip_path


class ReplayRefused(ValueError):
    """The stored rejects cannot be judged again this way; load the months instead."""


@dataclass(frozen=True)
class Replayed:
    """What a replay did: how many rows it judged, and how many of them are trips now."""

    judged_rows: int
    passed_rows: int


def loosened_reasons(old: Thresholds, new: Thresholds) -> set[str]:
    """Reason codes whose rules let more rows through under ``new``. A rule that is stricter raises: trips would have to go."""
    changes = {
        INVALID_FARE: [old.min_fare - new.min_fare],
        INVALID_DURATION: [new.max_duration_minutes - old.max_duration_minutes],
        SUSPICIOUS_DISTANCE: [new.max_distance_miles - old.max_distance_miles],
        INVALID_LOCATION_ID: [old.min_location_id - new.min_location_id, new.max_location_id - old.max_location_id]}
    if stricter := [code for code, by in changes.items() if min(by) < 0]:
        raise ReplayRefused(f"stricter rules also reject stored trips: {', '.join(stricter)}")
    return {code for code, by in changes.items() if max(by) > 0}


def rows_at(spark, paths: Sequence[str], addresses: DataFrame) -> DataFrame:
    """The rows of the raw files that stand at ``addresses(raw_file, row_index)``; one that is not there ends the job.

    Only files with an address are read. The join keeps one row an address; its sides are split by adaptive
    execution if a file is hot.
    """
    raw = read_months(spark, paths)
    # Of this side only the address is used, so a row that is missing shows as a null.
    wanted = addresses.select(*(F.col(name).alias(f"wanted_{name}") for name in ROW_ADDRESS.names))
    at = [F.col(f"wanted_{name}") == F.col(name) for name in ROW_ADDRESS.names]
    met = wanted.join(raw, at, "left")
    lost = F.concat(F.lit("no row "), F.col("wanted_row_index").cast("string"), F.lit(" in "), F.col("wanted_raw_file"))
    found = F.coalesce(F.col("raw_file"), F.raise_error(lost).cast("string"))
    return met.withColumn("raw_file", found).select(*raw.columns)


def replay_rejects(lake: Lake, ledger: Ledger, raw_root: str, zones: DataFrame, months: Sequence[Month], old: Thresholds,
                   new: Thresholds, null_policy: str = REJECT) -> Replayed:
    """Move the rejected rows of these months that pass the ``new`` thresholds to the trips; what is stored then is what a
    full load under them stores.

    The months must be done in the ledger, with the raw files as they are and under the ``old`` thresholds, and no new threshold may be
    stricter. A row's first broken rule decides whether it can change: only rows of loosened rules are looked up in
    the raw files, by file and place, and judged by all rules. Those that pass are added to the trips as new files; the others are stored with their new
    reason. Then the months' marts are refreshed.

    The ledger counts the months as not done until then, so a replay that dies is followed by a load of them.
    """
    spark = lake.spark
    codes = sorted(loosened_reasons(old, new))
    months = list(months)
    prints = input_prints(spark, [trip_path(raw_root, *one) for one in months])
    if pending := ledger.pending(months, prints, settings_print(zones, old, null_policy)):
        raise ReplayRefused(f"not loaded from these files under the old thresholds: {pending}")
    in_trips, in_rejects = [trips_period(*one) for one in months], [rejects_period(*one) for one in months]
    stored = lake.read_whole(REJECTED_TABLE, *in_rejects)
    again = stored.filter(F.col("reason_code").isin(codes))
    # One row a file.
    files = [r[0] for r in again.select("raw_file").distinct().collect()]
    if None in files:
        raise ReplayRefused("some rejects were stored without their place in the raw files")
    run = ledger.begin(months, prints, settings_print(zones, new, null_policy))
    judged_rows = passed_rows = 0
    if files:
        folders = {path.rsplit("/", 1)[1]: path for path in (trip_path(raw_root, *one) for one in months)}
        paths = [folders[file.split("/", 1)[0]] + "".join(f"/{part}" for part in file.split("/", 1)[1:]) for file in files]
        outcome = conform_files(rows_at(spark, paths, again.select(*ROW_ADDRESS.names)), zones, new, null_policy,
                                [(year, month) for _, year, month in months])
        # Stored before either table is changed, as both come from what is stored now.
        kept = stored.filter(~F.col("reason_code").isin(codes)).unionByName(outcome.addressed_rejects)
        root = new_scratch_dir(spark, "replay")
        moved, rejects = (_stored(df, f"{root}/{name}") for df, name in ((outcome.valid, "moved"), (kept, "rejects")))
        judged_rows, passed_rows = again.count(), moved.count()
        lake.add_rows(TRIPS_TABLE, moved, in_trips)
        run.note(TRIPS)
        lake.replace_periods(REJECTED_TABLE, rejects, in_rejects)
    else:
        run.note(TRIPS)
    run.note(REJECTS)
    refresh_marts(lake, months)
    run.note(MARTS)
    return Replayed(judged_rows, passed_rows)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
