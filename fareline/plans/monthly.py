"""The monthly run and the backfill: conform, store, gate, refresh the marts, test."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.rules import REJECT, Thresholds
from fareline.functions.scalars import month_start
from fareline.operators.expectations import (
    STAGED, ExpectationFailed, check_models, require_passed, require_volume,
)
from fareline.operators.quality import count_reasons
from fareline.operators.contents import same_contents
from fareline.operators.sketches import trip_metrics, value_sketches
from fareline.plans.conform import Conformed, conform_files, conform_month
from fareline.plans.ledger import MARTS, REJECTS, TRIPS, Ledger, Run, input_prints, settings_print
from fareline.plans.marts import Models, build_marts
from fareline.plans.states import hourly_state, hourly_view, revenue_state, revenue_view
from fareline.plans.views import create_views
from fareline.schemas import (
    FACT_TABLE, HEALTH_TABLE, HOURLY_STATE_TABLE, HOURLY_TABLE, MART_TABLES, QUALITY_TABLE, REJECTED_TABLE, REVENUE_STATE_TABLE,
    REVENUE_TABLE, SKETCH_TABLE, TRIPS_TABLE, TableLayout,
)
from fareline.sources.lake import Lake, run_together, write_checked
from fareline.sources.trips import file_name, month_of, read_addressed, read_months, trip_path

MIN_ROWS_PER_MONTH = 100_000
# Models that are views, not tables.
VIEWS = ("stg_trips", "int_trips_enriched", "int_data_quality")


@dataclass(frozen=True)
class LoadCounts:
    """What one load did, counted on the input file and on the stored tables."""

    service_type: str
    period: str
    raw_rows: int
    valid_rows: int
    rejected_by_reason: dict[str, int]

    @property
    def rejected_rows(self) -> int:
        return sum(self.rejected_by_reason.values())

    @property
    def lost_rows(self) -> int:
        return self.raw_rows - self.valid_rows - self.rejected_rows

    @property
    def reject_rate_pct(self) -> float | None:
        return round(self.rejected_rows * 100 / self.raw_rows, 2) if self.raw_rows else None


def trips_period(service_type: str, year: int, month: int) -> dict[str, str]:
    return {"service_type": service_type, "period": f"{year:04d}-{month:02d}"}


def rejects_period(service_type: str, year: int, month: int) -> dict[str, str]:
    return {"service_type": service_type, "ingestion_date": str(date(year, month, 1))}


def load_month(lake: Lake, raw: DataFrame, zones: DataFrame, service_type: str, year: int, month: int,
               source_file: str, limits: Thresholds = Thresholds(), null_policy: str = REJECT) -> LoadCounts:
    """Conform one raw file and replace its month in the trips and rejects tables.

    The counts come from the Parquet footers of the input and of what was stored. Unlike metrics
    gathered while the rows pass by, they stay right when lost executors make tasks run again.
    """
    outcome = conform_month(raw, zones, service_type, year, month, source_file, limits, null_policy)
    in_trips = trips_period(service_type, year, month)
    in_rejects = rejects_period(service_type, year, month)
    run_together(
        lake.spark,
        lambda: lake.replace_period(TRIPS_TABLE, outcome.valid, in_trips),
        lambda: lake.replace_period(REJECTED_TABLE, outcome.addressed_rejects, in_rejects))
    reasons = count_reasons(lake.read(REJECTED_TABLE, **in_rejects)).collect()
    return LoadCounts(
        service_type, in_trips["period"], raw.count(), lake.read(TRIPS_TABLE, **in_trips).count(),
        {row["reason_code"]: row["rejected_count"] for row in reasons})


def load_months(lake: Lake, paths: Sequence[str], zones: DataFrame, limits: Thresholds = Thresholds(),
                null_policy: str = REJECT, run: Run | None = None) -> list[LoadCounts]:
    """Conform many monthly files in one plan and replace all their months in one write for each table.

    Gives the rows that loading the files one by one gives. The number of jobs does not grow with the files.
    A ``run`` of the ledger gets a note when either table is stored.
    """
    spark = lake.spark
    named = [month_of(path) for path in paths]
    raw = read_months(spark, paths)
    outcome = conform_files(raw, zones, limits, null_policy, [(year, month) for _, year, month in named])
    in_trips = [trips_period(*one) for one in named]
    in_rejects = [rejects_period(*one) for one in named]
    run_together(
        spark,
        lambda: _noted(run, TRIPS, lake.replace_periods, TRIPS_TABLE, outcome.valid, in_trips),
        lambda: _noted(run, REJECTS, lake.replace_periods, REJECTED_TABLE, outcome.addressed_rejects, in_rejects))
    # One row per file, or per file and reason.
    keys = ["service_type", "month"]
    raw_rows = raw.groupBy("service_type", F.make_date("file_year", "file_month", F.lit(1)).alias("month")).count()
    stored = lake.read(TRIPS_TABLE, *in_trips).groupBy("service_type", F.col("ingestion_date").alias("month")).count()
    refused = lake.read(REJECTED_TABLE, *in_rejects).groupBy(
        "service_type", F.col("ingestion_date").alias("month"), "reason_code").count()
    n_raw, n_valid = ({tuple(r[k] for k in keys): r["count"] for r in df.collect()} for df in (raw_rows, stored))
    reasons: dict[tuple, dict[str, int]] = {}
    for r in refused.collect():
        reasons.setdefault((r["service_type"], r["month"]), {})[r["reason_code"]] = r["count"]
    return [LoadCounts(service, f"{year:04d}-{month:02d}", n_raw.get((service, date(year, month, 1)), 0),
                       n_valid.get((service, date(year, month, 1)), 0),
                       reasons.get((service, date(year, month, 1)), {})) for service, year, month in named]


def _noted(run: Run | None, step: str, write: Callable, *what) -> None:
    write(*what)
    if run is not None:
        run.note(step)


def _month_keys(months: Sequence[tuple[str, int, int]]) -> list[dict[str, str]]:
    return [{"service_type": service, "period": f"{year:04d}-{month:02d}",
             "ingestion_date": str(date(year, month, 1)), "ingestion_month": str(date(year, month, 1))}
            for service, year, month in months]


def _periods(layout: TableLayout, months: Sequence[tuple[str, int, int]]) -> list[dict[str, str]]:
    return [{key: one[key] for key in layout.period_keys} for one in _month_keys(months)]


def refresh_marts(lake: Lake, months: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Replace these months (service, year, month) in every mart and report the data tests of them.

    Every mart's grain includes the service and the month, so a month's mart rows depend on that
    month's trips and rejects alone: refreshing costs these months, however long the history is. The hourly and
    the revenue mart are stored as sums and counts first and rounded from those.
    """
    def periods(layout: TableLayout) -> list[dict[str, str]]:
        return _periods(layout, months)

    models = build_marts(lake.read(TRIPS_TABLE, *periods(TRIPS_TABLE)),
                         lake.read(REJECTED_TABLE, *periods(REJECTED_TABLE)))
    enriched = models["int_trips_enriched"]

    def from_state(kept: TableLayout, state: DataFrame, mart: TableLayout, view: Callable[[DataFrame], DataFrame]) -> None:
        lake.replace_periods(kept, state, periods(kept))
        lake.replace_periods(mart, view(lake.read(kept, *periods(kept))), periods(mart))

    run_together(
        lake.spark,
        *(partial(lake.replace_periods, layout, models[layout.name], periods(layout)) for layout in (
            FACT_TABLE, QUALITY_TABLE, HEALTH_TABLE)),
        partial(from_state, HOURLY_STATE_TABLE, hourly_state(enriched), HOURLY_TABLE, hourly_view),
        partial(from_state, REVENUE_STATE_TABLE, revenue_state(enriched), REVENUE_TABLE, revenue_view))
    stored = {layout.name: lake.read(layout, *periods(layout)) for layout in MART_TABLES}
    return check_models({STAGED: models[STAGED], **stored})


def store_sketches(lake: Lake, months: Sequence[tuple[str, int, int]]) -> None:
    """Replace these months' quantile sketches of the stored trips: one pass over the months."""
    trips = lake.read(TRIPS_TABLE, *_periods(TRIPS_TABLE, months)).withColumn(
        "pickup_month_date", month_start(F.col("pickup_date")))
    sketches = value_sketches(trips, trip_metrics(), ["service_type", "pickup_month_date"])
    lake.replace_periods(SKETCH_TABLE, sketches, _periods(SKETCH_TABLE, months))


def run_month(lake: Lake, raw_root: str, zones: DataFrame, service_type: str, year: int, month: int,
              limits: Thresholds = Thresholds(), null_policy: str = REJECT,
              min_rows: int = MIN_ROWS_PER_MONTH) -> LoadCounts:
    """Load, volume gate, marts, data tests, in this order; the first failing gate raises."""
    path = trip_path(raw_root, service_type, year, month)
    counts = load_month(lake, read_addressed(lake.spark, path), zones, service_type, year, month, file_name(path),
                        limits, null_policy)
    require_volume(lake.read(TRIPS_TABLE, **trips_period(service_type, year, month)), year, month, min_rows)
    require_passed(refresh_marts(lake, [(service_type, year, month)]))
    return counts


def backfill(lake: Lake, raw_root: str, zones: DataFrame, services: str | Sequence[str],
             months: Iterable[tuple[int, int]], limits: Thresholds = Thresholds(), null_policy: str = REJECT,
             min_rows: int = MIN_ROWS_PER_MONTH, ledger: Ledger | None = None) -> list[LoadCounts]:
    """The monthly run of many months and services at once: one load, one gate, one refresh of each mart.

    The stored rows are those of one monthly run after another. The gate names every month below
    ``min_rows`` and stops before the marts.

    With a ``ledger`` only those months are loaded whose input or settings changed since they were last loaded, or whose last run
    did not come to its end; the counts are of these months.
    """
    services = [services] if isinstance(services, str) else services
    wanted = [(service, *month) for month in sorted(months) for service in services]
    run = None
    if ledger is not None:
        prints = input_prints(lake.spark, [trip_path(raw_root, *one) for one in wanted])
        settings = settings_print(zones, limits, null_policy)
        wanted = ledger.pending(wanted, prints, settings)
        if not wanted:
            return []
        run = ledger.begin(wanted, prints, settings)
    loaded = load_months(lake, [trip_path(raw_root, *one) for one in wanted], zones, limits, null_policy, run)
    short = [f"{c.service_type} {c.period}: {c.valid_rows} rows" for c in loaded if c.valid_rows < min_rows]
    if short:
        raise ExpectationFailed(f"{'; '.join(short)}; expected at least {min_rows}")
    require_passed(refresh_marts(lake, wanted))
    if run is not None:
        run.note(MARTS)
    return loaded


def rebuild_marts(lake: Lake) -> dict[str, DataFrame]:
    """All models and marts over the whole stored history, lazily."""
    return build_marts(lake.read(TRIPS_TABLE), lake.read(REJECTED_TABLE))


def write_outcome(outcome: Conformed, root: str) -> DataFrame:
    """Write valid and rejected rows to plain Parquet below ``root``, read them back and compare with the raw rows.

    Rows (outcome, rows, expected, passed) for both, the expected counts from one pass over the raw rows; and one for their
    ``contents``, whether what was stored are the raw rows and no others in the columns that both outcomes keep. Under the null policy
    ``"sql"`` rows without a verdict are in neither, and the contents are compared with the others.
    """
    valid = write_checked(outcome.valid, f"{root}/valid")
    rejected = write_checked(outcome.rejected, f"{root}/rejected")
    count = F.count(F.lit(1)).alias("rows")
    stored = valid.agg(count).withColumn("outcome", F.lit("valid")).unionByName(
        rejected.agg(count).withColumn("outcome", F.lit("rejected")))
    expected = outcome.counts.select(F.inline(F.array(
        F.struct(F.lit("valid").alias("outcome"), F.col("valid_rows").alias("expected")),
        F.struct(F.lit("rejected").alias("outcome"), F.col("rejected_rows").alias("expected")))))
    counted = stored.join(F.broadcast(expected), "outcome").select(  # two rows
        "outcome", "rows", "expected", (F.col("rows") == F.col("expected")).alias("passed"))
    return counted.unionByName(same_contents(outcome.judged, valid, rejected).withColumn("outcome", F.lit("contents")))


def register_models(lake: Lake) -> None:
    """Make the stored tables and marts known to SQL, and the models between them as views.

    Views of the lake's database last and show what is stored when they are read (see ``views``). The session also gets them by their bare
    names, as they were when they were made.
    """
    stored = [layout for layout in (TRIPS_TABLE, REJECTED_TABLE, *MART_TABLES) if lake.exists(layout)]
    for layout in stored:
        lake.register(layout)
    create_views(lake)
    models = Models(lambda: lake.read(TRIPS_TABLE), lambda: lake.read(REJECTED_TABLE))
    for name in VIEWS:
        models[name].createOrReplaceTempView(name)
