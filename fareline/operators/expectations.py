"""Data tests: each reports how many rows fail; a test passes when none does."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.schemas import SERVICE_TYPES


class ExpectationFailed(AssertionError):
    """A data test or volume gate did not hold."""


@dataclass(frozen=True)
class Expectation:
    column: str
    accepted: tuple[str, ...] | None = None

    @property
    def test(self) -> str:
        return "not_null" if self.accepted is None else "accepted_values"

    @property
    def fails(self) -> Column:
        """True on failing rows. A null passes accepted_values; not_null is there to catch it."""
        column = F.col(self.column)
        return column.isNull() if self.accepted is None else ~column.isin(*self.accepted)


def not_null(*columns: str) -> list[Expectation]:
    return [Expectation(column) for column in columns]


# --- fixed values: the declared tests of each model ---
STAGED = "stg_trips"
EXPECTATIONS: dict[str, list[Expectation]] = {
    STAGED: [*not_null("vendor_id", "service_type", "pickup_date", "fare_amount", "pu_location_id", "do_location_id"),
             Expectation("service_type", SERVICE_TYPES)],
    "fact_trips": not_null("pickup_date", "service_type", "total_amount"),
    "agg_hourly_demand_by_zone": not_null("trip_count"),
    "agg_monthly_zone_revenue": not_null("total_revenue"),
    "agg_monthly_data_quality": not_null("rejected_count"),
}


def check(model: str, df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """All tests of one model in one pass: rows (model, column_name, test, failing_rows, passed)."""
    counted = df.agg(*(F.count_if(e.fails).alias(f"t{i}") for i, e in enumerate(expectations)))
    return counted.select(F.inline(F.array(*(
        F.struct(F.lit(model).alias("model"), F.lit(e.column).alias("column_name"), F.lit(e.test).alias("test"),
                 F.col(f"t{i}").alias("failing_rows"), (F.col(f"t{i}") == 0).alias("passed"))
        for i, e in enumerate(expectations)))))


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """The declared tests of every given model."""
    reports = [check(name, df, EXPECTATIONS[name]) for name, df in models.items() if name in EXPECTATIONS]
    return reduce(DataFrame.unionByName, reports)


def require_passed(report: DataFrame) -> None:
    """Raise when the report holds a failed test. The report has one row per test, so collecting it is bounded."""
    failed = [row for row in report.collect() if not row["passed"]]
    if failed:
        raise ExpectationFailed("; ".join(
            f"{r['model']}.{r['column_name']} {r['test']}: {r['failing_rows']} rows" for r in failed))


def count_month(trips: DataFrame, year: int, month: int) -> DataFrame:
    """One row: number of trips picked up in the month. The range is on the partition column and prunes."""
    begin = F.to_date(F.lit(f"{year:04d}-{month:02d}-01"))
    day = F.col("pickup_date")
    return trips.filter((day >= begin) & (day < F.add_months(begin, 1))).agg(F.count(F.lit(1)).alias("row_count"))


def volume_gate(trips: DataFrame, year: int, month: int, min_rows: int) -> DataFrame:
    """One row (period, row_count, min_rows, passed)."""
    return count_month(trips, year, month).select(
        F.lit(f"{year:04d}-{month:02d}").alias("period"), "row_count",
        F.lit(min_rows).cast("long").alias("min_rows"), (F.col("row_count") >= min_rows).alias("passed"))


def require_volume(trips: DataFrame, year: int, month: int, min_rows: int) -> int:
    """Row count of the month; raises when it is below ``min_rows``."""
    gate = volume_gate(trips, year, month, min_rows).first()
    if not gate["passed"]:
        raise ExpectationFailed(f"{gate['period']}: {gate['row_count']} rows, expected at least {min_rows}")
    return gate["row_count"]
