"""Conform raw trips: reconcile, judge, enrich with zones, project to the stored shapes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareline.functions.rules import REJECT, WRONG_PERIOD, Rule, Thresholds, all_hold, between_months, trip_rules
from fareline.operators.quality import count_outcomes, keep_rejected, keep_valid
from fareline.operators.reconcile import (
    add_load_columns, add_metadata, conformed_columns, quarantine_columns, select_as, standardize,
)
from fareline.operators.zones import join_zones
from fareline.schemas import QUARANTINE, ROW_ADDRESS


@dataclass(frozen=True)
class Conformed:
    """The lazy outcome of conforming. Each frame is one pruned scan of its own; nothing is cached."""

    rows: DataFrame
    zones: DataFrame
    rules: Sequence[Rule]
    limits: Thresholds
    null_policy: str
    service_type: str | Column
    source_file: str | Column
    ingestion_date: date | Column

    @cached_property
    def valid(self) -> DataFrame:
        """Rows that pass every rule, with zones, in the conformed shape."""
        passed = join_zones(keep_valid(self.rows, self.rules), self.zones, self.limits)
        return conformed_columns(add_metadata(passed, self.service_type, self.source_file, self.ingestion_date))

    @cached_property
    def rejected(self) -> DataFrame:
        """Rows that break a rule, with their reason, in the quarantine shape."""
        failed = keep_rejected(self.rows, self.rules, self.null_policy)
        return quarantine_columns(add_load_columns(failed, self.service_type, self.source_file, self.ingestion_date))

    @cached_property
    def judged(self) -> DataFrame:
        """The raw rows that have a verdict, all of them but under the null policy ``"sql"``, with their service and file."""
        verdict = all_hold(self.rules)
        told = self.rows if self.null_policy == REJECT else self.rows.filter(verdict.isNotNull())
        return add_load_columns(told, self.service_type, self.source_file, self.ingestion_date)

    @cached_property
    def addressed_rejects(self) -> DataFrame:
        """The rejected rows with where they stand in the raw files, if the rows tell."""
        failed = keep_rejected(self.rows, self.rules, self.null_policy)
        whole = add_load_columns(failed, self.service_type, self.source_file, self.ingestion_date)
        known = [f for f in ROW_ADDRESS.fields if f.name in self.rows.columns]
        return select_as(whole, StructType([*QUARANTINE.fields, *known]))

    @cached_property
    def counts(self) -> DataFrame:
        """Row counts of the outcome in one pass over the raw rows."""
        return count_outcomes(self.rows, self.rules, self.null_policy)


def conform_month(raw: DataFrame, zones: DataFrame, service_type: str | Column, year: int, month: int,
                  source_file: str | Column, limits: Thresholds = Thresholds(),
                  null_policy: str = REJECT) -> Conformed:
    """Conform one raw monthly file. Its ingestion date is the first day of the data month.

    Rules judge the standard types, as they do for many files, so both give the same rows.
    """
    rules = trip_rules(year, month, limits, null_policy)
    kept = [name for name in (*service_columns(service_type, source_file), *ROW_ADDRESS.names) if name in raw.columns]
    return Conformed(standardize(raw, *kept), zones, rules, limits, null_policy, service_type, source_file,
                     date(year, month, 1))


def service_columns(*values: str | Column) -> list[str]:
    """Names of the raw columns that the given values may refer to."""
    return ["service_type", "source_file"] if any(isinstance(value, Column) for value in values) else []


def conform_files(standardized: DataFrame, zones: DataFrame, limits: Thresholds = Thresholds(),
                  null_policy: str = REJECT, months: Iterable[tuple[int, int]] = ()) -> Conformed:
    """Conform the union of many files in one plan; each row is held to the month its file names.

    The ``months`` of the files, if given, bound the pickups of valid rows by a plain range, which
    Parquet can check; it follows from the rule of the single file and changes no row.
    """
    year, month = F.col("file_year"), F.col("file_month")
    rules = trip_rules(year, month, limits, null_policy)
    months = sorted(months)
    if months:
        within = between_months(months[0], months[-1])
        rules = [Rule(r.reason_code, within & r.holds) if r.reason_code == WRONG_PERIOD else r for r in rules]
    return Conformed(standardized, zones, rules, limits, null_policy, F.col("service_type"), F.col("source_file"),
                     F.make_date(year, month, F.lit(1)))
