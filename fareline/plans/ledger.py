"""The load ledger: which input of which month was loaded under which settings, and how far that came.

A run notes every step it finishes for its months. A month is done if the last run that began it finished all steps, and if
the input and the settings are those of that run. Anything else, a run that died between two writes, a raw file that was
replaced, another threshold, makes the month one to load again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fareline.functions.rules import Thresholds
from fareline.sources.trips import FILE_PATTERN, FOOTERS_AT_ONCE, month_of

BEGUN, TRIPS, REJECTS, MARTS = "begun", "trips", "rejects", "marts"
STEPS = (TRIPS, REJECTS, MARTS)
SCHEMA = "service_type string, period string, run long, step string, input string, settings string"
Month = tuple[str, int, int]


def period_of(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def input_prints(spark: SparkSession, paths: Sequence[str]) -> dict[Month, str]:
    """A fingerprint of each monthly file (or folder of files): names, sizes, times of change, rows, and schemas.

    Names and sizes come from one listing of all paths and row counts from the footers, whatever the number of paths; no column is read.
    """
    months = {path: month_of(path) for path in paths}
    keys = [F.regexp_extract("path", FILE_PATTERN, i).alias(name) for i, name in enumerate(("service", "year", "month"), 1)]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select(
        "path", "length", F.unix_micros("modificationTime").alias("changed"))
    # A column that no file has: what is left to read are the footers, for the number of rows.
    nothing = spark.read.schema(StructType([StructField("no column", LongType())])).parquet(*paths)
    counted = nothing.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")).groupBy(
        "path").agg(F.count(F.lit(1)).alias("rows"))
    both = files.select(*keys, F.element_at(F.split("path", "/"), -1).alias("name"), "length", "changed").withColumn(
        "rows", F.lit(None).cast("long")).unionByName(counted.select(
            *keys, F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(None).cast("long").alias("length"),
            F.lit(None).cast("long").alias("changed"), "rows"))
    per_month = both.groupBy("service", "year", "month").agg(F.sort_array(F.collect_list(F.concat_ws(
        "|", "name", F.coalesce(F.col("length").cast("string"), F.lit("")), F.coalesce(F.col("changed").cast("string"), F.lit("")),
        F.coalesce(F.col("rows").cast("string"), F.lit(""))))).alias("files"))
    # One row a month.
    listed = {(r.service, int(r.year), int(r.month)): "\n".join(r.files) for r in per_month.collect()}
    with ThreadPoolExecutor(max_workers=FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema.json(), paths))
    return {months[path]: hashlib.sha256(f"{listed.get(months[path], '')}\n{schema}".encode()).hexdigest()
            for path, schema in zip(paths, schemas, strict=True)}


def settings_print(zones: DataFrame, limits: Thresholds, null_policy: str) -> str:
    """A fingerprint of what besides the input decides the rows of a load: thresholds, null policy, zones."""
    row = F.xxhash64(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(zones.columns)))
    told = zones.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)"))).first()
    return hashlib.sha256(f"{limits!r}|{null_policy}|{told[0]}|{told[1]}".encode()).hexdigest()


@dataclass(frozen=True)
class Ledger:
    """Notes of all runs, kept in a small table that only grows."""

    spark: SparkSession
    path: str

    def notes(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException:  # nothing noted yet
            return self.spark.createDataFrame([], SCHEMA)

    def states(self) -> DataFrame:
        """``(service_type, period, runs, input, settings, steps, done)``: the last run of each month and how far it came."""
        last = F.max("run").alias("last")
        notes = self.notes()
        latest = notes.groupBy("service_type", "period").agg(last, F.count_distinct("run").alias("runs"))
        steps = notes.join(latest, ["service_type", "period"]).filter("run = last").groupBy(
            "service_type", "period", "runs").agg(
            F.max("input").alias("input"), F.max("settings").alias("settings"),
            F.sort_array(F.collect_set(F.when(F.col("step") != BEGUN, F.col("step")))).alias("steps"))
        return steps.withColumn("done", F.size("steps") == len(STEPS))

    def pending(self, wanted: Sequence[Month], prints: dict[Month, str], settings: str) -> list[Month]:
        """Those of the months whose last run is not a whole one of this input under these settings."""
        # One row a month.
        whole = {(r.service_type, r.period): (r.input, r.settings) for r in self.states().filter("done").collect()}
        return [one for one in wanted if whole.get((one[0], period_of(*one[1:]))) != (prints[one], settings)]

    def begin(self, months: Iterable[Month], prints: dict[Month, str], settings: str) -> Run:
        """Notes a new run of these months; from here until its last step they are not done."""
        number = (self.notes().agg(F.max("run")).first()[0] or 0) + 1
        run = Run(self, number, tuple(months), prints, settings)
        run.note(BEGUN)
        return run


@dataclass(frozen=True)
class Run:
    ledger: Ledger
    number: int
    months: tuple[Month, ...]
    prints: dict[Month, str]
    settings: str

    def note(self, step: str) -> None:
        rows = [(service, period_of(year, month), self.number, step, self.prints[service, year, month], self.settings)
                for service, year, month in self.months]
        self.ledger.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.ledger.path)
