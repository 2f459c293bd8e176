"""How the columns of raw files change over the months, told by their footers alone."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.schemas import RAW_NAMES
from fareline.sources.trips import FOOTERS_AT_ONCE, month_of

FIELDS = "service_type string, month date, column_name string, raw_name string, type string, position int"


def file_columns(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """A row for each column of each file: service, month, conformed name, name as written, type and position."""
    paths = list(paths)
    with ThreadPoolExecutor(max_workers=FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    from datetime import date

    rows = []
    for path, schema in zip(paths, schemas, strict=True):
        service, year, month = month_of(path)
        rows += [(service, date(year, month, 1), RAW_NAMES.get(f.name.lower(), f.name.lower()), f.name, f.dataType.simpleString(), i)
                 for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, FIELDS)


def intervals(columns: DataFrame, known: Sequence[str] = ("raw_name", "type")) -> DataFrame:
    """Runs of months in which a column keeps the same values of ``known``: first and last month and how many.

    Months are those the service has files of: a column that a file lacks ends its run, a month without a file does not. Two
    columns of one file that mean the same (``airport_fee`` and ``Airport_fee``) have runs side by side.
    """
    months = columns.select("service_type", "month").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("service_type").orderBy("month")))
    keys = ["service_type", "column_name", *known]
    told = columns.select(*keys, "month").distinct().join(months, ["service_type", "month"])
    within = Window.partitionBy(*keys).orderBy("nth")
    runs = told.withColumn("run", F.col("nth") - F.row_number().over(within))
    return runs.groupBy(*keys, "run").agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count(F.lit(1)).alias("months")).drop("run")


def schema_timeline(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """``(service_type, column_name, raw_name, type, first_month, last_month, months)`` of monthly files, no data read.

    ``column_name`` is the conformed name, so a rename, another case or another width of the same column is a new interval of it. Without
    paths there are no rows.
    """
    return intervals(file_columns(spark, paths))
