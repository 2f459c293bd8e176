"""Raw trip files: where they are and how they are read."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.operators.reconcile import standardize
from fareline.schemas import ROW_ADDRESS, SERVICE_TYPES

# --- fixed values: file naming and the first year that has data ---
FIRST_YEAR = 2009
FILE_PATTERN = r"([a-z]+)_tripdata_(\d{4})-(\d{2})\.parquet"
# ------------------------------------------------------------------
FOOTERS_AT_ONCE = 16
# Up to this many files their names are broadcast to the rows.
BROADCAST_MAX_FILES = 100_000


def trip_path(root: str, service_type: str, year: int, month: int) -> str:
    """Path of one service's month below ``root``."""
    if service_type not in SERVICE_TYPES:
        raise ValueError(f"unknown service type {service_type!r}; one of {SERVICE_TYPES}")
    if not FIRST_YEAR <= year <= 9999:
        raise ValueError(f"year {year} is before {FIRST_YEAR} or no year of four digits")
    if month < 1 or month > 12:
        raise ValueError(f"month {month} outside 1-12")
    file_name = f"{service_type}_tripdata_{year}-{month:02d}.parquet"
    return "/".join((root.rstrip("/"), "trip-data", service_type, str(year), f"{month:02d}", file_name))


def file_name(path: str) -> str:
    """Last segment of a path, kept with each row as ``source_file``."""
    return path.rstrip("/").rsplit("/", 1)[-1]


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One raw file with whatever schema its footer declares."""
    return spark.read.parquet(path)


def read_addressed(spark: SparkSession, path: str) -> DataFrame:
    """One raw file with the address of each row."""
    return read_raw(spark, path).withColumns(row_address())


def month_of(path: str) -> tuple[str, int, int]:
    """Service, year and month that a file's name tells."""
    match = re.fullmatch(FILE_PATTERN, month_file(path))
    return match[1], int(match[2]), int(match[3])


def month_file(path: str) -> str:
    """The last segment of a path that is named like a monthly file: the file, or the folder it is a part of."""
    for segment in reversed(path.split("/")):
        if re.fullmatch(FILE_PATTERN, segment):
            return segment
    raise ValueError(f"{path} is not named like a monthly file")


def row_address() -> dict[str, Column]:
    """Where a row of a raw file stands: the file from the month's name on, whatever store it is in, and its place in it."""
    return {"raw_file": F.regexp_extract(F.col("_metadata.file_path"), f"({FILE_PATTERN}.*)$", 1),
            "row_index": F.col("_metadata.row_index")}


def read_months(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Raw files of several services and months as one standardised frame.

    Adds ``service_type``, ``file_year``, ``file_month`` and ``source_file``, all taken from the
    file name, and the row's address (``raw_file, row_index``), which costs nothing where it is not used. Files are grouped by the schema in their footer and each group is one scan, so the
    plan grows with the number of distinct schemas and not with the number of files. Footers are read a few at a
    time. What the names tell is a table of one row per file, broadcast to rows by the file they come from.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no paths given")
    with ThreadPoolExecutor(max_workers=FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    by_schema = defaultdict(list)
    for path, schema in zip(paths, schemas, strict=True):
        by_schema[schema].append(path)

    def scan(schema, group: list[str]) -> DataFrame:
        raw = spark.read.schema(schema).parquet(*group)
        told = []
        for file in raw.inputFiles():
            # A local file is listed as file:///x and named file:/x by its rows.
            told += [(name, *month_of(unquote(file)), month_file(unquote(file))) for name in {file, file.replace(":///", ":/", 1)}]
        files = spark.createDataFrame(told, "file string, service_type string, file_year int, file_month int, "
                                            "source_file string")
        listed = F.broadcast(files) if len(told) <= BROADCAST_MAX_FILES else files
        named = raw.withColumns({"file": F.col("_metadata.file_path"), **row_address()}).join(listed, "file", "left")
        known = F.coalesce("service_type", F.raise_error(F.concat(F.lit("file not listed: "), F.col("file"))))
        return standardize(named.withColumn("service_type", known), "service_type", "file_year", "file_month",
                           "source_file", *ROW_ADDRESS.names)

    return reduce(DataFrame.unionByName, (scan(schema, group) for schema, group in by_schema.items()))
