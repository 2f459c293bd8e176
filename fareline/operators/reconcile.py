"""Bring drifting raw schemas to one shape, and project to the stored shapes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType, TimestampType

from fareline.schemas import CONFORMED, LATER_COLUMNS, LONG_COLUMNS, QUARANTINE, RAW_NAMES, STANDARD_RAW


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and apply the raw-to-conformed renames.

    Two raw columns that end up with the same name (``airport_fee`` and ``Airport_fee``, or the
    yellow and green pickup columns) are merged: the leftmost non-null value wins.
    """
    names = [RAW_NAMES.get(name.lower(), name.lower()) for name in df.columns]
    if len(set(names)) == len(names):
        return df.toDF(*names)
    slots = [f"{name}__{position}" for position, name in enumerate(names)]
    sources: dict[str, list[str]] = {}
    for name, slot in zip(names, slots):
        sources.setdefault(name, []).append(slot)
    return df.toDF(*slots).select(
        *(F.coalesce(*(F.col(slot) for slot in merged)).alias(name) for name, merged in sources.items()))


def cast_types(df: DataFrame) -> DataFrame:
    """Widen the id and count columns that are present to 64-bit integers; unreadable values become null."""
    present = [name for name in LONG_COLUMNS if name in df.columns]
    return df.withColumns({name: F.col(name).try_cast(LongType()) for name in present})


def fill_optional(df: DataFrame) -> DataFrame:
    """Add the surcharge columns older files lack, as null doubles."""
    missing = [name for name in LATER_COLUMNS if name not in df.columns]
    return df.withColumns({name: F.lit(None).cast(DoubleType()) for name in missing})


def reconcile(df: DataFrame) -> DataFrame:
    """Names, integer widths and later columns in one go."""
    return fill_optional(cast_types(normalize_columns(df)))


def zone_free(df: DataFrame, zone: str) -> DataFrame:
    """Instants as wall clock times of a named zone, whatever the session's; other columns as they are."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def wall_clock(name: str) -> Column:
        micros = F.unix_micros(F.col(name))
        utc = epoch + F.make_dt_interval(secs=(micros.cast("decimal(24,6)") / F.lit(1_000_000)).cast("decimal(18,6)"))
        return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)

    return df.withColumns({name: wall_clock(name) for name in instants}) if instants else df


def select_as(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` in its order, cast to its types; other columns are dropped."""
    types = dict(df.dtypes)
    return df.select(*(
        f.name if types.get(f.name) == f.dataType.simpleString() else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields))


def standardize(df: DataFrame, *keep: str, zone: str = "UTC") -> DataFrame:
    """Reconciled frame with exactly the standard raw columns and types, plus the columns named in ``keep``.

    Frames of different vintages become union-compatible this way. Files whose times are instants are read as wall
    clock times of ``zone``; times without a zone, the usual case, stay as they are.
    """
    extra = [df.schema[name] for name in keep]
    return select_as(zone_free(reconcile(df), zone), StructType([*STANDARD_RAW.fields, *extra]))


def add_metadata(df: DataFrame, service_type: str | Column, source_file: str | Column,
                 ingestion_date: date | Column) -> DataFrame:
    """Add where and for which month the rows were loaded, and the pickup day."""
    return add_load_columns(df, service_type, source_file, ingestion_date).withColumn(
        "pickup_date", F.col("pickup_datetime").cast("date"))


def add_load_columns(df: DataFrame, service_type: str | Column, source_file: str | Column,
                     ingestion_date: date | Column) -> DataFrame:
    """The metadata that rejected rows carry too: their pickup may be missing, so no pickup day."""
    return df.withColumns({
        "service_type": F.lit(service_type),
        "ingestion_date": F.lit(ingestion_date).cast("date"),
        "source_file": F.lit(source_file),
    })


def conformed_columns(df: DataFrame) -> DataFrame:
    return select_as(df, CONFORMED)


def quarantine_columns(df: DataFrame) -> DataFrame:
    return select_as(df, QUARANTINE)
