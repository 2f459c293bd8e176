"""The zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.schemas import ZONES

MISSING_TEXT = "N/A"


def read_zones(spark: SparkSession, path: str, missing: str | None = MISSING_TEXT) -> DataFrame:
    """Zone CSV with a header, whose columns are taken by name in any order and case.

    ``missing`` is the text that stands for an absent borough or zone; ``None`` keeps it as text. A missing
    column fails at once; a row with too many or too few fields, and an id that is absent or no
    integer, fail when read.
    """
    options = {} if missing is None else {"nullValue": missing}
    # Only the header is looked at for the names; every column is read as text.
    text = spark.read.csv(path, header=True, mode="FAILFAST", **options)
    found = {name.strip().lower(): name for name in text.columns}
    absent = [f.name for f in ZONES.fields if f.name.lower() not in found]
    if absent:
        raise ValueError(f"zone file {path} lacks the columns {absent}; it has {text.columns}")
    raw_id = F.col(f"`{found['locationid']}`")
    number = raw_id.try_cast("int")
    unreadable = F.concat(F.lit("unreadable location id: "), F.coalesce(raw_id, F.lit("none")))
    checked = F.coalesce(number, F.raise_error(unreadable).cast("int"))
    return text.select(checked.alias("LocationID"), *(
        F.col(f"`{found[f.name.lower()]}`").alias(f.name) for f in ZONES.fields[1:]))
