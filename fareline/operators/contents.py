"""Whether two tables hold the same rows, by a checksum that does not depend on their order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.schemas import QUARANTINE, STANDARD_RAW

# The columns a raw row keeps whether it turns out valid or not, and those every row is given.
SHARED_COLUMNS = tuple(name for name in QUARANTINE.names if name in STANDARD_RAW.names or name in (
    "service_type", "ingestion_date", "source_file"))
_SEEDS = (1, 2)


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of a row in which a null is not an empty value and columns do not run together."""
    return F.xxhash64(F.lit(seed), *(x for name in columns for x in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())))


def multiset_checksum(df: DataFrame, columns: Sequence[str] = SHARED_COLUMNS) -> DataFrame:
    """One row ``(rows, sum_1, sum_2)``: the number of rows and two sums of independent 64-bit hashes of them.

    Sums add up: those of two disjoint parts are together those of the whole. Repeated rows count as often as they occur. One pass,
    one row a task; tables of the same types must be given, as hashes tell 1 and 1.0 apart.
    """
    return df.agg(F.count(F.lit(1)).alias("rows"), *(
        F.coalesce(F.sum(_row_hash(columns, seed).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{seed}")
        for seed in _SEEDS))


def same_contents(whole: DataFrame, *parts: DataFrame, columns: Sequence[str] = SHARED_COLUMNS) -> DataFrame:
    """One row ``(rows, expected, passed)``: the rows of the parts, those of the whole, and whether they are the same rows.

    A value that changed, moved to another row or got lost changes both sums; that both still agree by chance is
    out of reach (2 in 10^38 or so).
    """
    found = multiset_checksum(whole, columns).withColumn("whole", F.lit(True))
    for part in parts:
        found = found.unionByName(multiset_checksum(part, columns).withColumn("whole", F.lit(False)))

    def total(name: str, of_whole: bool) -> Column:
        return F.coalesce(F.sum(F.when(F.col("whole") == of_whole, F.col(name))), F.lit(0))

    equal = [total(n, True) == total(n, False) for n in ("rows", *(f"sum_{seed}" for seed in _SEEDS))]
    return found.agg(total("rows", False).cast("long").alias("rows"), total("rows", True).cast("long").alias("expected"),
                     reduce(and_, equal).alias("passed"))
