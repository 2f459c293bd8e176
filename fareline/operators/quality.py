"""Split trips into valid and rejected rows, and count the outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.rules import REJECT, Rule, all_hold, any_broken, first_broken
from fareline.functions.scalars import percent


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows on which every rule holds. Single conjuncts on plain columns reach the Parquet scan."""
    return df.filter(all_hold(rules))


def keep_rejected(df: DataFrame, rules: Sequence[Rule], null_policy: str = REJECT) -> DataFrame:
    """Rows that break a rule, with ``reason_code``. Reasons are worked out for these rows only."""
    return df.filter(any_broken(rules, null_policy)).withColumn("reason_code", first_broken(rules, null_policy))


def count_outcomes(df: DataFrame, rules: Sequence[Rule], null_policy: str = REJECT) -> DataFrame:
    """Raw, valid and rejected row counts and the reject rate, in one pass over the rows.

    ``lost_rows`` is zero under the ``"reject"`` policy.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(all_hold(rules)).alias("valid_rows"),
        F.count_if(any_broken(rules, null_policy)).alias("rejected_rows"),
    )
    return counted.select(
        "*",
        (F.col("raw_rows") - F.col("valid_rows") - F.col("rejected_rows")).alias("lost_rows"),
        percent(F.col("rejected_rows"), F.col("raw_rows")).alias("reject_rate_pct"),
    )


def count_reasons(rejected: DataFrame) -> DataFrame:
    """Number of rejected rows per reason code."""
    return rejected.groupBy("reason_code").agg(F.count(F.lit(1)).alias("rejected_count"))
