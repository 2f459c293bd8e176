"""Stored tables: partitioned Parquet below one folder, replaced whole periods at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fareline.functions.scalars import interleaved
from fareline.operators.reconcile import select_as
from fareline.schemas import TableLayout

LISTINGS_AT_ONCE = 16


def _or_fail(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"null in required column {name}")))


def _checked_key(keys: Sequence[str], periods: Sequence[Mapping[str, str]]) -> Column:
    """The first period key, or an error: rows of other periods must not be stored with these.

    As the value follows from a check of the row it is no constant, which would drop out of the sort order and make
    the writer sort once more, without the sort keys.
    """
    told = F.concat_ws(", ", *(F.col(key).cast("string") for key in keys))
    named = [", ".join(period[key] for key in keys) for period in periods]
    refused = F.concat(F.lit(f"a row's {' and '.join(keys)} is not among those loaded: "), told)
    return F.when(told.isin(named), F.col(keys[0])).otherwise(F.raise_error(refused).cast("string"))


def ordered(keys: Sequence[str]) -> list[Column]:
    """Sort columns of keys, descending where a key begins with ``-``."""
    return [F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in keys]


@dataclass(frozen=True)
class Lake:
    """Tables stored below ``root``. They are read from their files, so any session sees what any other stored;
    ``database`` is where ``register`` puts them for SQL."""

    spark: SparkSession
    root: str
    database: str

    def qualified(self, layout: TableLayout) -> str:
        return f"`{self.database}`.`{layout.name}`"

    def location(self, layout: TableLayout) -> str:
        return f"{self.root.rstrip('/')}/{layout.name}"

    def exists(self, layout: TableLayout) -> bool:
        """Whether anything was stored."""
        try:
            return bool(self.spark.read.parquet(self.location(layout)).columns)
        except AnalysisException:
            return False

    def _stored_schema(self, layout: TableLayout) -> StructType:
        more = [StructField(key, StringType()) for key in layout.partition_keys if key not in layout.schema.names]
        return StructType([*layout.stored.fields, *more])

    def read(self, layout: TableLayout, *periods: Mapping[str, str], **period: str) -> DataFrame:
        """The table's columns, optionally of some periods only (partition filters); in order, if it has one."""
        rows = self.read_whole(layout, *periods, **period).select(*layout.schema.names)
        return rows.orderBy(*ordered(layout.read_order)) if layout.read_order else rows

    def read_whole(self, layout: TableLayout, *periods: Mapping[str, str], **period: str) -> DataFrame:
        """The same with the extra columns, in no order."""
        df = self.spark.read.schema(self._stored_schema(layout)).parquet(self.location(layout))
        wanted = [*periods, *([period] if period else [])]
        if wanted:
            df = df.filter(reduce(Column.__or__, (
                reduce(Column.__and__, (F.col(key) == F.lit(value) for key, value in one.items())) for one in wanted)))
        return df.select(*layout.stored.names)

    def _files(self, layout: TableLayout, periods: Sequence[Mapping[str, str]]) -> set[str]:
        """Files stored for the periods: a listing of their folders, no job."""
        def listed(period: Mapping[str, str]) -> list[str]:
            folder = "/".join((self.location(layout), *(f"{key}={period[key]}" for key in layout.period_keys)))
            try:
                return list(self.spark.read.schema(layout.stored).parquet(folder).inputFiles())
            except AnalysisException:  # nothing stored for this period
                return []

        with ThreadPoolExecutor(max_workers=LISTINGS_AT_ONCE) as pool:
            return {file for files in pool.map(listed, periods) for file in files}

    def replace_period(self, layout: TableLayout, df: DataFrame, period: Mapping[str, str]) -> None:
        self.replace_periods(layout, df, [period])

    def replace_periods(self, layout: TableLayout, df: DataFrame, periods: Sequence[Mapping[str, str]]) -> None:
        """Replace exactly the rows of these periods with ``df`` in one write; all others stay.

        A period without rows in ``df`` becomes empty. Rows are rebalanced on the partitions: AQE merges
        small ones and splits a hot day over several tasks, so files come out near the advisory
        size. The write puts its files aside and swaps them in when all tasks are done, so a write
        that fails leaves the old rows; days that the new rows lack are emptied after it. The number of jobs does
        not grow with the periods, but for such days.
        """
        for period in periods:
            if set(period) != set(layout.period_keys):
                raise ValueError(f"{layout.name} is replaced by {layout.period_keys}, not {tuple(period)}")
        if not periods:
            return
        keys = layout.partition_keys
        before = self._files(layout, periods)
        self._laid_out(layout, df, periods).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(self.location(layout))
        if before:
            stale = {file.rsplit("/", 1)[0] for file in before & self._files(layout, periods)}
            nothing = self.spark.createDataFrame([], StructType([f for f in layout.schema.fields if f.name not in keys]))
            for folder in sorted(stale):
                nothing.write.mode("overwrite").parquet(folder)

    def add_rows(self, layout: TableLayout, df: DataFrame, periods: Sequence[Mapping[str, str]]) -> None:
        """Store ``df`` besides the rows of these periods: new files, no old one is touched. Twice adds them twice."""
        self._laid_out(layout, df, periods).write.mode("append").partitionBy(*layout.partition_keys).parquet(
            self.location(layout))

    def _laid_out(self, layout: TableLayout, df: DataFrame, periods: Sequence[Mapping[str, str]]) -> DataFrame:
        """Rows as they are stored: checked, with the keys of their folders, gathered and sorted by partition."""
        unknown = {f.name: F.lit(None).cast(f.dataType) for f in layout.extra.fields if f.name not in df.columns}
        rows = select_as(df.withColumns(unknown) if unknown else df, layout.stored)
        derived = [key for key in layout.period_keys if key not in layout.schema.names]
        rows = rows.withColumns({key: F.date_format(layout.period_of, "yyyy-MM") for key in derived}) if derived else rows
        rows = rows.withColumn(layout.period_keys[0], _checked_key(layout.period_keys, periods))
        required = {f.name for f in layout.schema.fields if not f.nullable}
        rows = rows.select(*(_or_fail(name).alias(name) if name in required else F.col(name) for name in rows.columns))
        order = [*layout.partition_keys, *ordered(layout.sort_keys)]
        if layout.cluster_keys:
            order.append(interleaved(*(F.col(key) for key in layout.cluster_keys)))
        return rows.hint("rebalance", *layout.partition_keys).sortWithinPartitions(*order)

    def register(self, layout: TableLayout) -> None:
        """Make the stored table known to SQL, with its columns, constraints and partitions."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable or f.name in layout.partition_keys else ' NOT NULL'}"
            for f in self._stored_schema(layout).fields if f.name not in layout.extra.names)
        keys = ", ".join(f"`{key}`" for key in layout.partition_keys)
        table = self.qualified(layout)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
                       f"PARTITIONED BY ({keys}) LOCATION '{self.location(layout)}'")
        self.spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(f"{self.database}.{layout.name}")


def write_checked(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a plain Parquet folder and return it as read back, without a table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run independent writes at the same time, so that a small one does not leave the cluster idle.

    Each has a scheduler pool of its own, which share the cluster evenly where the session's scheduler is fair. All are
    waited for; then the first failure, if any, is raised.
    """

    def in_own_pool(number: int, job: Callable[[], None]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"write{number}")
        job()

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(in_own_pool), number, job)
                   for number, job in enumerate(jobs)]
    for done in running:
        done.result()
