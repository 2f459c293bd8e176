"""Helpers shared by the text operators: column access, Arrow mapping, saved tables, row selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareline.sources.scratch import new_scratch_dir

# Rows handed to a text function at once; bounds what a Python worker holds besides one Arrow batch.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *columns: tuple[str, str, str]) -> DataFrame:
    """``(name, type, new name)`` of each wanted column, found by position.

    Columns are renamed by position first, so frames whose other columns differ from a wanted one in
    case only, contain dots or repeat a name of the result cannot make a reference ambiguous.
    """
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{place_of(df.columns, name)}").cast(kind).alias(alias) for name, kind, alias in columns))


def place_of(columns: list[str], name: str) -> int:
    """Where a column stands: the one of that name, else the first that differs in case only."""
    if name in columns:
        return columns.index(name)
    return [c.lower() for c in columns].index(name.lower())


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pick(docs, (id_col, "long", "doc_id"), (text_col, "string", "text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(docs: DataFrame, fn: Callable[[list, list], dict], schema: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``fn(ids, texts)`` per slice of rows, giving columns by name; one pass over the rows, no shuffle.

    ``fn`` is called with Python lists that may hold None.
    """
    spark_schema = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            out = fn(piece.column(0).to_pylist(), piece.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return texts_of(docs, id_col, text_col).mapInArrow(run, spark_schema)


class Saved:
    """Tables written to the shared checkpoint folder and read back, which cuts lineage.

    Loops write to two places in turn, so that what they leave behind does not grow with the rounds.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, new_scratch_dir(spark, label)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept(doc_id, text_hash)``, with all their columns.

    ``text_hash`` is ``xxhash64`` of the whole text (null: empty). Of rows that repeat both id and
    text one is returned. The text is moved once, to meet its decision.
    """
    columns = docs.columns
    n = len(columns)
    at = {name: place_of(columns, name) for name in ("doc_id", "text")}
    plain = docs.toDF(*(f"c{i}" for i in range(n)))

    def keyed(df: DataFrame, doc_id: Column, hashed: Column) -> DataFrame:
        # Without nulls, so that join and window ask for the same partitions and order, and the text moves once.
        return df.withColumns({"row_id": F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")),
                               "row_has_id": doc_id.isNotNull(), "row_hash": hashed})

    keys = ["row_id", "row_has_id", "row_hash"]
    wanted = keyed(kept, F.col("doc_id"), F.col("text_hash")).select(*keys)
    matched = keyed(plain, F.col(f"c{at['doc_id']}"), text_hash(F.col(f"c{at['text']}"))).join(wanted, keys, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("row_id"))
    once = matched.withColumn("nth", nth).filter(F.col("nth") == 1)
    return once.select(*(f"c{i}" for i in range(n))).toDF(*columns)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
