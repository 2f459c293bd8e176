"""Run a query on Spark and its SQL on DuckDB and compare them as bags of rows."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _sortable(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def bag(rows):
    clean = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(clean, key=_sortable)


def compare(spark, con, query, sql, sf_dir):
    """(problems, spark row count); values must be exactly equal."""
    actual = query(spark, sf_dir)
    relation = con.execute(sql)
    expected_names = [d[0] for d in relation.description]
    expected_rows = relation.fetchall()
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    names = sorted(actual.columns)
    problems = []
    if names != sorted(expected_names):
        return [f"columns {names} != {sorted(expected_names)}"], 0
    for field in actual.schema.fields:
        kind = field.dataType.simpleString()
        if SPARK_TO_DUCK.get(kind) != described[field.name]:
            problems.append(f"type of {field.name}: {kind} != {described[field.name]}")
    order = [expected_names.index(n) for n in names]
    left = bag(tuple(r) for r in actual.select(*names).collect())
    right = bag(tuple(r[i] for i in order) for r in expected_rows)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows != {len(right)}")
    else:
        different = [(a, b) for a, b in zip(left, right) if a != b]
        if different:
            problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems, len(left)
