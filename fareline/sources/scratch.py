"""A folder every executor can reach, for tables written and read back within a job."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="fareline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    Only a local master without that setting gets a temporary folder of this machine, which is removed when the
    program ends.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch folders that are made inside when it ends, also by an error; what needs them must be stored by then."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it is; one that is not there is none to delete."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
