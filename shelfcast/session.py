"""Session helpers: where jobs may put intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[list[str]] = []  # paths handed out inside each open ``scratch_tables``


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shelfcast-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a fresh temporary folder. On a
    cluster the setting is required: a machine-local folder would not survive the
    loss of that machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    named = named or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    return _local_folder(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder; ``scratch_tables`` removes what is there."""
    path = f"{shared_folder(spark).rstrip('/')}/shelfcast/{name}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when the block ends, whatever its outcome.

    For whole jobs, whose results are written elsewhere: a table that leaves the block
    and is read later must not rest on them.
    """
    made: list[str] = []
    _made.append(made)
    try:
        yield
    finally:
        _made[:] = [other for other in _made if other is not made]
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; for Python steps in tasks."""
    context = spark.sparkContext
    if getattr(context, "_shelfcast_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcast-code-"), "shelfcast_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.join("shelfcast", os.path.relpath(full, top)))
    context.addPyFile(path)
    context._shelfcast_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a table in the shared folder and go on from there.

    For tables that are read many times, or whose rows must not be drawn again. Later
    steps survive lost executors without going back to the raw scan, read only the
    columns they need, and Spark knows the size when it chooses a join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
