"""Scans and sinks of stage tables, reports and metric documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import audit

_OVERFLOW = "_overflow"


# -- scans ---------------------------------------------------------------------------


def read_stage(
    spark: SparkSession, path: str, table: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Folder of part files written by another stage; fails if it is not there."""
    reader = spark.read.schema(table)
    if fmt == "csv":
        reader = (
            reader.option("header", True).option("enforceSchema", False).option("escape", '"')
        )
    return reader.format(fmt).load(path)


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(
    spark: SparkSession, path: str, table: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """As ``read_stage``, but a missing folder is an empty table."""
    try:
        return read_stage(spark, path, table, fmt)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return empty_table(spark, table)


def empty_table(spark: SparkSession, table: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in table])


def read_tolerant(
    spark: SparkSession, path: str, table: T.StructType, header: bool = True
) -> DataFrame:
    """CSV folder read as leniently as a person would read it.

    Lines with more fields than the header are skipped, short lines are padded with
    null, fields of the wrong type become null, and a missing folder is an empty table.
    """
    wide = T.StructType(table.fields + [T.StructField(_OVERFLOW, T.StringType())])
    try:
        rows = spark.read.schema(wide).option("header", header).option("escape", '"').csv(path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return empty_table(spark, table)
    return rows.filter(F.col(_OVERFLOW).isNull()).drop(_OVERFLOW)


def read_metrics(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """Metric document as a one-row table; empty if there is none."""
    try:
        return spark.read.schema(table).option("multiLine", True).json(path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return empty_table(spark, table)


def tidy_header(df: DataFrame) -> DataFrame:
    """Column names without outer blanks."""
    return df.toDF(*[name.strip() for name in df.columns])


def has_columns(df: DataFrame, names: set[str]) -> bool:
    return names <= set(df.columns)


# -- sinks ---------------------------------------------------------------------------


def write_stage(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    sort_by: list[str] | None = None,
    single_file: bool = False,
) -> int:
    """Overwrite a stage folder; returns the rows written.

    ``sort_by`` range-partitions, so file order is global order and the write stays
    parallel. ``single_file`` is for summaries whose size does not grow with the data;
    it adds a one-task exchange after the aggregation instead of running the
    aggregation itself in one task. Rows are counted as they are written, with no extra
    scan; the counter is the last step, because a step below a sort runs a second time
    when the sort samples its range bounds.
    """
    if single_file:
        df = df.repartition(1)
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
    elif sort_by:
        df = df.orderBy(*sort_by)
    watched, seen = audit.counted(df)
    writer = watched.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)
    return seen.get["n_rows"]


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One-row metric table as a JSON document."""
    metrics.repartition(1).write.mode("overwrite").json(path)
