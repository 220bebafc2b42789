"""Raw transaction files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schema

UNREADABLE = "_unreadable"
REJECTED = "_rejected"


def read_transactions(
    spark: SparkSession,
    path: str,
    table: T.StructType = schema.TRANSACTIONS,
    timestamp_format: str | None = None,
    fmt: str = "csv",
    keep_unreadable: bool = False,
) -> DataFrame:
    """Scan with a declared schema: one pass, no inference job.

    The format is CSV unless named otherwise; a columnar copy lets the cleaning filters
    skip row groups and reads only the columns in use.

    In CSV, doubled quotes inside a quoted name are read as one quote, a header that
    differs from the declared columns is an error, and fields that do not fit their
    declared type become null: a line without a readable quantity, price or customer is
    dropped by the cleaning step, one without a readable date by the monthly totals.
    ``keep_unreadable`` adds the column ``UNREADABLE`` with the raw text of such lines
    (null on all others), for ``rejects`` and ``readable``. A columnar file has types of
    its own.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    if keep_unreadable:
        table = T.StructType([*table.fields, T.StructField(UNREADABLE, T.StringType())])
    reader = (
        spark.read.schema(table)
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
    )
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def rejects(tx: DataFrame) -> DataFrame:
    """Lines of which some field does not fit: their raw text, and what could be read."""
    return tx.filter(F.col(UNREADABLE).isNotNull() & _all_fields(tx))


def readable(tx: DataFrame) -> DataFrame:
    """The lines of which every field fits."""
    return tx.filter(F.col(UNREADABLE).isNull() & _all_fields(tx)).drop(UNREADABLE)


def routed(tx: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """One scan of ``tx`` to two tables below ``path``: lines that fit, and rejects.

    The write is partitioned by whether a line is rejected, and counts ``lines`` and ``rejects``
    as it goes; whoever reads one side opens none of the other's files.
    """
    flagged = tx.withColumn(
        REJECTED, (F.col(UNREADABLE).isNotNull() & _all_fields(tx)).cast("int")
    )
    seen = Observation()
    watched = flagged.observe(
        seen, F.count(F.lit(1)).alias("lines"), F.sum(REJECTED).alias("rejects")
    )
    watched.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    counts = {name: seen.get[name] or 0 for name in ("lines", "rejects")}
    stored = tx.sparkSession.read.schema(flagged.schema).parquet(path)
    good = stored.filter(F.col(REJECTED) == 0).drop(REJECTED, UNREADABLE)
    return good, stored.filter(F.col(REJECTED) == 1).drop(REJECTED), counts


def _all_fields(tx: DataFrame) -> Column:
    """Always true, but names every column: the reader does not judge fields it need not read."""
    fields = [F.col(f"`{name}`").cast("string") for name in tx.columns if name != UNREADABLE]
    return F.coalesce(*fields, F.lit("")) >= ""
