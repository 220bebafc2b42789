"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage, ship_package

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
BATCH_SETTING, SPARK_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
BATCH_ROWS = 1000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", none).otherwise(F.split(trimmed, SPACE))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are; ``lower`` does that to ASCII texts, faster."""
    plain = F.octet_length(text) == F.char_length(text)
    mapped = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def word_bytes(text: str | None) -> list[bytes]:
    """The same words with A-Z lower-cased, as UTF-8 (``bytes`` knows ASCII blanks only)."""
    return text.encode("utf-8").lower().split() if text else []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and let Python steps take
    ``BATCH_ROWS`` rows at a time where the session leaves Spark's own number: texts may be long,
    and a batch is held several times over, in the executor and in its worker."""
    if spark.conf.get(BATCH_SETTING) == SPARK_BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    ship_package(spark)


def lean(run: Callable) -> Callable:
    """A step of ``mapInArrow`` whose worker gives back the memory that Arrow would keep for later
    batches: workers stay when their tasks end, several to a core if steps follow one another."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return wrapped


def stored(df: DataFrame) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and go on from there."""
    return cut_lineage(df)
