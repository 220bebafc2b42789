"""Public-holiday calendar."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfcast import schema

# Bank holidays of England and Wales, 2009 to 2011.
UK_BANK_HOLIDAYS = [
    (2011, "Jan 1", "Saturday", "New Year's Day"),
    (2011, "Jan 3", "Monday", "New Year's Day observed"),
    (2011, "Apr 22", "Friday", "Good Friday"),
    (2011, "Apr 29", "Friday", "Royal Wedding Bank Holiday"),
    (2011, "May 2", "Monday", "Early May Bank Holiday"),
    (2011, "May 30", "Monday", "Spring Bank Holiday"),
    (2011, "Dec 25", "Sunday", "Christmas Day"),
    (2011, "Dec 26", "Monday", "Boxing Day"),
    (2011, "Dec 27", "Tuesday", "Substitute Bank Holiday for Christmas Day"),
    (2010, "Jan 1", "Friday", "New Year's Day"),
    (2010, "Apr 2", "Friday", "Good Friday"),
    (2010, "May 3", "Monday", "Early May Bank Holiday"),
    (2010, "May 31", "Monday", "Spring Bank Holiday"),
    (2010, "Dec 25", "Saturday", "Christmas Day"),
    (2010, "Dec 26", "Sunday", "Boxing Day"),
    (2010, "Dec 27", "Monday", "Substitute Bank Holiday for Christmas Day"),
    (2010, "Dec 28", "Tuesday", "Substitute Bank Holiday for Boxing Day"),
    (2009, "Jan 1", "Thursday", "New Year's Day"),
    (2009, "Apr 10", "Friday", "Good Friday"),
    (2009, "May 4", "Monday", "Early May Bank Holiday"),
    (2009, "May 25", "Monday", "Spring Bank Holiday"),
    (2009, "Dec 25", "Friday", "Christmas Day"),
    (2009, "Dec 26", "Saturday", "Boxing Day"),
    (2009, "Dec 28", "Monday", "Substitute Bank Holiday for Boxing Day"),
]


def uk_bank_holidays(spark: SparkSession) -> DataFrame:
    """The bundled calendar, in the layout of a calendar file.

    Built from an Arrow table, which Spark keeps as a local relation of known size (a
    Python list would become an RDD of unknown size and never be broadcast).
    """
    year, date, day, name = (list(column) for column in zip(*UK_BANK_HOLIDAYS))
    n = len(year)
    table = pa.table(
        [year, date, day, name, ["Bank Holiday"] * n, pa.nulls(n, pa.string())],
        names=schema.HOLIDAYS.names,
    )
    return spark.createDataFrame(table, schema.HOLIDAYS)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Calendar file: header, one holiday per line, month and day as ``Jan 1``."""
    return (
        spark.read.schema(schema.HOLIDAYS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )
