"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_KEY = "yyyy-MM"


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_key(date: Column) -> Column:
    return F.date_format(date, MONTH_KEY)


def year_text(date: Column) -> Column:
    return F.date_format(date, "yyyy")


def quarter_label(month: Column) -> Column:
    """``Q1``..``Q4`` from a month number; anything outside 1..12 stays null."""
    quarter = F.when(month.between(1, 12), F.ceil(month / F.lit(3)))
    return F.concat(F.lit("Q"), quarter.cast("string"))


def holiday_date(year: Column, month_day: Column) -> Column:
    """Date from a year and a text such as ``Jan 1``; null where it does not parse."""
    text = F.concat_ws(" ", year.cast("string"), month_day)
    return F.try_to_timestamp(text, F.lit("yyyy MMM d")).cast("date")


def to_month(text: Column) -> Column:
    """Lenient text to date, null where it does not parse."""
    return F.try_to_timestamp(text).cast("date")
