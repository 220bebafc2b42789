"""Holiday calendar and what sells around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import holiday_date, month_key, month_start
from shelfcast.functions.money import from_units, mean_to_cents, sum_units


def parse_calendar(holidays: DataFrame) -> DataFrame:
    """Dates and month keys of a calendar; lines whose date does not parse are dropped."""
    day = holiday_date(F.col("Year"), F.col("Date"))
    return (
        holidays.select("Name", "Day", "Type", day.alias("DateParsed"))
        .filter(F.col("DateParsed").isNotNull())
        .select(
            "*",
            month_start(F.col("DateParsed")).alias("holiday_month_start"),
            month_key(F.col("DateParsed")).alias("holiday_month"),
        )
    )


def holiday_months(calendar: DataFrame) -> DataFrame:
    """Distinct months that hold at least one holiday."""
    return calendar.select("holiday_month_start", "holiday_month").distinct()


def holiday_rows(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every feature row next to every holiday of its month.

    A month with several holidays repeats its rows, a month without any keeps them once
    with a null name: right for averages per holiday, wrong for totals.
    """
    named = calendar.select(F.col("holiday_month_start").alias("_month"), "Name")
    return features.join(named, F.col("InvoiceMonth") == F.col("_month"), "left").select(
        *features.columns, month_key(F.col("InvoiceMonth")).alias("month_key"), "Name"
    )


def holiday_impact(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """Average product-month sales per holiday, two places.

    The same averages as grouping ``holiday_rows`` by name, but the features are summed
    per month before the calendar is joined: what is joined has one row per month, and
    nothing is repeated.
    """
    by_month = features.groupBy("InvoiceMonth").agg(
        sum_units("TotalPrice").alias("_units"), F.count("TotalPrice").alias("_rows")
    )
    named = calendar.select(F.col("holiday_month_start").alias("_month"), "Name")
    return (
        by_month.join(named, F.col("InvoiceMonth") == F.col("_month"))
        .filter(F.col("Name").isNotNull())
        .groupBy("Name")
        .agg(mean_to_cents(F.sum("_units"), F.sum("_rows")).alias("avg_sales"))
    )


def in_holiday_months(sales: DataFrame, months: DataFrame) -> DataFrame:
    """Sales lines of months that hold a holiday.

    A semi-join against at most twelve months per year of calendar, broadcast from
    Spark's own size estimate: sales lines are filtered where they are scanned.
    """
    keys = months.select(F.col("holiday_month_start").alias("_month"))
    return sales.join(keys, F.col("InvoiceMonth") == F.col("_month"), "left_semi")


def holiday_products(sales: DataFrame, months: DataFrame) -> DataFrame:
    """Quantity and revenue per product in holiday months.

    ``sales`` are uncleaned lines (``clean.with_sales``): cancellations and returns net
    out, and unnamed products form one group.
    """
    return (
        in_holiday_months(sales, months)
        .groupBy("Description")
        .agg(
            from_units(sum_units("Quantity")).alias("total_quantity"),
            from_units(sum_units("TotalPrice")).alias("total_sales"),
        )
    )
