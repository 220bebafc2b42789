"""Quarterly and January / December averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import quarter_label, year_text
from shelfcast.functions.money import mean_to_cents, sum_units


def _mean_sales(name: str):
    return mean_to_cents(sum_units("TotalPrice"), F.count("TotalPrice")).alias(name)


def quarterly_summary(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("Description", quarter_label(F.col("Month")).alias("Quarter"))
        .agg(_mean_sales("avg_quarter_sales"))
    )


def newyear_vs_christmas(features: DataFrame) -> DataFrame:
    """January and December averages per product and year; the year is text."""
    return (
        features.filter(F.col("Month").isin(1, 12))
        .groupBy("Description", year_text(F.col("InvoiceMonth")).alias("Year"), "Month")
        .agg(_mean_sales("avg_monthly_sales"))
    )
