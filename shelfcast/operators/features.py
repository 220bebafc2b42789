"""Lag, rolling and holiday features of a monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.money import mean_of_units, to_units

# Length of the trailing mean and the band of the stock decision.
ROLLING_MONTHS = 3
INCREASE_ABOVE = 1.2
REDUCE_BELOW = 0.8


def series_features(monthly: DataFrame) -> DataFrame:
    """Previous month, trailing mean and deviation from it.

    Rows are positional: a month without sales has no row, so "previous" is the
    previous active month and the mean covers the last three active months, the
    current one included. The first month of a product has no previous value and is
    dropped. Both windows share one shuffle and one sort, on rows already summed to
    product-months.
    """
    series = Window.partitionBy("Description").orderBy("InvoiceMonth")
    trailing = series.rowsBetween(1 - ROLLING_MONTHS, Window.currentRow)
    units = to_units(F.col("TotalPrice"))
    return (
        monthly.select(
            "Description",
            "InvoiceMonth",
            "TotalPrice",
            F.year("InvoiceMonth").alias("Year"),
            F.month("InvoiceMonth").alias("Month"),
            F.lag("TotalPrice", 1).over(series).alias("prev_month_sales"),
            mean_of_units(F.sum(units).over(trailing), F.count(units).over(trailing)).alias(
                "rolling_3m_avg"
            ),
        )
        .dropna(subset=["prev_month_sales", "rolling_3m_avg"])
        .withColumn("sales_delta", F.col("TotalPrice") - F.col("rolling_3m_avg"))
    )


def flag_holiday_months(features: DataFrame, months: DataFrame) -> DataFrame:
    """1 where the month holds a public holiday, else 0.

    ``months`` has one row per holiday month, at most twelve per year of calendar, so
    Spark broadcasts it from its own size estimate.
    """
    flags = months.select(F.col("holiday_month_start").alias("_month"))
    return features.join(flags, F.col("InvoiceMonth") == F.col("_month"), "left").select(
        *features.columns,
        F.col("_month").isNotNull().cast("int").alias("is_holiday_month"),
    )


def build_features(monthly: DataFrame, months: DataFrame) -> DataFrame:
    return flag_holiday_months(series_features(monthly), months)


def label_stock_decision(
    features: DataFrame,
    increase_above: float = INCREASE_ABOVE,
    reduce_below: float = REDUCE_BELOW,
) -> DataFrame:
    """Increase / Reduce outside a band around the trailing mean, else Maintain.

    The bounds themselves belong to Maintain.
    """
    sales, mean = F.col("TotalPrice"), F.col("rolling_3m_avg")
    return features.withColumn(
        "stock_decision",
        F.when(sales > mean * increase_above, "Increase")
        .when(sales < mean * reduce_below, "Reduce")
        .otherwise("Maintain"),
    )
