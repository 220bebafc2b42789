"""Report tables: forecast explorer, top lists, heat map, match rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.money import from_units, sum_units
from shelfcast.functions.text import to_number

# Month labels of the January / December view.
MONTH_LABELS = {1: "New Year (Jan)", 12: "Christmas (Dec)"}

# Default lengths of the top lists, and the heat-map columns.
TOP_HOLIDAY_PRODUCTS = 10
HEATMAP_PRODUCTS = 12
QUARTERS = ["Q1", "Q2", "Q3", "Q4"]


# -- generic steps -------------------------------------------------------------------


def for_product(df: DataFrame, product: str) -> DataFrame:
    return df.filter(F.col("Description") == product)


def for_products(df: DataFrame, products: list[str]) -> DataFrame:
    return df.filter(F.col("Description").isin(products))


def between_months(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Inclusive month range; an open end is no restriction."""
    if first is not None:
        df = df.filter(F.col("InvoiceMonth") >= F.lit(first))
    if last is not None:
        df = df.filter(F.col("InvoiceMonth") <= F.lit(last))
    return df


def product_list(df: DataFrame) -> DataFrame:
    return df.select("Description").distinct()


def product_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("Description").alias("n_products"))


def month_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("InvoiceMonth").alias("first_month"), F.max("InvoiceMonth").alias("last_month")
    )


def numeric_only(df: DataFrame, column: str) -> DataFrame:
    """Column as a number, rows where it is not one dropped."""
    return df.withColumn(column, to_number(F.col(column))).dropna(subset=[column])


def ranked(df: DataFrame, measure: str, tie_break: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), F.col(tie_break).asc())


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


# -- forecasts -----------------------------------------------------------------------


def forecast_explorer(
    predictions: DataFrame,
    products: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Actual next to predicted sales for chosen products and months."""
    chosen = for_products(predictions, products) if products is not None else predictions
    return between_months(chosen, first, last).select(
        "Description", "InvoiceMonth", "TotalPrice", "prediction"
    )


def product_mae(predictions: DataFrame) -> DataFrame:
    """Mean absolute error of every product, in one pass."""
    error = F.abs(F.col("TotalPrice") - F.col("prediction"))
    return predictions.groupBy("Description").agg(F.avg(error).alias("mae"))


def with_match(predictions: DataFrame) -> DataFrame:
    right = F.col("stock_decision") == F.col("predicted_label")
    return predictions.withColumn("match", F.when(right, "Correct").otherwise("Wrong"))


def match_counts(predictions: DataFrame) -> DataFrame:
    return (
        with_match(predictions)
        .groupBy(F.col("match").alias("Match"))
        .agg(F.count(F.lit(1)).alias("Count"))
    )


def class_by_match(predictions: DataFrame) -> DataFrame:
    return (
        with_match(predictions)
        .groupBy("predicted_label", "match")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# -- holidays and seasons ------------------------------------------------------------


def top_holiday_products(products: DataFrame, n: int = TOP_HOLIDAY_PRODUCTS) -> DataFrame:
    return ranked(numeric_only(products, "total_sales"), "total_sales", "Description").limit(n)


def quarterly_scores(quarterly: DataFrame) -> DataFrame:
    """Sum of a product's quarterly averages."""
    return quarterly.groupBy("Description").agg(
        from_units(sum_units("avg_quarter_sales")).alias("score")
    )


def heatmap_products(quarterly: DataFrame, n: int = HEATMAP_PRODUCTS) -> DataFrame:
    return ranked(quarterly_scores(quarterly), "score", "Description").limit(n)


def heatmap_rows(quarterly: DataFrame, n: int = HEATMAP_PRODUCTS) -> DataFrame:
    """Quarterly averages of the ``n`` products with the highest score."""
    keys = heatmap_products(quarterly, n).select("Description")
    return quarterly.join(keys, "Description", "left_semi")


def quarterly_heatmap(quarterly: DataFrame, n: int = HEATMAP_PRODUCTS) -> DataFrame:
    """One row per top product, one column per quarter."""
    return (
        heatmap_rows(quarterly, n)
        .groupBy("Description")
        .pivot("Quarter", QUARTERS)
        .agg(F.max("avg_quarter_sales"))
    )


def quarter_by_product(quarterly: DataFrame, products: list[str]) -> DataFrame:
    """One row per quarter, one column per named product.

    The product list is given, so the pivot needs no pass to find its columns.
    """
    return (
        for_products(quarterly, products)
        .groupBy("Quarter")
        .pivot("Description", products)
        .agg(F.max("avg_quarter_sales"))
    )


def with_month_label(seasonal: DataFrame) -> DataFrame:
    """Readable month; null for months that have no label."""
    pairs = [F.lit(part) for pair in MONTH_LABELS.items() for part in pair]
    return seasonal.withColumn(
        "MonthLabel", F.try_element_at(F.create_map(*pairs), F.col("Month"))
    )
