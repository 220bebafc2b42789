"""Product and product-month totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.money import from_units, sum_units

# Fixed value: how many best sellers are analysed.
TOP_PRODUCTS = 1000


def monthly_totals(sales: DataFrame) -> DataFrame:
    """Sales per product and month, every product.

    Partial sums are formed before the shuffle, so one very popular product costs one
    row per task and month, not one row per sale. Lines without a date are in no month.
    """
    dated = sales.filter(F.col("InvoiceMonth").isNotNull())
    return dated.groupBy("Description", "InvoiceMonth").agg(
        from_units(sum_units("TotalPrice")).alias("TotalPrice")
    )


def product_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per product, from sales lines or from monthly totals."""
    return sales.groupBy("Description").agg(
        from_units(sum_units("TotalPrice")).alias("Revenue")
    )


def top_products(revenue: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` best sellers, ties at the cut broken by name."""
    return revenue.orderBy(F.col("Revenue").desc(), F.col("Description").asc()).limit(n)


def monthly_sales(sales: DataFrame, n: int | None = TOP_PRODUCTS) -> DataFrame:
    """Monthly totals of the ``n`` best-selling products; ``None`` keeps every product."""
    return restrict_to_top(monthly_totals(sales), n)


def restrict_to_top(totals: DataFrame, n: int | None = TOP_PRODUCTS) -> DataFrame:
    """Those of the monthly totals that belong to the ``n`` best-selling products.

    Both the ranking and the result are derived from the same monthly totals, which
    Spark computes once and reads twice (the plan shows a reused exchange): the sales
    lines are scanned and shuffled a single time. That reuse needs both branches to
    stay identical, hence a null-safe inner join: a plain equality would push a
    null filter into one branch, and a semi-join would be pushed below the
    aggregation. Where a later step filters products, which would break it as well, pass
    totals that are stored. Unnamed products compete for a place in the ranking but have
    no series.
    """
    if n is None:
        return totals.filter(F.col("Description").isNotNull())
    ranked = (
        top_products(product_revenue(totals), n)
        .filter(F.col("Description").isNotNull())
        .select(F.col("Description").alias("_top"))
    )
    return totals.join(ranked, F.col("Description").eqNullSafe(F.col("_top"))).drop("_top")
