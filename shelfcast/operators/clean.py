"""Transaction lines: cleaning and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import month_start
from shelfcast.functions.money import from_units, to_units
from shelfcast.functions.text import product_key
from shelfcast.schema import TxColumns

# Fixed value: how the invoice number of a cancellation starts.
CANCELLED_PREFIX = "C"


def drop_cancelled(tx: DataFrame, c: TxColumns = TxColumns()) -> DataFrame:
    """Keep invoices without the cancellation prefix; a null invoice is not kept."""
    return tx.filter(~F.col(c.invoice).startswith(CANCELLED_PREFIX))


def keep_positive(tx: DataFrame, c: TxColumns = TxColumns()) -> DataFrame:
    return tx.filter((F.col(c.quantity) > 0) & (F.col(c.price) > 0))


def keep_known_customers(tx: DataFrame, c: TxColumns = TxColumns()) -> DataFrame:
    return tx.filter(F.col(c.customer).isNotNull())


def with_sales(tx: DataFrame, c: TxColumns = TxColumns()) -> DataFrame:
    """Project to the columns every later step needs.

    ``Description`` (trimmed), ``Quantity``, ``TotalPrice``, ``InvoiceDate`` as a date
    and ``InvoiceMonth`` as the first day of its month.
    """
    day = F.to_date(F.col(c.date))
    quantity = F.col(c.quantity).cast("double")
    units = to_units(quantity * F.col(c.price))  # rounded once, after multiplying
    return tx.select(
        F.col(c.invoice).alias("Invoice"),
        product_key(F.col(c.product)).alias("Description"),
        quantity.alias("Quantity"),
        from_units(units).alias("TotalPrice"),
        day.alias("InvoiceDate"),
        month_start(day).alias("InvoiceMonth"),
    )


def clean_transactions(tx: DataFrame, c: TxColumns = TxColumns()) -> DataFrame:
    """Sales lines only: no cancellations, no returns, no unknown customers.

    A line without a date stays a sale; it is in no month (``rollup.monthly_totals``).
    """
    return with_sales(keep_known_customers(keep_positive(drop_cancelled(tx, c), c), c), c)
