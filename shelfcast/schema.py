"""Table contracts shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TxColumns:
    """Names of the transaction columns an operator reads."""

    invoice: str = "Invoice"
    product: str = "Description"
    quantity: str = "Quantity"
    price: str = "Price"
    customer: str = "Customer ID"
    date: str = "InvoiceDate"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _DATE = T.DoubleType(), T.DateType()

# Column order of a raw transaction file; StockCode and Country are carried in the
# file but never read by an operator, so the scan prunes them.
TRANSACTIONS = _struct(
    ("Invoice", _TEXT),
    ("StockCode", _TEXT),
    ("Description", _TEXT),
    ("Quantity", _DOUBLE),
    ("InvoiceDate", T.TimestampType()),
    ("Price", _DOUBLE),
    ("Customer ID", _DOUBLE),
    ("Country", _TEXT),
)

HOLIDAYS = _struct(
    ("Year", _INT),
    ("Date", _TEXT),
    ("Day", _TEXT),
    ("Name", _TEXT),
    ("Type", _TEXT),
    ("Details", _TEXT),
)

MONTHLY_SALES = _struct(
    ("Description", _TEXT), ("InvoiceMonth", _DATE), ("TotalPrice", _DOUBLE)
)

FEATURES = _struct(
    ("Description", _TEXT),
    ("InvoiceMonth", _DATE),
    ("TotalPrice", _DOUBLE),
    ("Year", _INT),
    ("Month", _INT),
    ("prev_month_sales", _DOUBLE),
    ("rolling_3m_avg", _DOUBLE),
    ("sales_delta", _DOUBLE),
    ("is_holiday_month", _INT),
)

FEATURES_LABELED = T.StructType(FEATURES.fields + [T.StructField("stock_decision", _TEXT)])

PREDICTIONS = _struct(
    ("Description", _TEXT),
    ("InvoiceMonth", _DATE),
    ("TotalPrice", _DOUBLE),
    ("prediction", _DOUBLE),
)

PREDICTIONS_INVENTORY = _struct(
    ("Description", _TEXT),
    ("InvoiceMonth", _DATE),
    ("stock_decision", _TEXT),
    ("predicted_label", _TEXT),
)

HOLIDAY_IMPACT = _struct(("Name", _TEXT), ("avg_sales", _DOUBLE))

HOLIDAY_PRODUCTS = _struct(
    ("Description", _TEXT), ("total_quantity", _DOUBLE), ("total_sales", _DOUBLE)
)

QUARTERLY_SUMMARY = _struct(
    ("Description", _TEXT), ("Quarter", _TEXT), ("avg_quarter_sales", _DOUBLE)
)

NEWYEAR_VS_CHRISTMAS = _struct(
    ("Description", _TEXT),
    ("Year", _TEXT),
    ("Month", _INT),
    ("avg_monthly_sales", _DOUBLE),
)

REGRESSION_METRICS = T.StructType(
    [
        T.StructField("RMSE", _DOUBLE),
        T.StructField("MAE", _DOUBLE),
        T.StructField(
            "Best Hyperparameters", _struct(("numTrees", _INT), ("maxDepth", _INT))
        ),
    ]
)

CLASSIFICATION_METRICS = _struct(
    ("accuracy", _DOUBLE),
    ("f1", _DOUBLE),
    ("weightedPrecision", _DOUBLE),
    ("weightedRecall", _DOUBLE),
)
