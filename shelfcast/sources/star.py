"""Transactions from a star schema of line items, orders and parts.

Each table is brought to its contract columns before the join, so a product name is
formed once per part and a date shifted once per order, not once per line. No hint is
given: Spark broadcasts ``part`` or ``orders`` while their measured size
is below its threshold and sort-merges beyond it, where adaptive execution splits a
key that holds too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHIFT_MONTHS = 168  # moves 1995 onto 2009, where the bundled calendar starts

_LINEITEM = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ]
)
_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)
_PART = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def star_transactions(spark: SparkSession, folder: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity")
    order_key = F.col("l_orderkey").cast("string")
    lines = spark.read.schema(_LINEITEM).parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey",
        "l_partkey",
        F.concat(F.when(returned, "C").otherwise(""), order_key).alias("Invoice"),
        F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
    )
    orders = spark.read.schema(_ORDERS).parquet(f"{folder}/orders.parquet").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("Customer ID"),
        F.add_months(F.col("o_orderdate").cast("date"), SHIFT_MONTHS).alias("InvoiceDate"),
    )
    parts = spark.read.schema(_PART).parquet(f"{folder}/part.parquet").select(
        "p_partkey",
        F.concat_ws(" ", "p_type", "p_name").alias("Description"),
        F.col("p_retailprice").alias("Price"),
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("Invoice", "Description", "Quantity", "Price", "Customer ID", "InvoiceDate")
    )
