"""Model inputs: frequency index and feature vectors."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

# What the two models look at.
REGRESSION_INPUTS = [
    "prev_month_sales",
    "sales_delta",
    "rolling_3m_avg",
    "is_holiday_month",
    "DescriptionIndex",
]
INVENTORY_INPUTS = ["prev_month_sales", "sales_delta", "is_holiday_month", "DescriptionIndex"]
NOMINAL, ORDINAL = "nominal", "ordinal"


def frequency_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Dense index of the values of a column, most frequent first, ties by name.

    The same numbers MLlib's string indexer gives, without sending the values to the
    driver or ranking them in one task: values are range-partitioned in rank order,
    ranked inside each partition, and shifted by the sizes of the partitions before.
    The partitioned values are stored because range bounds are sampled, so a
    recomputation could draw them differently.
    """
    rank = [F.col("n_rows").desc(), F.col(column).asc()]
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    placed = cut_lineage(
        counts.repartitionByRange(*rank).withColumn("_part", F.spark_partition_id())
    )
    # One row per partition, so an unpartitioned window is bounded by the cluster size.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*rank))
    return (
        placed.withColumn("_inside", inside)
        .join(shifts, "_part")
        .select(column, (F.col("_shift") + F.col("_inside") - 1).alias(index), "n_rows")
    )


def product_index(features: DataFrame) -> DataFrame:
    return frequency_index(features, "Description", "DescriptionIndex")


def label_index(features: DataFrame) -> DataFrame:
    return frequency_index(features, "stock_decision", "label")


def check_encoding(encoding: str) -> None:
    if encoding not in (NOMINAL, ORDINAL):
        raise ValueError(f"encoding must be {NOMINAL!r} or {ORDINAL!r}, not {encoding!r}")


def with_product_index(
    features: DataFrame, index: DataFrame, levels: int, encoding: str = NOMINAL
) -> DataFrame:
    """Attach the product index as a model input, at every size as ``encoding`` says.

    ``nominal``: trees split on sets of products. ``ordinal``: a number ordered by
    frequency, trees split on ranges of it. Spark chooses the join.
    """
    check_encoding(encoding)
    nominal = {"ml_attr": {"type": "nominal", "name": "DescriptionIndex", "num_vals": levels}}
    value = F.col("DescriptionIndex").cast("double")
    keys = index.select("Description", "DescriptionIndex")
    joined = features.join(keys, "Description")
    return joined.withColumn(
        "DescriptionIndex",
        value.alias("DescriptionIndex", metadata=nominal) if encoding == NOMINAL else value,
    )


def bins_for(levels: int, encoding: str = NOMINAL) -> int:
    """Histogram bins a forest needs: one per nominal level, never below Spark's default."""
    return max(32, levels) if encoding == NOMINAL else 32


def assemble(df: DataFrame, inputs: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)
