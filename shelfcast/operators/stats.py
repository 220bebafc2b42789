"""Correlation of the numeric features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORRELATED = [
    "TotalPrice",
    "prev_month_sales",
    "rolling_3m_avg",
    "is_holiday_month",
    "Month",
    "sales_delta",
]


def feature_correlation(
    features: DataFrame, columns: list[str] = CORRELATED, places: int | None = None
) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form.

    Each row is unfolded into its pairs of values and every task folds them back into
    one partial result per pair, so the shuffle carries a few numbers per task. (One
    wide aggregation with a correlation per pair is slower: its generated method grows
    past what the JVM compiles.) A pair ignores rows where either side is null.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = ", ".join(
        f"'{a}', '{b}', CAST(`{a}` AS DOUBLE), CAST(`{b}` AS DOUBLE)" for a, b in pairs
    )
    r = F.corr("x", "y")
    upper = (
        features.selectExpr(f"stack({len(pairs)}, {cells}) AS (a, b, x, y)")
        .groupBy("a", "b")
        .agg((r if places is None else F.round(r, places)).alias("corr"))
    )
    as_is = F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b"), "corr")
    mirrored = F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b"), "corr")
    both = F.when(F.col("a") == F.col("b"), F.array(as_is)).otherwise(F.array(as_is, mirrored))
    return upper.select(F.inline(both))


def correlation_matrix(
    features: DataFrame, columns: list[str] = CORRELATED, places: int = 2
) -> DataFrame:
    """The same numbers as a square table, rounded for reading."""
    return (
        feature_correlation(features, columns, places)
        .groupBy("col_a")
        .pivot("col_b", columns)
        .agg(F.first("corr"))
    )
