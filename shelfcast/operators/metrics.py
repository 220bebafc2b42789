"""Model quality, each metric set in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    predictions: DataFrame, label: str = "TotalPrice", predicted: str = "prediction"
) -> DataFrame:
    error = F.col(label) - F.col(predicted)
    return predictions.agg(
        F.round(F.sqrt(F.avg(error * error)), 2).alias("RMSE"),
        F.round(F.avg(F.abs(error)), 2).alias("MAE"),
    )


def confusion(
    predictions: DataFrame, label: str = "stock_decision", predicted: str = "predicted_label"
) -> DataFrame:
    return predictions.groupBy(
        F.col(label).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def classification_metrics(
    predictions: DataFrame,
    label: str = "stock_decision",
    predicted: str = "predicted_label",
    places: int = 4,
) -> DataFrame:
    """Accuracy and class-weighted F1, precision and recall.

    Rows are scanned once, for the confusion counts; the rest is arithmetic on one row
    per class.
    """
    n, zero = F.col("n_rows"), F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)
    as_actual = F.struct(F.col("actual").alias("c"), n.alias("a"), zero.alias("p"), hit.alias("tp"))
    as_predicted = F.struct(
        F.col("predicted").alias("c"), zero.alias("a"), n.alias("p"), zero.alias("tp")
    )
    classes = (
        confusion(predictions, label, predicted)
        .select(F.inline(F.array(as_actual, as_predicted)))
        .groupBy("c")
        .agg(F.sum("a").alias("a"), F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    )
    a, p, tp = F.col("a"), F.col("p"), F.col("tp")
    total = F.sum("a")

    def weighted(score):
        return F.round(F.sum(a * score) / total, places)

    precision = F.when(p > 0, tp / p).otherwise(0.0)
    return classes.agg(
        F.round(F.sum(tp) / total, places).alias("accuracy"),
        weighted(2 * tp / (a + p)).alias("f1"),
        weighted(precision).alias("weightedPrecision"),
        F.round(F.sum(tp) / total, places).alias("weightedRecall"),
    )
