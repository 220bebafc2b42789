"""Random forests: demand regression and stock-decision classification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.encode import (
    INVENTORY_INPUTS,
    NOMINAL,
    REGRESSION_INPUTS,
    assemble,
    bins_for,
    product_index,
    with_product_index,
)
from shelfcast.operators.metrics import classification_metrics, regression_metrics
from shelfcast.operators.partitions import ROWS_PER_PARTITION, stable_partitions
from shelfcast.operators.split import INVENTORY_PARTS, REGRESSION_PARTS, split_by_key

# The tuning grid, its hold-out ratio and the seed.
TREES = (10, 20)
DEPTHS = (5, 10)
TRAIN_RATIO = 0.8
TRAIN_SHARE = 0.5  # of all rows are in the tuning's training part, at least
SEED = 42
KEYS = ["Description", "InvoiceMonth"]


@dataclass(frozen=True)
class Tuning:
    """How a forest is tuned.

    ``parallelism`` grid points train at once. ``memory_mb`` bounds the histograms one
    task keeps: trees of many bins then take more passes instead of more memory; the default
    is MLlib's own. ``encoding`` says what the product index is to the trees: ``nominal`` or
    ``ordinal``.
    """

    trees: tuple[int, ...] = TREES
    depths: tuple[int, ...] = DEPTHS
    train_ratio: float = TRAIN_RATIO
    seed: int = SEED
    parallelism: int = 4
    memory_mb: int = 256
    encoding: str = NOMINAL
    rows_per_partition: int = ROWS_PER_PARTITION


@dataclass(frozen=True)
class Forecast:
    """Scored test rows, and the fitted model."""

    predictions: DataFrame
    model: object

    @property
    def best_parameters(self) -> dict[str, int]:
        best = self.model.bestModel
        return {"numTrees": best.getNumTrees, "maxDepth": best.getOrDefault("maxDepth")}


def model_inputs(
    features: DataFrame, inputs: list[str], encoding: str = NOMINAL
) -> tuple[DataFrame, int, int]:
    """Feature vectors, the number of products behind them, and their row count."""
    index = product_index(features)
    size = index.agg(F.count(F.lit(1)).alias("levels"), F.sum("n_rows").alias("rows")).first()
    if encoding == NOMINAL and size.levels > (size.rows or 0) * TRAIN_SHARE:
        # MLlib needs at least as many training rows as a nominal input has levels
        raise ValueError("too few rows for so many products: pass encoding='ordinal'")
    vectors = assemble(with_product_index(features, index, size.levels, encoding), inputs)
    return vectors, size.levels, size.rows or 0


def tune(forest, evaluator: Evaluator, train: DataFrame, rows: int, tuning: Tuning):
    """Best forest of the grid by one seeded hold-out split of the training rows."""
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(tuning.trees))
        .addGrid(forest.maxDepth, list(tuning.depths))
        .build()
    )
    search = TrainValidationSplit(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=tuning.train_ratio,
        seed=tuning.seed,
        parallelism=tuning.parallelism,
    )
    placed = stable_partitions(train, KEYS, rows, tuning.rows_per_partition).persist()
    try:
        return search.fit(placed)
    finally:
        placed.unpersist()


def demand_forecast(
    features: DataFrame, inputs: list[str] = REGRESSION_INPUTS, tuning: Tuning = Tuning()
) -> Forecast:
    """Predict monthly sales.

    The default inputs hold the label in disguise (``sales_delta`` plus
    ``rolling_3m_avg`` is the month's own sales), so scores say little about
    forecasting; pass other ``inputs`` for a model that only knows the past.
    ``features`` is read many times: pass a stored table.
    """
    vectors, levels, rows = model_inputs(features, inputs, tuning.encoding)
    parts = split_by_key(vectors, REGRESSION_PARTS)
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="TotalPrice",
        maxBins=bins_for(levels, tuning.encoding),
        seed=tuning.seed,
        maxMemoryInMB=tuning.memory_mb,
    )
    rmse = RegressionEvaluator(labelCol="TotalPrice", metricName="rmse")
    model = tune(forest, rmse, parts.filter(F.col("split") == "train"), rows, tuning)
    scored = model.transform(parts.filter(F.col("split") == "test"))
    return Forecast(scored.select(*KEYS, "TotalPrice", "prediction"), model)


def stock_forecast(
    labeled: DataFrame, inputs: list[str] = INVENTORY_INPUTS, tuning: Tuning = Tuning()
) -> Forecast:
    """Predict the stock decision of a product-month; read many times, as above."""
    labels = StringIndexer(inputCol="stock_decision", outputCol="label").fit(labeled)
    vectors, levels, rows = model_inputs(labels.transform(labeled), inputs, tuning.encoding)
    parts = split_by_key(vectors, INVENTORY_PARTS)
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        maxBins=bins_for(levels, tuning.encoding),
        seed=tuning.seed,
        maxMemoryInMB=tuning.memory_mb,
    )
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    model = tune(forest, accuracy, parts.filter(F.col("split") == "train"), rows, tuning)
    named = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=labels.labels
    )
    scored = named.transform(model.transform(parts.filter(F.col("split") == "test")))
    return Forecast(scored.select(*KEYS, "stock_decision", "predicted_label"), model)


def demand_metrics(forecast: Forecast) -> DataFrame:
    """RMSE, MAE and the chosen parameters, in the layout of the metric document."""
    best = [F.lit(v).cast("int").alias(k) for k, v in forecast.best_parameters.items()]
    return regression_metrics(forecast.predictions).withColumn(
        "Best Hyperparameters", F.struct(*best)
    )


def stock_metrics(forecast: Forecast) -> DataFrame:
    return classification_metrics(forecast.predictions)
