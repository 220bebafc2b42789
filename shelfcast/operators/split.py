"""Train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shares of the two splits.
REGRESSION_PARTS = {"train": 0.70, "validation": 0.15, "test": 0.15}
INVENTORY_PARTS = {"train": 0.80, "test": 0.20}


def split_by_key(features: DataFrame, parts: dict[str, float]) -> DataFrame:
    """Add ``split``: the part each product-month belongs to.

    The part follows from a hash of the key alone, so a row lands in the same part
    whatever the partitioning, after a lost executor, and on the next run.
    """
    key = F.concat_ws("|", "Description", F.date_format("InvoiceMonth", "yyyy-MM-dd"))
    prefix = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    position = prefix / F.lit(float(16**8))
    *named, last = parts
    label, bound = F.lit(last), 1.0 - parts[last]
    for name in reversed(named):
        label = F.when(position < round(bound, 10), name).otherwise(label)
        bound -= parts[name]
    return features.withColumn("split", label)


def random_split(features: DataFrame, parts: dict[str, float], seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; repeatable only for an unchanged partitioning."""
    return features.randomSplit(list(parts.values()), seed=seed)
