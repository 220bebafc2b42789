"""Row counts of stages, taken while the stage is written."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach a row count to a table; it is filled by the next action, with no extra scan."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def audit_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    table = pa.table({"stage": list(counts), "n_rows": list(counts.values())})
    return spark.createDataFrame(table, "stage string, n_rows bigint")
