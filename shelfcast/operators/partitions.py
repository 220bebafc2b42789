"""Row placement for iterative training."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame

ROWS_PER_PARTITION = 5_000


def partitions_for(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Training partitions for a row count; a function of the data, not of the cluster.

    They grow in proportion at every size. Each ships its own histograms, so a caller with
    very many rows may want more of them in a partition.
    """
    return max(1, ceil(rows / rows_per_partition))


def stable_partitions(
    df: DataFrame, keys: list[str], rows: int, rows_per_partition: int = ROWS_PER_PARTITION
) -> DataFrame:
    """Same rows in the same partition and order on every run.

    Seeded sampling draws by partition and row position; hashing on a unique key and
    sorting inside makes both a function of the data.
    """
    return df.repartition(partitions_for(rows, rows_per_partition), *keys).sortWithinPartitions(*keys)
