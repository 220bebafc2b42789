"""Places of rows in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

PART_BITS = 33  # of ``monotonically_increasing_id``: the partition's number stands above


def in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with ``_id`` ascending in that order.

    Stored, because range bounds are sampled and would be drawn anew. ``_id`` has gaps
    between partitions, none inside one. Rows equal in all of ``order`` share a partition.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(spread.withColumn("_id", F.monotonically_increasing_id()))


def part_of(id: Column) -> Column:
    return F.shiftright(id, PART_BITS)


def numbered(df: DataFrame, order: list[Column], name: str, within: str | None = None) -> DataFrame:
    """``df`` with ``name``: its place 0, 1, ... in ``order``.

    With ``within``, places are counted inside each value of that column, null being one; the
    column must lead ``order``. Only one row per partition and value is shifted by a window.
    """
    placed = in_order(df, order)
    keys = [within] if within else []
    held = placed.groupBy(part_of(F.col("_id")).alias("_part"), *keys).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = held.select("_part", *[F.col(k).alias("_within") for k in keys], shift.alias("_shift"))
    same = part_of(placed["_id"]) == starts["_part"]
    if within:
        same &= placed[within].eqNullSafe(starts["_within"])
    return (
        placed.join(starts, same)
        .withColumn(name, F.col("_id") + F.col("_shift"))
        .drop("_id", "_part", "_within", "_shift")
    )
