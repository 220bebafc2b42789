"""Exact money arithmetic on integer units, double at the edge.

Amounts are held as ten-thousandths of the currency in a bigint. Integer sums do
not depend on the order in which partitions arrive, so a total is the same number
whatever the cluster does, and a bigint buffer keeps hash aggregation in codegen
(a decimal wider than 18 digits would not).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
UNITS_PER_CENT = UNITS // 100


def to_units(amount: Column) -> Column:
    return F.rint(amount * F.lit(float(UNITS))).cast("bigint")


def from_units(units: Column) -> Column:
    return units / F.lit(float(UNITS))


def mean_of_units(total: Column, count: Column) -> Column:
    """Unrounded mean; null for an empty group, like ``avg``."""
    return F.try_divide(total.cast("double"), count * F.lit(float(UNITS)))


def mean_to_cents(total: Column, count: Column) -> Column:
    """Mean rounded half-up to two places without passing through a double."""
    step = F.nullif(count * F.lit(2 * UNITS_PER_CENT), F.lit(0))
    shifted = F.abs(total) * F.lit(2) + count * F.lit(UNITS_PER_CENT)
    cents = F.call_function("div", shifted, step)
    return F.when(total < 0, -cents).otherwise(cents) / F.lit(100.0)


def sum_units(amount: str) -> Column:
    return F.sum(to_units(F.col(amount)))
