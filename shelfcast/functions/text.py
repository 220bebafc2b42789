"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_key(description: Column) -> Column:
    """Product names are keys: outer blanks must not make two products out of one."""
    return F.trim(description)


def plain_text(text: Column) -> Column:
    """Lower-cased text, empty instead of null."""
    return F.lower(F.coalesce(text, F.lit("")))


def to_number(text: Column) -> Column:
    """Double, or null where the text is not a number."""
    return text.try_cast("double")
