"""Membership tests and default lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HIT = "__hit"
_KNOWN = "__known"


def marked_if_any(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """``left`` with ``name``: whether the key occurs in ``right``; true everywhere when ``right`` is empty.

    The emptiness test is an uncorrelated EXISTS, evaluated once by Spark as a subquery.
    """
    keys = right.select(key)
    known = keys.distinct()
    marked = left.join(known.withColumn(_HIT, F.lit(1)), key, "left")
    return marked.select(*left.columns, (F.col(_HIT).isNotNull() | ~keys.exists()).alias(name))


def semi_if_any(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; all rows when ``right`` is empty."""
    return marked_if_any(left, right, key, _KNOWN).where(_KNOWN).select(*left.columns)


def lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, value: str, name: str
) -> DataFrame:
    """Append ``right.value`` as ``name``, 0 for unknown or null keys; right keys are unique.

    No broadcast hint: adaptive execution broadcasts the right side when its measured size allows.
    """
    found = right.select(F.col(right_key).alias("__key"), F.col(value).alias("__value"))
    joined = left.join(found, F.col(left_key) == F.col("__key"), "left")
    return joined.select(
        *left.columns, F.coalesce(F.col("__value"), F.lit(0)).alias(name)
    )
