"""Surrogate keys that need no single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpipe.workspace import materialise

_POSITION = "__position"
_PART = "__part"
_OFFSET = "__offset"
# monotonically_increasing_id() puts the partition number above bit 33, the row number below.
_ROW_BITS = 33
# Rows of a range, and the fewest where there are idle cores; bins that are counted for each range.
_RANGE_ROWS = 1 << 18
_LEAST_ROWS = 1 << 14
_BINS = 16


def _counted_ranges(counted: DataFrame, key: str) -> tuple[int, Column] | None:
    """Number of ranges of about equal rows, and a row's range, by a count of equal bins of ``key``.

    None where bins can't tell the rows apart: one holds more than two ranges' rows.
    """
    value = F.col(key).cast("bigint")
    low, high, rows = counted.agg(F.min(value), F.max(value), F.count("*")).first()
    if low is None or high - low >= 1 << 62:
        return None
    cores = counted.sparkSession.sparkContext.defaultParallelism
    number = max(-(-rows // _RANGE_ROWS), min(cores, -(-rows // _LEAST_ROWS)))
    width = (high - low) // (_BINS * number) + 1
    place = F.call_function("div", value - F.lit(low), F.lit(width).cast("bigint"))
    held = dict(counted.groupBy(place.alias("bin")).count().collect())
    if number > 1 and max(held.values()) * number > 2 * rows:
        return None
    before = held.get(None, 0)  # nulls sort first
    ranges = []
    for place_no in range((high - low) // width + 1):
        ranges.append(min(before * number // rows, number - 1))
        before += held.get(place_no, 0)
    listed = F.split(F.lit(" ".join(map(str, ranges))), " ").cast("array<int>")
    # Keys outside what was counted go to the outer ranges, so the order holds for them, too.
    inside = F.least(F.greatest(value, F.lit(low)), F.lit(high)) - F.lit(low)
    bin_no = F.call_function("div", inside, F.lit(width).cast("bigint")).cast("int")
    found = F.get(listed, bin_no)
    return number, F.when(value.isNull(), 0).otherwise(found)


def _ranged(df: DataFrame, order: Sequence[str | Column], counted: DataFrame | None) -> DataFrame:
    ranges = None if counted is None else _counted_ranges(counted, order[0])
    return df.repartitionByRange(*order) if ranges is None else df.repartitionById(*ranges)


def dense_id(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    columns: Sequence[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Number the rows 1..n in the order of ``order``, whose last column must be unique.

    One range shuffle spreads the rows (a hot leading key is cut by the later columns), each task
    sorts its range and notes row positions, and the result is written once, because the range
    bounds are sampled and must not be drawn again. The row counts per range, one row per shuffle
    partition, give the offsets; that frame is written too and is all that is broadcast.
    ``columns``: what to keep of the rows, so that columns that only order them are not written.
    ``counted``: a frame with about the rows' values of the first, integral order column and cheap to
    read. Its counts then give the ranges, instead of a sample that computes all of ``df`` once more;
    where a few keys own too much, the sample still does.
    """
    kept = [F.col(f"`{c}`") for c in (df.columns if columns is None else columns)]
    positioned = (
        _ranged(df, order, counted)
        .sortWithinPartitions(*order)
        .select(*kept, F.monotonically_increasing_id().alias(_POSITION))
    )
    stored = materialise(positioned, name)
    part = F.shiftright(_POSITION, _ROW_BITS).cast("int")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(part.alias(_PART))
        .agg(F.count("*").alias("rows"))
        .select(_PART, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(_OFFSET))
    )
    offsets = materialise(offsets, f"{name}-offsets")
    row = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .select((F.col(_OFFSET) + row + 1).alias(name), *kept)
    )


def first_seen_id(
    df: DataFrame, value: str, order: Sequence[str], name: str
) -> DataFrame:
    """(name, value): distinct non-null values numbered by their first row in ``order``.

    The first occurrence is found with a partial aggregate, so only one row per value and map task
    is shuffled, however often a value occurs.
    """
    first = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.min(F.struct(*order)).alias("__first"))
    )
    return dense_id(first, ["__first"], name, [value])
