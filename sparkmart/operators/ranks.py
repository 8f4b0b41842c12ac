"""Exact ranks over a whole table, without a window that holds it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import materialise, workspace


def with_row_number(df: DataFrame, order: Sequence[Column], into: str, total: str) -> DataFrame:
    """Add the place of each row in ``order``, from 1, and the number of all rows.

    The rows are split into ranges and sorted within; a row's place is the one in its range plus
    the rows of the ranges before. ``order`` should leave no ties, else any order among them
    counts. The sorted rows are written once, so that ranges and their sizes agree.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts the rows of each range, the range's number being above the low 33 bits.
    placed = sorted_.withColumn("_place", F.monotonically_increasing_id())
    placed = materialise(placed, workspace(df.sparkSession, "ranks"))
    number = F.shiftright("_place", 33)
    sizes = placed.groupBy(number.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, as many as there are shuffle partitions.
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias(total),
    )
    place = F.col("_place").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1
    joined = placed.withColumn("_range", number).join(F.broadcast(starts), "_range")
    return joined.select(*[f"`{c}`" for c in df.columns], place.alias(into), total)


def tile(place: Column, total: Column, tiles: int) -> Column:
    """The tile of a place, as ``ntile`` has it: the first ones take one row more."""
    size, more = F.floor(total / tiles), total % tiles
    large = more * (size + 1)
    return (
        F.when(place <= large, F.ceil(place / (size + 1)))
        .otherwise(more + F.ceil((place - large) / F.nullif(size, F.lit(0))))
        .cast("int")
    )
