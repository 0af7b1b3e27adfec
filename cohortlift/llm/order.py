"""A global order of rows without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: monotonically_increasing_id holds the partition above these bits, the row's place in it below.
SLICE_BITS = 33


def ordered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` written in order of ``keys`` (nulls first), with ``at``: a long that ascends with the order.

    One range shuffle. A row's place in its input is the last key, so rows
    that are equal in all keys (any of which may be taken for another) are
    spread over ranges too. ``rows`` must come from a scan or a written
    table, whose places do not change when a task runs again.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    columns = [*keys, "_tie"]
    placed = tied.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return written(placed.drop("_tie").withColumn("at", F.monotonically_increasing_id()), name)


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``ordered`` rows with ``rank``, from 0 without gaps, instead of ``at``.

    The rows before each slice of the order are broadcast: one row for each
    shuffle partition, whatever the input's size.
    """
    placed = ordered(rows, keys, name).withColumn("slice", F.shiftright("at", SLICE_BITS))
    counts = placed.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = counts.select("slice", before.alias("before"))
    rank = F.col("before") + F.col("at") - F.shiftleft("slice", SLICE_BITS)
    return placed.join(F.broadcast(slices), "slice").withColumn("rank", rank).drop("slice", "before", "at")
