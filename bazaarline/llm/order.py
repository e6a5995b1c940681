"""Global row numbers without a single-task sort or window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def numbered(rows: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """``rows`` with their place, from 0, in the given order.

    Rows are dealt over ranges of the order and sorted there; the result is written once, so
    that the place inside a range and the size of a range come from the same run. Offsets are
    sums over one row per range. ``rows`` should be narrow: keys, not texts.
    """
    inside = F.monotonically_increasing_id()  # partition in the upper bits, place in the lower 33
    local = materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__range", F.spark_partition_id()).withColumn("__place", inside.bitwiseAND(F.lit((1 << 33) - 1))),
        "row-numbers")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = local.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")) \
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return local.join(F.broadcast(offsets), "__range") \
        .withColumn(name, F.col("__base") + F.col("__place")).drop("__range", "__place", "__base")
