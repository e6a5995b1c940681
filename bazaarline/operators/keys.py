"""Surrogate keys without a global sort or a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import stored

BUCKET_ROWS = 100_000   # rows that one task numbers


def assign_sk(df: DataFrame, sk: str, key: Sequence[str], start: Column | int = 0,
              buckets: int | None = None) -> DataFrame:
    """Gap-free surrogate keys ``start+1 ..`` for rows with a unique ``key``.

    Rows are numbered inside hash buckets and shifted by the sizes of the buckets before, so
    the work spreads over as many tasks as there are buckets, one for each ``BUCKET_ROWS`` rows,
    and a retried task gives the same keys again. The offsets come from one row per bucket.
    ``df`` is stored first where it is more than a stored table, since it is read three times.
    """
    start = F.lit(start) if isinstance(start, int) else start
    df = stored(df, "unnumbered")
    buckets = buckets or max(1, -(-df.count() // BUCKET_ROWS))
    bucketed = df.withColumn("__b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).select(
        "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__b").orderBy(*key)
    numbered = bucketed.withColumn("__rn", F.row_number().over(within))
    return numbered.join(F.broadcast(offsets), "__b").withColumn(
        sk, (F.coalesce(start, F.lit(0)) + F.col("__off") + F.col("__rn")).cast("bigint")
    ).drop("__b", "__off", "__rn")
