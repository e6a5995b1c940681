"""Calendar and star-schema fact loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .rows import dedup, insert_absent, unseen
from .scd import asof_join, asof_joins


def calendar(*dates: tuple[DataFrame, str]) -> DataFrame:
    """One row per distinct day found in the given date columns."""
    days = reduce(lambda a, b: a.unionByName(b),
                  [df.select(F.to_date(col).alias("full_date")).distinct() for df, col in dates])
    day = F.col("full_date")
    weekday = fn.iso_weekday(day)
    return days.filter(day.isNotNull()).distinct().select(
        fn.date_id(day).alias("date_id"), day, F.year(day).alias("year"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"), F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"), (weekday >= 6).alias("is_weekend"))


def extend_calendar(dim_date: DataFrame, *dates: tuple[DataFrame, str]) -> DataFrame:
    """Calendar rows for new days added to an existing calendar."""
    return insert_absent(dim_date, calendar(*dates), ["date_id"])


def with_date_id(df: DataFrame, ts: str, dim_date: DataFrame | None = None) -> DataFrame:
    """Adds ``date_id``: the calendar's key of the day, or the computed one where it has none.

    The calendar holds one row per day, at most some 3.65 million for all years 1 to 9999, so
    it is broadcast: a busy day never gathers in one task.
    """
    computed = fn.date_id(F.col(ts))
    if dim_date is None:
        return df.withColumn("date_id", computed)
    days = dim_date.select(F.col("full_date").alias("__day"), F.col("date_id").alias("__date_id"))
    joined = df.join(F.broadcast(days), F.to_date(ts) == F.col("__day"), "left")
    return joined.withColumn("date_id", F.coalesce("__date_id", computed)).drop("__day", "__date_id")


def _staged(stg: DataFrame, key: str, ts: str, existing: DataFrame | None, unique: bool) -> DataFrame:
    """One row per key, dates to the second, keys loaded before left out."""
    once = stg if unique else dedup(stg, [key], [c for c in stg.columns if c != key])
    timed = once.withColumn(ts, fn.to_second(F.col(ts)))
    return timed if existing is None else unseen(timed, existing, [key])


def fact_sales(stg: DataFrame, dim_product: DataFrame, dim_date: DataFrame | None = None,
               existing: DataFrame | None = None, as_of: bool = True, unique: bool = False, **spread) -> DataFrame:
    """New sales facts. Rows without a product version at their time are left out.

    ``unique`` says that ``stg`` holds one row per transaction already (silver does).
    """
    sales = _staged(stg, "transaction_id", "timestamp", existing, unique)
    sales = asof_join(sales, dim_product, "product_id", "timestamp", ["product_sk"], as_of=as_of, **spread)
    return with_date_id(sales, "timestamp", dim_date).select(
        "transaction_id", "date_id", "store_id", "product_sk", F.lit(1).cast("bigint").alias("customer_sk"),
        "quantity", "sale_amount")


def fact_orders(stg: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
                dim_date: DataFrame | None = None, existing: DataFrame | None = None,
                as_of: bool = True, unique: bool = False, **spread) -> DataFrame:
    """New order facts. Unmatched products drop the row, unmatched customers map to member 1."""
    orders = _staged(stg, "order_id", "order_date", existing, unique)
    orders = asof_joins(orders, [
        (dim_product, "product_id", "order_date", ["product_sk"], "inner", as_of),
        (dim_customer, "customer_id", "order_date", ["customer_sk"], "left", as_of)], **spread)
    return with_date_id(orders, "order_date", dim_date).select(
        "order_id", "date_id", F.coalesce("customer_sk", F.lit(1)).cast("bigint").alias("customer_sk"),
        "product_sk", "quantity", "unit_price", (F.col("quantity") * F.col("unit_price")).alias("total_amount"),
        "region")
