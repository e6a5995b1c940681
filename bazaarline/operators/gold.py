"""Silver to gold metrics and the dashboard figures on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .rows import pct_change

NO_SALES_DIO = 999.0


def customer_revenue(erp: DataFrame) -> DataFrame:
    """Revenue, orders and average order value per known customer."""
    revenue = F.col("quantity") * F.col("unit_price")
    return with_order_value(erp.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.coalesce(F.sum(revenue), F.lit(0)).alias("total_revenue"),
        F.count("order_id").alias("total_orders")))


def with_order_value(per: DataFrame) -> DataFrame:
    """Average order value beside the sums of each customer."""
    total = F.col("total_revenue").cast("double")
    aov = F.when(F.col("total_orders") > 0, total / F.col("total_orders")).otherwise(
        F.when(total != 0, F.signum(total) * F.lit(float("inf"))).otherwise(F.lit(0.0)))
    return per.withColumn("average_order_value", aov)


def customer_metrics(erp: DataFrame, crm: DataFrame) -> DataFrame:
    """Every customer with revenue figures, 0 where there is none."""
    return customer_figures(crm, customer_revenue(erp))


def customer_figures(crm: DataFrame, revenue: DataFrame) -> DataFrame:
    return fn.fill_all_zero(crm.join(revenue, "customer_id", "left"))


def sales_metrics(pos: DataFrame) -> DataFrame:
    """Revenue and transactions per day, with the change to the day before in percent."""
    daily = pos.filter(F.col("timestamp").isNotNull()).groupBy(F.to_date("timestamp").alias("date")).agg(
        F.coalesce(F.sum("sale_amount"), F.lit(0)).alias("daily_revenue"),
        F.count("transaction_id").alias("daily_transactions"))
    return with_growth(daily)


def with_growth(daily: DataFrame) -> DataFrame:
    return pct_change(daily, "date", "daily_revenue", "revenue_growth_pct")


def units_sold(pos: DataFrame) -> DataFrame:
    """Units per store and product (pairs with a missing part left out)."""
    return pos.dropna(subset=["store_id", "product_id"]).groupBy("store_id", "product_id").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_qty_sold"))


def active_days(pos: DataFrame) -> DataFrame:
    """Completed 24-hour periods between first and last sale, at least 1, as one row."""
    return days_between(pos.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")))


def days_between(span: DataFrame) -> DataFrame:
    """Completed 24-hour periods from ``a`` to ``b`` of a one-row frame, at least 1."""
    days = fn.whole_days(F.col("a"), F.col("b")).cast("int")
    return span.select(F.greatest(F.lit(1), F.coalesce(days, F.lit(1))).alias("active_days"))


def inventory_metrics(inv: DataFrame, pos: DataFrame) -> DataFrame:
    """Turnover, velocity, days of inventory and low-stock flag per stocked product."""
    return stock_figures(inv, units_sold(pos), active_days(pos))


def stock_figures(inv: DataFrame, units: DataFrame, active: DataFrame) -> DataFrame:
    """The same from units sold per store and product and the one-row frame of active days."""
    merged = fn.fill_all_zero(inv.join(units, ["store_id", "product_id"], "left"))
    days: Column = active.scalar().cast("double")
    sold, stock = F.col("total_qty_sold").cast("double"), F.col("stock_level").cast("double")
    return merged.select(
        "store_id", "product_id", "stock_level", "reorder_point",
        F.when(stock > 0, sold / stock).otherwise(F.lit(0.0)).alias("stock_turnover"),
        (sold / days).alias("inventory_velocity"),
        F.when(sold > 0, stock / sold * days).otherwise(F.lit(NO_SALES_DIO)).alias("days_inventory_outstanding"),
        (F.col("stock_level") <= F.col("reorder_point")).alias("low_stock_alert"))


# -- dashboard figures -----------------------------------------------------------------

def last_days(sales: DataFrame, days: int = 30) -> DataFrame:
    """Newest ``days`` rows of the daily series."""
    return sales.orderBy(F.col("date").desc()).limit(days)


def kpi_sales(sales: DataFrame, days: int = 30) -> DataFrame:
    """Totals, mean growth and revenue per day over the newest ``days`` rows."""
    return last_days(sales, days).agg(
        F.sum("daily_revenue").alias("total_revenue"), F.sum("daily_transactions").alias("total_transactions"),
        F.avg("revenue_growth_pct").alias("avg_growth_pct"),
        (F.sum("daily_revenue").cast("double") / F.lit(float(days))).alias("avg_daily_revenue"))


def first_customers(customers: DataFrame, rows: int | None = None) -> DataFrame:
    """All customers, or a page of the first ``rows`` by id."""
    return customers if rows is None else customers.orderBy("customer_id").limit(rows)


def kpi_customers(customers: DataFrame, rows: int | None = None) -> DataFrame:
    """Mean revenue, mean order value and number of customers: of all, or of a page."""
    return first_customers(customers, rows).agg(
        F.avg(F.col("total_revenue").cast("double")).alias("avg_ltv"),
        F.avg("average_order_value").alias("avg_aov"), F.count(F.lit(1)).alias("total_customers"))


def segment_counts(customers: DataFrame, rows: int | None = None) -> DataFrame:
    return first_customers(customers, rows).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


def kpi_inventory(inv: DataFrame) -> DataFrame:
    """Mean turnover and velocity, mean days of inventory of sold items, number of alerts."""
    dio = F.col("days_inventory_outstanding")
    return inv.agg(
        F.avg("stock_turnover").alias("avg_turnover"), F.avg("inventory_velocity").alias("avg_velocity"),
        F.coalesce(F.avg(F.when(dio < NO_SALES_DIO, dio)), F.lit(0.0)).alias("avg_dio"),
        F.count_if("low_stock_alert").alias("low_stock_count"))


def stock_by_category(inv: DataFrame) -> DataFrame:
    return inv.filter(F.col("category").isNotNull()).groupBy("category").agg(
        F.sum("stock_level").alias("stock_level"))


def picker_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a filter list."""
    return df.select(column).dropna().distinct().orderBy(column)
