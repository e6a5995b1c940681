"""Report queries over the star schema and the gold tables.

Facts are summed per key before they meet a dimension, so a join sees one row per key and a
busy key costs no more than a quiet one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..ledger import Ledger
from ..operators.audit import duplicate_facts
from ..operators.rows import current_lookup, orphan_count, with_current
from ..operators.skew import Lookup, spread_joins
from ..sources.lake import Lake


def top_customers(fact_orders: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    """Customers by total spend; ties by id and segment."""
    per_sk = fact_orders.groupBy("customer_sk").agg(F.sum("total_amount").alias("amount"))
    named = per_sk.join(dim_customer.select("customer_sk", "customer_id", "customer_name", "segment"), "customer_sk")
    spent = named.groupBy("customer_id", "customer_name", "segment").agg(F.sum("amount").alias("total_spent"))
    return spent.orderBy(F.col("total_spent").desc(), "customer_id", "segment").limit(n)


def revenue_by_month(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact_sales.groupBy("date_id").agg(F.sum("sale_amount").alias("amount"))
    return per_day.join(dim_date.select("date_id", "year", "month"), "date_id").groupBy("year", "month").agg(
        F.sum("amount").alias("sales_revenue")).orderBy("year", "month")


def revenue_by_region(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("region").agg(F.sum("total_amount").alias("total_revenue")).orderBy(
        F.col("total_revenue").desc(), "region")


def turnover_by_category(inventory: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Mean turnover and days of inventory (the no-sales value included) per current category."""
    per = inventory.groupBy("product_id").agg(
        F.sum("stock_turnover").alias("t"), F.count("stock_turnover").alias("tn"),
        F.sum("days_inventory_outstanding").alias("d"), F.count("days_inventory_outstanding").alias("dn"))
    return with_current(per, dim_product, ["product_id"], ["category"]).groupBy("category").agg(
        (F.sum("t") / F.sum("tn")).alias("avg_turnover_rate"), (F.sum("d") / F.sum("dn")).alias("avg_dio")) \
        .orderBy(F.col("avg_turnover_rate").desc(), "category")


def segment_analytics(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segment").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("total_revenue").alias("total_spend")).orderBy(F.col("total_spend").desc(), "segment")


def version_history(dim_customer: DataFrame, ids: Sequence[int]) -> DataFrame:
    return dim_customer.filter(F.col("customer_id").isin(list(ids))).select(
        "customer_id", "customer_name", "segment", "effective_date", "end_date", "is_current").orderBy(
        "customer_id", "effective_date")


def orphan_report(fact_sales: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
                  dim_customer: DataFrame) -> DataFrame:
    """Three orphan counts as one row; rows without a key count as orphans here."""
    sales = orphan_count(fact_sales, dim_product, "product_sk", "product_sk", True, "orphan_sales_products")
    stores = orphan_count(fact_sales, dim_store, "store_id", "store_id", True)
    customers = orphan_count(fact_orders, dim_customer, "customer_sk", "customer_sk", True)
    return sales.select("orphan_sales_products", stores.scalar().alias("orphan_sales_stores"),
                        customers.scalar().alias("orphan_orders_customers"))


def inventory_board(inventory: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Inventory metrics with the names of store and current product."""
    stores = dim_store.select("store_id", "store_name", "region")
    wide = spread_joins(inventory, [Lookup(stores, ["store_id"]),
                                    current_lookup(dim_product, ["product_id"], ["product_name", "category"])])
    return wide.select("store_id", "store_name", "region", "product_id", "product_name", "category", "stock_level",
                       "reorder_point", "stock_turnover", "inventory_velocity", "days_inventory_outstanding",
                       "low_stock_alert")


def low_stock(board: DataFrame) -> DataFrame:
    return board.filter("low_stock_alert").select(
        "store_name", "product_name", "category", "stock_level", "reorder_point")


def point_in_time(fact_orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                  dim_date: DataFrame) -> DataFrame:
    """Every order with the customer segment and product of its time."""
    out = spread_joins(fact_orders, [
        Lookup(dim_customer.select("customer_sk", "customer_id", "segment", "effective_date", "end_date"), ["customer_sk"]),
        Lookup(dim_product.select("product_sk", "product_name"), ["product_sk"])])
    out = out.join(F.broadcast(dim_date.select("date_id", "full_date")), "date_id")  # one row per day
    return out.select("order_id", F.col("full_date").alias("order_date"), "customer_id", "segment", "effective_date",
                      "end_date", "product_name")


def report(lake: Lake, name: str, customer_ids: Sequence[int] = (10001, 10002, 10003)) -> DataFrame:
    """A named report over the stored tables of a lake; ``customer_ids`` are for the version history."""
    def snap(table: str) -> DataFrame:
        return lake.snapshot(table, schemas.layout(table))

    def fact(table: str) -> DataFrame:
        return lake.facts(table, schemas.layout(table))

    def metrics(table: str) -> DataFrame:
        return lake.read("gold", table)

    known: dict[str, Callable[[], DataFrame]] = {
        "top_customers": lambda: top_customers(fact("fact_orders"), snap("dim_customer")),
        "revenue_by_month": lambda: revenue_by_month(fact("fact_sales"), snap("dim_date")),
        "revenue_by_region": lambda: revenue_by_region(fact("fact_orders")),
        "turnover_by_category": lambda: turnover_by_category(metrics("inventory_metrics"), snap("dim_product")),
        "segment_analytics": lambda: segment_analytics(metrics("customer_metrics")),
        "version_history": lambda: version_history(snap("dim_customer"), customer_ids),
        "recent_lineage": lambda: Ledger(lake).lineage_recent(10),
        "orphans": lambda: orphan_report(fact("fact_sales"), fact("fact_orders"), snap("dim_product"),
                                         snap("dim_store"), snap("dim_customer")),
        "duplicate_facts": lambda: duplicate_facts(fact("fact_sales"), fact("fact_orders")),
        "inventory_board": lambda: inventory_board(metrics("inventory_metrics"), snap("dim_store"),
                                                   snap("dim_product")),
        "low_stock": lambda: low_stock(report(lake, "inventory_board")),
    }
    return known[name]()
