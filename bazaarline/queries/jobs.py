"""Whole jobs and streams over the given tables; each works in a lake of its own in the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..ledger import Ledger
from ..operators.clean import write_silver
from ..operators.quality import NotNull, Unique, run_suite
from ..plans import reports
from ..plans.gold_deltas import refresh_gold
from ..plans.medallion import run_medallion
from ..schemas import layout
from ..session import discard, materialise, shared_dir
from ..sources.files import export_csv, read_source, write_quality_report
from ..sources.incremental import load_incremental, write_bronze
from ..sources.lake import Lake
from ..streaming import stream_bronze, stream_warehouse
from .quality_checks import nulls, union, unique
from .registry import query

LOAD_TS = "2001-12-31 00:00:00"


def _new_lake(feeds) -> Lake:
    return Lake(feeds.spark, os.path.join(shared_dir(feeds.spark), "bazaarline", f"lake-{uuid.uuid4().hex}"))


def _with_position(df, *order):
    return df.withColumn("_pos", F.struct(*order))


@query("job01_medallion_run", """
select customer_id, customer_name, segment, cast(total_spent as double) as total_spent from (
  select coalesce(c.customer_id, 99999) as customer_id,
         case when c.customer_id is null then 'Walk-in Customer' else c.customer_name end as customer_name,
         case when c.customer_id is null then 'Retail' else c.segment end as segment,
         sum(s.quantity*s.unit_price) as total_spent
  from o_erp s join products p on s.product_id=p.product_id
       left join crm_first c on s.customer_id=c.customer_id
  where s.order_date>=TS('2000-01-01 00:00:00') group by 1, 2, 3
  order by total_spent desc, customer_id, segment limit 10)""")
def medallion(feeds):
    """Bronze to report in one run; dimension versions start in 2000, older orders have none."""
    lake = _new_lake(feeds)
    erp = _with_position(feeds.view("erp"), *feeds.ERP_ORDER).drop("ord1", "ord2", "ord3")
    inventory = _with_position(feeds.view("inventory"), *feeds.INV_ORDER).drop("ord1")
    pos = _with_position(feeds.view("pos"), *feeds.POS_ORDER)
    crm = feeds.view("crm_first")
    run_medallion(feeds.spark, lake, {"crm_customers": crm, "products": feeds.view("products"), "erp_orders": erp,
                                      "pos_transactions": pos, "inventory": inventory},
                  "20011231-job", LOAD_TS, feeds.view("stores"), short_quality=True)
    out = reports.report(lake, "top_customers")
    return out.withColumn("total_spent", F.col("total_spent").cast("double"))


@query("str01_stream_bronze", "select event_id, ts, user_id, event_type, value from events")
def bronze_stream(feeds):
    lake = _new_lake(feeds)
    stream_bronze(feeds.spark, f"{feeds.folder}/events*.parquet", lake, "events", lake.scratch("checkpoint"),
                  schema=feeds.table("events").schema, file_format="parquet").awaitTermination()
    return lake.read("bronze", "events").select("event_id", "ts", "user_id", "event_type", "value")


@query("str02_stream_facts", """
select s.transaction_id, cast(strftime(s.timestamp,'%Y%m%d') as int) as date_id, s.store_id, s.product_id, s.quantity
from o_pos s join products p on s.product_id=p.product_id where s.timestamp>=TS('2000-01-01 00:00:00')""")
def fact_stream(feeds):
    """Products, then sales, through the streams; the facts with their business key."""
    spark, lake = feeds.spark, _new_lake(feeds)
    write_bronze(feeds.view("products"), lake, "products", "stream-0")
    write_bronze(_with_position(feeds.view("pos"), *feeds.POS_ORDER), lake, "pos_transactions", "stream-0")
    for source in ("products", "pos_transactions"):
        stream_warehouse(spark, lake, source, lake.scratch("checkpoint"), LOAD_TS).awaitTermination()
    facts = lake.facts("fact_sales", layout("fact_sales"))
    product = lake.snapshot("dim_product", layout("dim_product")).select("product_sk", "product_id")
    return facts.join(product, "product_sk").select("transaction_id", "date_id", "store_id", "product_id", "quantity")


@query("str02_stream_orders", """
select s.order_id, cast(strftime(s.order_date,'%Y%m%d') as int) as date_id, coalesce(c.customer_id, 99999) as customer_id,
       s.product_id, s.quantity, s.region
from o_erp s join products p on s.product_id=p.product_id left join crm_first c on s.customer_id=c.customer_id
where s.order_date>=TS('2000-01-01 00:00:00')""")
def order_stream(feeds):
    """Products and customers, then orders, through the streams; the facts with their business keys."""
    spark, lake = feeds.spark, _new_lake(feeds)
    write_bronze(feeds.view("products"), lake, "products", "stream-0")
    write_bronze(feeds.view("crm_first"), lake, "crm_customers", "stream-0")
    write_bronze(_with_position(feeds.view("erp"), *feeds.ERP_ORDER).drop("ord1", "ord2", "ord3"), lake, "erp_orders", "stream-0")
    for source in ("products", "crm_customers", "erp_orders"):
        stream_warehouse(spark, lake, source, lake.scratch("checkpoint"), LOAD_TS).awaitTermination()
    facts = lake.facts("fact_orders", layout("fact_orders"))
    product = lake.snapshot("dim_product", layout("dim_product")).select("product_sk", "product_id")
    customer = lake.snapshot("dim_customer", layout("dim_customer")).select("customer_sk", "customer_id")
    return facts.join(product, "product_sk").join(customer, "customer_sk").select(
        "order_id", "date_id", "customer_id", "product_id", "quantity", "region")


@query("src01_csv_scan", """
select transaction_id, store_id, product_id, quantity, timestamp, cast(sale_amount as double) as sale_amount from pos""")
def csv_scan(feeds):
    """The sales feed exported as CSV and read back with the types of its layout."""
    path = _new_lake(feeds).path("export", "pos_transactions")
    export_csv(feeds.view("pos"), path)
    return read_source(feeds.spark, path, layout("pos_transactions"), typed=True).drop("_corrupt_record")


@query("src04_bronze_runs", """
select case when timestamp>TS('1998-06-30 00:00:00') then 'run-2' else 'run-1' end as run_id, count(*) as rows,
       max(timestamp) as newest from pos group by 1""")
def bronze_runs(feeds):
    """Two incremental runs over the sales feed; the second starts at the mark of the first."""
    lake, pos = _new_lake(feeds), feeds.view("pos")
    first, mark = load_incremental(pos.filter("timestamp <= timestamp_ntz'1998-06-30'"), "timestamp")
    _, newest = write_bronze(first, lake, "pos_transactions", "run-1", "timestamp")
    write_bronze(load_incremental(pos, "timestamp", newest)[0], lake, "pos_transactions", "run-2", "timestamp")
    return lake.read("bronze", "pos_transactions").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("newest"))


@query("src06_silver_layer", "select * from o_inv")
def silver_layer(feeds):
    lake = _new_lake(feeds)
    lake.write(feeds.inventory(), "silver", "inventory")
    return lake.read("silver", "inventory")


@query("src14_quality_report", union(nulls("erp", "erp_raw", "region"), unique("erp", "erp_raw", "order_id", "order_id")))
def quality_report(feeds):
    path = _new_lake(feeds).path("reports", "quality")
    write_quality_report(run_suite(feeds.view("erp_raw"), "erp", [NotNull("region"), Unique(("order_id",))]), path)
    return feeds.spark.read.json(path).select("dataset", "expectation", "passed", "details")


@query("log02_quality_log", union(nulls("erp", "erp_raw", "region"), unique("erp", "erp_raw", "order_id", "order_id")))
def quality_log(feeds):
    ledger = Ledger(_new_lake(feeds))
    ledger.log_quality("run", run_suite(feeds.view("erp_raw"), "erp", [NotNull("region"), Unique(("order_id",))]))
    return ledger.table("data_quality_results").select(
        F.col("dataset_name").alias("dataset"), "expectation", "passed", "details")


def _gold_in_two_runs(feeds, name: str):
    """A first run with other figures for three keys of ten and without three more, a second with the right ones: by deltas."""
    lake = _new_lake(feeds)
    changed = {"erp_orders": ("order_id", "quantity", feeds.erp()), "pos_transactions": ("transaction_id", "sale_amount", feeds.pos()),
               "crm_customers": ("customer_id", "segment", feeds.view("crm")), "inventory": ("product_id", "stock_level", feeds.inventory())}
    pos_days = {"pos_transactions": {"timestamp": F.expr("timestamp - interval 400 days"), "quantity": F.expr("quantity + 5")}}
    # both runs deliver from one copy of the cleaned rows: they are joined and deduplicated once
    changed = {source: (key, figure, materialise(rows, "delivered")) for source, (key, figure, rows) in changed.items()}
    for source, (key, figure, rows) in changed.items():
        part = F.pmod(F.hash(key), F.lit(10))
        wrong = {figure: F.lit("none") if figure == "segment" else F.col(figure) + 7, **pos_days.get(source, {})}
        first = rows.where(part < 7).withColumns({c: F.when(part < 3, v).otherwise(F.col(c)) for c, v in wrong.items()})
        write_silver(lake, first, source, "run-1")
    refresh_gold(lake, ["run-1"])
    for source, (key, _, rows) in changed.items():
        part = F.pmod(F.hash(key), F.lit(10))
        write_silver(lake, rows.where((part < 3) | (part >= 7)), source, "run-2")
        discard(rows)
    refresh_gold(lake, ["run-2"])
    return lake.read("gold", name)


@query("agg01_customer_metrics_deltas", """
select customer_id, customer_name, segment, acquisition_channel, signup_date, cast(total_revenue as double) as total_revenue,
       total_orders, average_order_value from o_customer_metrics""")
def customer_metrics_deltas(feeds):
    return _gold_in_two_runs(feeds, "customer_metrics").withColumns({  # silver keeps dates as instants
        "total_revenue": F.col("total_revenue").cast("double"), "signup_date": F.col("signup_date").cast("date")})


@query("agg02_sales_metrics_deltas", """
select date, cast(daily_revenue as double) as daily_revenue, daily_transactions,
       round(revenue_growth_pct, 6) as revenue_growth_pct from o_sales_metrics""")
def sales_metrics_deltas(feeds):
    return _gold_in_two_runs(feeds, "sales_metrics").withColumns({
        "daily_revenue": F.col("daily_revenue").cast("double"), "revenue_growth_pct": F.round("revenue_growth_pct", 6)})


@query("agg05_inventory_metrics_deltas", """
select store_id, product_id, stock_level, reorder_point, stock_turnover, inventory_velocity,
       days_inventory_outstanding, low_stock_alert from o_inventory_metrics""")
def inventory_metrics_deltas(feeds):
    return _gold_in_two_runs(feeds, "inventory_metrics")
