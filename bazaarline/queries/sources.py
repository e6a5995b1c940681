"""Scan, SQL and extraction queries, and set and sort operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..ledger import lineage_latest, lineage_recent, run_states
from ..operators import gold, onboard
from ..operators.rows import distinct_union, latest, schema_diff, tagged_union
from ..sources.html import extract_links, extract_listings
from ..sources.incremental import load_incremental
from ..sources.tables import run_sql
from .registry import query

MARK = datetime(2024, 1, 15, 12, 0, 0)


@query("src02_incremental_rows", """
select event_id, ts, user_id, event_type, value from events where ts > timestamp '2024-01-15 12:00:00'""")
def incremental_rows(feeds):
    fresh, _ = load_incremental(feeds.table("events"), "ts", MARK)
    return fresh.select("event_id", "ts", "user_id", "event_type", "value")


@query("src02_new_watermark", """
select coalesce(max(ts), timestamp '2024-01-15 12:00:00') as watermark from events
where ts > timestamp '2024-01-15 12:00:00'""")
def new_watermark(feeds):
    return load_incremental(feeds.table("events"), "ts", MARK)[1]


@query("src12_sql_text", """
select r_name as region, count(*) as customers, cast(sum(cast(c_acctbal as decimal(12,2))) as decimal(22,2)) as balance
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey group by r_name""")
def sql_text(feeds):
    return run_sql(
        feeds.spark,
        "select r_name as region, count(*) as customers, sum(cast(c_acctbal as decimal(12,2))) as balance "
        "from {customer} join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey "
        "group by r_name",
        customer=feeds.table("customer"), nation=feeds.table("nation"), region=feeds.table("region"))


@query("src17_page_links", """
select page_id, cast(pos-1 as int) as element, href from (
  select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href,
         generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), 1) as pos from pages)""")
def page_links(feeds):
    return extract_links(feeds.table("pages"))


@query("src17_listings", r"""
select page_id, cast(pos-1 as int) as element,
       replace(replace(replace(replace(replace(trim(regexp_replace(m, '<[^>]*>', '', 'g')), '&lt;', '<'), '&gt;', '>'),
               '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&') as label
from (select page_id, unnest(regexp_extract_all(html, '<li><a [^>]*>(.*?)</a>', 1)) as m,
             generate_subscripts(regexp_extract_all(html, '<li><a [^>]*>(.*?)</a>', 1), 1) as pos from pages)""")
def listings(feeds):
    return extract_listings(feeds.table("pages"), container="li", fields={"label": "a"})


@query("win04_latest_per_entity", """
select user_id, event_id, ts, event_type from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn=1""")
def latest_event(feeds):
    return latest(feeds.table("events"), ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type")


@query("srt01_last_30_days", "select * from o_sales_metrics order by date desc limit 30")
def last_30(feeds):
    return gold.last_days(feeds.sales_metrics(), 30)


@query("srt02_first_1000_customers", """
select customer_id, total_revenue, total_orders from o_customer_metrics order by customer_id limit 1000""")
def first_1000(feeds):
    return gold.first_customers(feeds.customer_metrics(), 1000).select(
        "customer_id", "total_revenue", "total_orders")


@query("srt03_top_products", """
select product_id, cast(sum(quantity) as bigint) as units from o_pos group by product_id
order by units desc, product_id limit 10""")
def top_products(feeds):
    return feeds.pos().groupBy("product_id").agg(F.sum("quantity").alias("units")).orderBy(
        F.col("units").desc(), "product_id").limit(10)


@query("srt04_recent_lineage", """
select run_id, source_dataset, bronze_path, silver_path, gold_path, load_timestamp from lineage_log
order by load_timestamp desc, run_id, source_dataset limit 10""")
def recent_lineage(feeds):
    return lineage_recent(feeds.view("lineage_log"))


@query("log03_lineage_of_dataset", """
select run_id, source_dataset, source_file_name, bronze_path, silver_path, gold_path, load_timestamp from lineage_log
where source_file_name='purchase' or source_dataset='purchase' order by load_timestamp desc limit 1""")
def lineage_of(feeds):
    return lineage_latest(feeds.view("lineage_log"), "purchase")


@query("log01_run_states", """
select run_id, min(event_time) as start_time,
       max(case when pipeline_status in ('SUCCESS','FAILED') then event_time end) as end_time,
       cast(sum(rows_processed) as bigint) as rows_processed, cast(sum(rows_loaded) as bigint) as rows_loaded,
       cast(sum(rows_failed) as bigint) as rows_failed,
       arg_max(pipeline_status, event_time) filter (where pipeline_status is not null) as pipeline_status,
       (array_agg(error_message order by event_time desc) filter (where pipeline_status in ('SUCCESS','FAILED')))[1]
         as error_message
from run_events group by run_id""")
def states(feeds):
    return run_states(feeds.view("run_events"))


@query("srt06_picker_values", "select distinct category from products where category is not null order by 1")
def pickers(feeds):
    return gold.picker_values(feeds.view("products"), "category")


@query("set01_tagged_union", """
select 'pos' as table_name, transaction_id as dup_id, count(*) as occurrences from pos group by 2 having count(*)>1
union all
select 'erp', order_id, count(*) from erp group by 2 having count(*)>1""")
def tagged(feeds):
    from ..operators.rows import duplicate_keys

    return tagged_union({
        "pos": duplicate_keys(feeds.view("pos").select(F.col("transaction_id").alias("dup_id")), ["dup_id"]),
        "erp": duplicate_keys(feeds.view("erp").select(F.col("order_id").alias("dup_id")), ["dup_id"]),
    })


EDGES = "(values ('ERP','CRM'),('ERP','Products'),('POS','Products'),('Inventory','Products')) e(type, required)"


@query("set02_missing_types", f"""
select distinct u.tenant, u.type, e.required from typed_uploads u join {EDGES} on u.type=e.type
where not exists (select 1 from typed_uploads a where a.tenant=u.tenant and a.type=e.required)""")
def missing_types(feeds):
    uploads = feeds.view("typed_uploads")
    return onboard.missing_dependencies(uploads, uploads.limit(0), by=["tenant"]).drop("impact")


@query("set03_schema_diff", """
with ranked as (select dataset, position, column_name from uploads),
o as (select dataset, list(distinct column_name) as cols from ranked where position<=4 group by 1),
n as (select dataset, list(distinct column_name) as cols from ranked where position>=3 group by 1)
select n.dataset,
  array_to_string(list_sort(list_filter(n.cols, lambda x: not list_contains(o.cols, x))), ',') as added,
  array_to_string(list_sort(list_filter(o.cols, lambda x: not list_contains(n.cols, x))), ',') as removed
from n join o on n.dataset=o.dataset""")
def diff(feeds):
    uploads = feeds.view("uploads")
    sets = uploads.groupBy("dataset").agg(
        F.collect_set(F.when(F.col("position") <= 4, F.col("column_name"))).alias("old"),
        F.collect_set(F.when(F.col("position") >= 3, F.col("column_name"))).alias("new"))
    both = sets.filter((F.size("old") > 0) & (F.size("new") > 0))
    return schema_diff(both, "old", "new").select(
        "dataset", F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed"))


@query("set04_names_with_priority", """
select name, min(priority) as priority from (
  select product_name as name, 0 as priority from products union all select category, 1 from products) group by 1""")
def names(feeds):
    products = feeds.view("products")
    return distinct_union(products.select(F.col("product_name").alias("name")),
                          products.select(F.col("category").alias("name")), "name")
