"""Versioned dimensions, joins to them, fact loads and audits."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import audit, facts, rows, scd
from ..operators.asof import asof_merge
from ..operators.keys import assign_sk
from ..plans import reports
from ..plans.warehouse import CUSTOMER_COMPARE, PRODUCT_COMPARE, PRICE_TOLERANCE, merge_customers, merge_dimension, merge_products
from ..session import materialise, shared_dir
from ..sources.lake import Lake
from ..sources.members import LoadedKeys
from .registry import query

LOAD_TS = "2001-01-01 00:00:00"


def _empty(feeds, name):
    return feeds.spark.createDataFrame([], schemas.layout(name))


def customers_first(feeds):
    """The customer dimension after the first delivery, stored as a job would."""
    return materialise(merge_customers(_empty(feeds, "dim_customer"), feeds.view("crm_first"), LOAD_TS),
                       "dim_customer")


def products_first(feeds):
    return materialise(merge_products(_empty(feeds, "dim_product"), feeds.view("products_first"), LOAD_TS),
                       "dim_product")


def customers_second(feeds, **options):
    return merge_customers(customers_first(feeds), feeds.view("crm_second"), LOAD_TS, **options)


def products_second(feeds):
    return merge_products(products_first(feeds), feeds.view("products_second"), LOAD_TS)


CUST_COLS = ("customer_id, customer_name, segment, acquisition_channel, signup_date, effective_date, end_date, "
             "is_current")
PROD_COLS = "product_id, product_name, category, unit_price, effective_date, end_date, is_current"


@query("wh01_scd2_customers", f"select {CUST_COLS} from o_cust_second")
def wh01(feeds):
    return customers_second(feeds).drop("customer_sk")


@query("wh02_scd2_products", f"select {PROD_COLS} from o_prod_second")
def wh02(feeds):
    return products_second(feeds).drop("product_sk")


def _in_buckets(feeds, table, *deliveries):
    """The dimension after the deliveries, each merged into the stored buckets it touches."""
    lake = Lake(feeds.spark, os.path.join(shared_dir(feeds.spark), "bazaarline", f"lake-{uuid.uuid4().hex}"))
    for delivery in deliveries:
        merge_dimension(lake, table, feeds.view(delivery), LOAD_TS, bucket_rows=1_000)
    return lake.snapshot(table, schemas.layout(table))


@query("wh01_scd2_customers_buckets", f"select {CUST_COLS} from o_cust_second")
def wh01_buckets(feeds):
    return _in_buckets(feeds, "dim_customer", "crm_first", "crm_second").drop("customer_sk")


@query("wh02_scd2_products_buckets", f"select {PROD_COLS} from o_prod_second")
def wh02_buckets(feeds):
    return _in_buckets(feeds, "dim_product", "products_first", "products_second").drop("product_sk")


@query("wh03_scd2_null_aware", """
select customer_id, customer_name, segment, acquisition_channel, signup_date, effective_date,
       case when customer_id in (select customer_id from o_cust_changed_null) then TS('2001-01-01 00:00:00') else end_date end as end_date,
       is_current and customer_id not in (select customer_id from o_cust_changed_null) as is_current
from o_cust_first
union all
select s.customer_id, s.customer_name, s.segment, s.acquisition_channel, s.signup_date,
       case when exists (select 1 from o_cust_first d where d.customer_id=s.customer_id)
            then TS('2001-01-01 00:00:00') else TS('2000-01-01 00:00:00') end, cast(null as timestamp), true
from crm_second s
where s.customer_id in (select customer_id from o_cust_changed_null)
   or not exists (select 1 from o_cust_first d where d.customer_id=s.customer_id and d.is_current)""")
def wh03(feeds):
    return customers_second(feeds, null_safe=True, history_aware=False).drop("customer_sk")


@query("jn07_not_current_members", """
select s.customer_id from crm_second s
where not exists (select 1 from o_cust_first d where d.customer_id=s.customer_id and d.is_current)""")
def jn07(feeds):
    current = customers_first(feeds).filter("is_current")
    return rows.unseen(feeds.view("crm_second").select("customer_id"), current, ["customer_id"])


@query("jn08_has_history", """
select s.customer_id, exists (select 1 from dim_customer d where d.customer_id=s.customer_id and not d.is_current)
       as has_history from crm s""")
def jn08(feeds):
    closed = feeds.view("dim_customer").filter("not is_current").select(
        "customer_id", F.lit(True).alias("has_history")).distinct()
    return feeds.view("crm").select("customer_id").join(closed, "customer_id", "left").fillna(
        False, subset=["has_history"])


@query("jn09_changed_customers", "select customer_id from o_cust_changed")
def jn09(feeds):
    return scd.changed_keys(customers_first(feeds), feeds.view("crm_second"), "customer_id", CUSTOMER_COMPARE)


@query("jn09_changed_products", "select product_id from o_prod_changed")
def jn09_products(feeds):
    return scd.changed_keys(products_first(feeds), feeds.view("products_second"), "product_id", PRODUCT_COMPARE,
                            tolerance={"unit_price": PRICE_TOLERANCE})


@query("win03_surrogate_keys", """
select count(*) as n, cast(101 as bigint) as lowest, 100+count(*) as highest, count(*) as distinct_keys from crm""")
def win03(feeds):
    keyed = assign_sk(feeds.view("crm"), "customer_sk", ["customer_id"], start=100)
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.min("customer_sk").alias("lowest"),
                     F.max("customer_sk").alias("highest"), F.count_distinct("customer_sk").alias("distinct_keys"))


# -- joins to versioned dimensions ---------------------------------------------------------

@query("jn03_point_in_time", """
select s.transaction_id, s.timestamp, p.product_sk, p.unit_price
from o_pos s join dim_product p on s.product_id=p.product_id and s.timestamp>=p.effective_date
     and (p.end_date is null or s.timestamp<p.end_date)""")
def jn03(feeds):
    return scd.asof_join(feeds.pos(), feeds.view("dim_product"), "product_id", "timestamp",
                         ["product_sk", "unit_price"]).select("transaction_id", "timestamp", "product_sk", "unit_price")


@query("jn04_point_in_time_default", """
select s.order_id, s.customer_id, coalesce(c.customer_sk, 1) as customer_sk, c.segment
from o_erp s left join dim_customer c on s.customer_id=c.customer_id and s.order_date>=c.effective_date
     and (c.end_date is null or s.order_date<c.end_date)""")
def jn04(feeds):
    out = scd.asof_join(feeds.erp(), feeds.view("dim_customer"), "customer_id", "order_date",
                        ["customer_sk", "segment"], how="left")
    return out.select("order_id", "customer_id",
                      F.coalesce("customer_sk", F.lit(1)).cast("bigint").alias("customer_sk"), "segment")


@query("jn03_point_in_time_merged", """
select s.transaction_id, s.timestamp, p.product_sk, p.unit_price
from o_pos s join dim_product p on s.product_id=p.product_id and s.timestamp>=p.effective_date
     and (p.end_date is null or s.timestamp<p.end_date)""")
def jn03_merged(feeds):
    """The merge in time on histories of a few versions, large keys cut into ranges."""
    return asof_merge(feeds.pos(), feeds.view("dim_product"), "product_id", "timestamp", ["product_sk", "unit_price"],
                      range_rows=100).select("transaction_id", "timestamp", "product_sk", "unit_price")


@query("jn04_point_in_time_default_merged", """
select s.order_id, s.customer_id, coalesce(c.customer_sk, 1) as customer_sk, c.segment
from o_erp s left join dim_customer c on s.customer_id=c.customer_id and s.order_date>=c.effective_date
     and (c.end_date is null or s.order_date<c.end_date)""")
def jn04_merged(feeds):
    out = asof_merge(feeds.erp(), feeds.view("dim_customer"), "customer_id", "order_date", ["customer_sk", "segment"], "left")
    return out.select("order_id", "customer_id",
                      F.coalesce("customer_sk", F.lit(1)).cast("bigint").alias("customer_sk"), "segment")


@query("jn03_wide_history", """
with daily as (select store_id, date_trunc('day', timestamp) as effective_date, sum(quantity)::bigint as units from o_pos
               where store_id is not null and timestamp is not null group by 1, 2),
     versions as (select *, lead(effective_date) over (partition by store_id order by effective_date) as end_date from daily)
select s.transaction_id, v.units from o_pos s left join versions v on s.store_id=v.store_id and s.timestamp - interval 36 hour>=v.effective_date
     and (v.end_date is null or s.timestamp - interval 36 hour<v.end_date)""")
def jn03_wide(feeds):
    """Every sale with the units its store sold on the last selling day at least 36 hours earlier: a
    store has a version for each day."""
    pos = feeds.pos()
    daily = pos.where("store_id is not null and timestamp is not null").groupBy(
        "store_id", F.to_date("timestamp").cast("timestamp_ntz").alias("effective_date")).agg(F.sum("quantity").cast("bigint").alias("units"))
    after = Window.partitionBy("store_id").orderBy("effective_date")  # one row per day
    versions = materialise(daily.withColumn("end_date", F.lead("effective_date").over(after)), "selling-days")
    sales = pos.select("transaction_id", "store_id", F.expr("timestamp - interval 36 hours").alias("at"))
    return scd.asof_join(sales, versions, "store_id", "at", ["units"], "left").select("transaction_id", "units")


@query("jn05_calendar_key", """
select s.order_id, coalesce(d.date_id, cast(strftime(s.order_date,'%Y%m%d') as int)) as date_id
from o_erp s left join (select * from o_calendar where year>=1998) d on cast(s.order_date as date)=d.full_date""")
def jn05(feeds):
    return facts.with_date_id(feeds.erp(), "order_date", feeds.calendar().filter("year >= 1998")).select(
        "order_id", "date_id")


@query("jn06_not_loaded_yet", """
select s.transaction_id from o_pos s
where not exists (select 1 from o_pos f where f.transaction_id=s.transaction_id and f.timestamp<TS('1998-01-01 00:00:00'))""")
def jn06(feeds):
    pos = feeds.pos()
    loaded = pos.filter(F.col("timestamp") < scd.ntz("1998-01-01 00:00:00"))
    return rows.unseen(pos, loaded, ["transaction_id"]).select("transaction_id")


@query("jn06_not_loaded_by_filters", """
select s.transaction_id from o_pos s
where not exists (select 1 from o_pos f where f.transaction_id=s.transaction_id and f.timestamp<TS('1998-01-01 00:00:00'))""")
def jn06_filters(feeds):
    lake = Lake(feeds.spark, os.path.join(shared_dir(feeds.spark), "bazaarline", f"lake-{uuid.uuid4().hex}"))
    pos = materialise(feeds.pos().select("transaction_id", F.expr("year(timestamp) * 100 + month(timestamp)").alias("date_month")), "pos")
    members = LoadedKeys(lake, "fact_sales", "transaction_id")
    for loaded in (pos.where("date_month < 199601"), pos.where("date_month < 199801")):  # the second load repeats the first
        fresh = members.unseen(loaded)
        members.add(fresh)
        fresh.hint("rebalance", "date_month").write.mode("append").partitionBy("date_month").parquet(lake.path("warehouse", "fact_sales"))
    return members.unseen(pos).select("transaction_id")


@query("jn10_overlapping_versions", """
select a.product_id, count(*) as pairs from dim_bad_product a join dim_bad_product b
  on a.product_id=b.product_id and a.product_sk<b.product_sk
where a.effective_date<coalesce(b.end_date, TS('9999-12-31 23:59:59'))
  and coalesce(a.end_date, TS('9999-12-31 23:59:59'))>b.effective_date
group by 1""")
def jn10(feeds):
    return scd.overlap_pairs(feeds.view("dim_bad_product"), "product_id")


@query("jn11_orphans", """
select s.store_id as fk, count(*) as rows from pos s
where s.store_id is not null and not exists (select 1 from stores t where t.store_id=s.store_id and t.region<>'ASIA')
group by 1""")
def jn11(feeds):
    return rows.orphans(feeds.view("pos"), feeds.view("stores").filter("region <> 'ASIA'"), "store_id", "store_id")


@query("jn12_current_version", """
select i.store_id, i.product_id, p.product_sk, p.unit_price
from o_inv i join dim_product p on i.product_id=p.product_id and p.is_current""")
def jn12(feeds):
    return rows.with_current(feeds.inventory(), feeds.view("dim_product"), ["product_id"],
                             ["product_sk", "unit_price"]).select("store_id", "product_id", "product_sk", "unit_price")


PIT = """
select f.order_id, d.full_date as order_date, c.customer_id, c.segment, c.effective_date, c.end_date, p.product_name
from o_fact_orders f join dim_customer c on f.customer_sk=c.customer_sk
     join dim_product p on f.product_sk=p.product_sk join o_calendar d on f.date_id=d.date_id"""


@query("jn13_star_join", PIT)
def jn13(feeds):
    return rpt13(feeds)


@query("rpt13_point_in_time_proof", PIT)
def rpt13(feeds):
    return reports.point_in_time(feeds.fact_orders(), feeds.view("dim_customer"), feeds.view("dim_product"),
                                 feeds.calendar())


@query("jn14_current_lookup", """
select s.order_id, coalesce(c.customer_sk, 1) as customer_sk, p.product_sk
from o_erp s join dim_product p on s.product_id=p.product_id and p.is_current
     left join dim_customer c on s.customer_id=c.customer_id and c.is_current""")
def jn14(feeds):
    out = scd.asof_join(feeds.erp(), feeds.view("dim_product"), "product_id", "order_date", ["product_sk"], as_of=False)
    out = scd.asof_join(out, feeds.view("dim_customer"), "customer_id", "order_date", ["customer_sk"], how="left",
                        as_of=False)
    return out.select("order_id", F.coalesce("customer_sk", F.lit(1)).cast("bigint").alias("customer_sk"),
                      "product_sk")


UPSERT = """
select coalesce(n.store_id, o.store_id) as store_id,
       case when n.store_id is not null then n.store_name else o.store_name end as store_name,
       case when n.store_id is not null then n.city else o.city end as city,
       case when n.store_id is not null then n.state else o.state end as state,
       case when n.store_id is not null then n.region else o.region end as region
from (select * from stores where region<>'AFRICA') o full outer join (
      select store_id, upper(store_name) as store_name, city, case when region='EUROPE' then null else state end as state,
             region from stores where region<>'ASIA') n on o.store_id=n.store_id"""


@query("jn15_upsert", UPSERT)
def jn15(feeds):
    target = feeds.view("stores").filter("region <> 'AFRICA'")
    source = feeds.sql("""select store_id, upper(store_name) as store_name, city,
        case when region='EUROPE' then null else state end as state, region from stores where region<>'ASIA'""")
    return rows.upsert(target, source, ["store_id"])


@query("wh05_store_upsert", UPSERT)
def wh05(feeds):
    return jn15(feeds)


@query("jn16_insert_absent", """
select date_id, full_date, year, month, day, quarter, day_of_week, is_weekend and year<1999 as is_weekend
from o_calendar""")
def jn16(feeds):
    calendar = feeds.calendar()
    target = calendar.filter("year < 1999")
    source = calendar.withColumn("is_weekend", F.lit(False))
    return rows.insert_absent(target, source, ["date_id"])


@query("wh04_calendar", "select * from o_calendar")
def wh04(feeds):
    return feeds.calendar()


# -- fact loads --------------------------------------------------------------------------------

@query("wh06_fact_sales", """
select transaction_id, date_id, store_id, product_sk, cast(customer_sk as bigint) as customer_sk, quantity, sale_amount
from o_fact_sales where date_id>=19980101""")
def wh06(feeds):
    pos = feeds.pos()
    loaded = pos.filter(F.col("timestamp") < scd.ntz("1998-01-01 00:00:00"))
    return facts.fact_sales(pos, feeds.view("dim_product"), feeds.calendar(), loaded, unique=True)


@query("wh07_fact_orders", """
select order_id, date_id, cast(customer_sk as bigint) as customer_sk, product_sk, quantity, unit_price,
       cast(total_amount as double) as total_amount, region
from o_fact_orders where date_id>=19980101""")
def wh07(feeds):
    erp = feeds.erp()
    loaded = erp.filter(F.col("order_date") < scd.ntz("1998-01-01 00:00:00"))
    out = facts.fact_orders(erp, feeds.view("dim_product"), feeds.view("dim_customer"), feeds.calendar(), loaded,
                            unique=True)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("wh08_fact_sales_current", """
select s.transaction_id, cast(strftime(s.timestamp,'%Y%m%d') as int) as date_id, s.store_id, p.product_sk,
       cast(1 as bigint) as customer_sk, s.quantity, s.sale_amount
from o_pos s join dim_product p on s.product_id=p.product_id and p.is_current""")
def wh08_sales(feeds):
    return facts.fact_sales(feeds.pos(), feeds.view("dim_product"), as_of=False, unique=True)


@query("wh08_fact_orders_current", """
select s.order_id, cast(strftime(s.order_date,'%Y%m%d') as int) as date_id,
       cast(coalesce(c.customer_sk, 1) as bigint) as customer_sk, p.product_sk, s.quantity, s.unit_price,
       cast(s.quantity*s.unit_price as double) as total_amount, s.region
from o_erp s join dim_product p on s.product_id=p.product_id and p.is_current
     left join dim_customer c on s.customer_id=c.customer_id and c.is_current""")
def wh08_orders(feeds):
    out = facts.fact_orders(feeds.erp(), feeds.view("dim_product"), feeds.view("dim_customer"), as_of=False,
                            unique=True)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


# -- audits ------------------------------------------------------------------------------------

GAPS_SALES = "(select *, case when store_id%7=0 then null else product_sk end as psk from o_fact_sales)"
GAPS_ORDERS = "(select *, case when region='ASIA' then null else customer_sk end as csk from o_fact_orders)"


def _gappy(feeds):
    """Facts with keys lost on the way, as an audit would find them."""
    sales = feeds.fact_sales().withColumn(
        "product_sk", F.when(F.col("store_id") % 7 != 0, F.col("product_sk")))
    orders = feeds.fact_orders().withColumn(
        "customer_sk", F.when(F.col("region") != "ASIA", F.col("customer_sk")))
    return sales, orders


@query("aud01_null_keys", f"""
select 'orphan_sales_prod' as check, count(*) filter (where psk is null) as violations from {GAPS_SALES}
union all select 'orphan_orders_cust', count(*) filter (where csk is null) from {GAPS_ORDERS}
union all select 'orphan_orders_prod', count(*) filter (where product_sk is null) from {GAPS_ORDERS}""")
def aud01(feeds):
    return audit.null_keys(*_gappy(feeds))


ORPHANS = f"""
select 'orphan_sales_products' as check, count(*) as violations from {GAPS_SALES} f
  left join (select * from dim_product where category<>'PROMO') p on f.psk=p.product_sk where p.product_sk is null and f.psk is not null
union all
select 'orphan_sales_stores', count(*) from {GAPS_SALES} f
  left join (select * from stores where region<>'ASIA') s on f.store_id=s.store_id where s.store_id is null and f.store_id is not null
union all
select 'orphan_orders_customers', count(*) from {GAPS_ORDERS} f
  left join (select * from dim_customer where segment<>'UPGRADED') c on f.csk=c.customer_sk where c.customer_sk is null and f.csk is not null
union all
select 'orphan_orders_products', count(*) from {GAPS_ORDERS} f
  left join (select * from dim_product where category<>'PROMO') p on f.product_sk=p.product_sk where p.product_sk is null and f.product_sk is not null"""


@query("aud02_orphan_facts", ORPHANS)
def aud02(feeds):
    return audit.fact_orphans(*_gappy(feeds), feeds.view("dim_product").filter("category <> 'PROMO'"),
                              feeds.view("stores").filter("region <> 'ASIA'"),
                              feeds.view("dim_customer").filter("segment <> 'UPGRADED'"))


def overlap_sql(dim: str, key: str, sk: str) -> str:
    return f"""(select count(*) from {dim} a join {dim} b on a.{key}=b.{key} and a.{sk}<b.{sk}
  where a.effective_date<coalesce(b.end_date, TS('9999-12-31 23:59:59'))
    and coalesce(a.end_date, TS('9999-12-31 23:59:59'))>b.effective_date)"""


@query("aud03_overlaps", f"""
select 'overlapping_cust' as check, {overlap_sql('dim_bad_customer', 'customer_id', 'customer_sk')} as violations
union all select 'overlapping_prod', {overlap_sql('dim_bad_product', 'product_id', 'product_sk')}""")
def aud03(feeds):
    return audit.overlaps(feeds.view("dim_bad_customer"), feeds.view("dim_bad_product"))


def dup_sql(dim: str, key: str) -> str:
    return f"(select count(*) from (select {key} from {dim} where is_current group by 1 having count(*)>1))"


@query("aud04_duplicate_current", f"""
select 'dup_cust' as check, {dup_sql('dim_bad_customer', 'customer_id')} as violations
union all select 'dup_prod', {dup_sql('dim_bad_product', 'product_id')}""")
def aud04(feeds):
    return audit.duplicate_current(feeds.view("dim_bad_customer"), feeds.view("dim_bad_product"))


DUPS = """
select 'fact_sales' as table_name, transaction_id as dup_id, count(*) as occurrences from pos group by 2 having count(*)>1
union all
select 'fact_orders', order_id, count(*) from erp group by 2 having count(*)>1"""


@query("aud05_duplicate_facts", DUPS)
def aud05(feeds):
    return audit.duplicate_facts(feeds.view("pos"), feeds.view("erp"))


@query("rpt09_duplicate_facts", DUPS)
def rpt09(feeds):
    return audit.duplicate_facts(feeds.view("pos"), feeds.view("erp"))


@query("agg16_duplicate_groups", """
select store_id, product_id, count(*) as occurrences from inventory group by 1, 2 having count(*)>1""")
def agg16(feeds):
    return rows.duplicate_keys(feeds.view("inventory"), ["store_id", "product_id"])


@query("aud06_integrity_suite", """
select 'orphan_sales_prod' as check, (select count(*) from o_fact_sales where product_sk is null) as violations
union all select 'orphan_orders_cust', (select count(*) from o_fact_orders where customer_sk is null)
union all select 'orphan_orders_prod', (select count(*) from o_fact_orders where product_sk is null)
""" + f"""union all select 'overlapping_cust', {overlap_sql('dim_customer', 'customer_id', 'customer_sk')}
union all select 'overlapping_prod', {overlap_sql('dim_product', 'product_id', 'product_sk')}
union all select 'dup_cust', {dup_sql('dim_customer', 'customer_id')}
union all select 'dup_prod', {dup_sql('dim_product', 'product_id')}""")
def aud06(feeds):
    return audit.audit(feeds.fact_sales(), feeds.fact_orders(), feeds.view("dim_customer"), feeds.view("dim_product"))


ONE_ROW = f"""
select (select count(*) from {GAPS_SALES} f left join (select * from dim_product where category<>'PROMO') p
          on f.psk=p.product_sk where p.product_sk is null) as orphan_sales_products,
       (select count(*) from {GAPS_SALES} f left join (select * from stores where region<>'ASIA') s
          on f.store_id=s.store_id where s.store_id is null) as orphan_sales_stores,
       (select count(*) from {GAPS_ORDERS} f left join (select * from dim_customer where segment<>'UPGRADED') c
          on f.csk=c.customer_sk where c.customer_sk is null) as orphan_orders_customers"""


@query("agg17_counts_in_one_row", ONE_ROW)
def agg17(feeds):
    return rpt08(feeds)


@query("rpt08_orphan_report", ONE_ROW)
def rpt08(feeds):
    sales, orders = _gappy(feeds)
    return reports.orphan_report(sales, orders, feeds.view("dim_product").filter("category <> 'PROMO'"),
                                 feeds.view("stores").filter("region <> 'ASIA'"),
                                 feeds.view("dim_customer").filter("segment <> 'UPGRADED'"))


HISTORY = """
select customer_id, customer_name, segment, effective_date, end_date, is_current from dim_customer
where customer_id in (1, 5, 99999)"""


@query("srt05_version_history", HISTORY)
def srt05(feeds):
    return rpt06(feeds)


@query("rpt06_version_history", HISTORY)
def rpt06(feeds):
    return reports.version_history(feeds.view("dim_customer"), [1, 5, 99999])


@query("rpt07_recent_lineage", """
select run_id, source_dataset, bronze_path, silver_path, gold_path, load_timestamp from lineage_log
order by load_timestamp desc, run_id, source_dataset limit 10""")
def rpt07(feeds):
    from ..ledger import lineage_recent

    return lineage_recent(feeds.view("lineage_log"))
