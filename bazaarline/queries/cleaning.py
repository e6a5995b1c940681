"""Cleaning queries over the feeds as delivered."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import clean
from ..operators.rows import dedup
from .registry import query

TITLE = ("array_to_string(list_transform(regexp_extract_all(lower(trim({0})), '[a-z]+|[^a-z]+'), "
         "lambda t: concat(upper(t[1]), t[2:])), '')")
NUMERIC = r"regexp_full_match({0}, '\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*')"
NUM = "coalesce(case when " + NUMERIC + " then try_cast({0} as double) end, 0.0)"
WHOLE = "cast(trunc(" + NUM + ") as bigint)"
DATE = ("case when {0} like '%/%' then try_strptime({0}, '%m/%d/%Y') else try_cast({0} as timestamp) end")


def first_of(view: str, keys: str, order: str) -> str:
    return f"(select * from (select *, row_number() over (partition by {keys} order by {order}) as rn from {view}) where rn=1)"


@query("cln01_keep_first", f"""
select order_id, customer_id, product_id, quantity, order_date, region, unit_price
from {first_of('erp', 'order_id', 'ord1, ord2, product_id, quantity, ord3')}""")
def keep_first(feeds):
    return dedup(feeds.view("erp"), ["order_id"], feeds.ERP_ORDER).drop("ord1", "ord2", "ord3")


@query("cln02_keep_last", "select * from o_inv")
def keep_last(feeds):
    return dedup(feeds.view("inventory"), ["store_id", "product_id"], feeds.INV_ORDER, keep="last").drop("ord1")


@query("cln03_generic_clean", """
select distinct store, coalesce(amount, 'Unknown') as amount, coalesce(cast(qty as varchar), 'Unknown') as qty from (
  select cast(store_id as varchar) as store, case when transaction_id%31=0 then null else 'x' end as amount,
         case when transaction_id%11=0 then null else quantity end as qty from pos)""")
def generic(feeds):
    raw = feeds.sql("""select cast(store_id as string) as store,
        case when transaction_id%31=0 then null else 'x' end as amount,
        case when transaction_id%11=0 then null else quantity end as qty from pos""")
    return clean.generic_clean(raw)


@query("cln04_strict_dates", f"""
select order_id, order_date as order_text, {DATE.format('order_date')} as order_date from erp_raw""")
def strict_dates(feeds):
    return feeds.view("erp_raw").select(
        "order_id", F.col("order_date").alias("order_text"),
        fn.parse_ts(F.col("order_date"), strict=True).alias("order_date"))


@query("cln05_lenient_dates", f"""
select store_id, product_id, ord1, {DATE.format('last_restock_date')} as last_restock_date from inventory_raw""")
def lenient_dates(feeds):
    return feeds.view("inventory_raw").select(
        "store_id", "product_id", "ord1", fn.parse_ts(F.col("last_restock_date")).alias("last_restock_date"))


@query("cln06_whole_numbers", f"""
select order_id, quantity as quantity_text, {WHOLE.format('quantity')} as quantity from erp_raw""")
def whole_numbers(feeds):
    return feeds.view("erp_raw").select(
        "order_id", F.col("quantity").alias("quantity_text"),
        fn.coerce_num(F.col("quantity"), to_int=True).alias("quantity"))


@query("cln07_numbers", f"""
select order_id, unit_price as price_text, {NUM.format('unit_price')} as unit_price from erp_raw""")
def numbers(feeds):
    return feeds.view("erp_raw").select(
        "order_id", F.col("unit_price").alias("price_text"), fn.coerce_num(F.col("unit_price")).alias("unit_price"))


@query("cln08_fill_upper", "select order_id, upper(coalesce(region, 'Unknown')) as region from erp_raw")
def fill_upper(feeds):
    return feeds.view("erp_raw").select("order_id", fn.fill_upper(F.col("region")).alias("region"))


@query("cln09_title_case", f"""
select ord2, customer_id, customer_name as name_text, {TITLE.format('customer_name')} as customer_name from crm_raw""")
def title_case(feeds):
    return feeds.view("crm_raw").select(
        "ord2", "customer_id", F.col("customer_name").alias("name_text"),
        fn.title_trim(F.col("customer_name")).alias("customer_name"))


@query("cln10_fill_constant", f"""
select ord2, ord3, product_id, {TITLE.format("coalesce(category, 'Unknown')")} as category from products_raw""")
def fill_title(feeds):
    return feeds.view("products_raw").select("ord2", "ord3", "product_id",
                                             fn.fill_title(F.col("category")).alias("category"))


@query("cln11_clean_erp_orders", f"""
select order_id, customer_id, product_id, {WHOLE.format('quantity')} as quantity,
       {DATE.format('order_date')} as order_date, upper(coalesce(region, 'Unknown')) as region,
       {NUM.format('unit_price')} as unit_price
from {first_of('erp_raw', 'order_id', 'ord1, ord2, product_id, ord3')}""")
def erp(feeds):
    return clean.clean_erp_orders(feeds.view("erp_raw"), ["ord1", "ord2", "product_id", "ord3"]) \
        .drop("ord1", "ord2", "ord3")


@query("cln12_clean_crm_customers", f"""
select customer_id, {TITLE.format('customer_name')} as customer_name, coalesce(segment, 'Uncategorized') as segment,
       acquisition_channel, {DATE.format('signup_date')} as signup_date
from {first_of('crm_raw', 'customer_id', 'ord1, ord2')}""")
def crm(feeds):
    return clean.clean_crm_customers(feeds.view("crm_raw"), ["ord1", "ord2"]).drop("ord1", "ord2")


@query("cln13_clean_pos_transactions", f"""
select transaction_id, store_id, product_id, quantity, {DATE.format('timestamp')} as timestamp,
       {NUM.format('sale_amount')} as sale_amount
from {first_of('pos_raw', 'transaction_id', 'timestamp, store_id, product_id, quantity, ord1')}""")
def pos(feeds):
    return clean.clean_pos_transactions(
        feeds.view("pos_raw"), ["timestamp", "store_id", "product_id", "quantity", "ord1"]).drop("ord1")


@query("cln14_clean_products", f"""
select product_id, {TITLE.format('product_name')} as product_name,
       {TITLE.format("coalesce(category, 'Unknown')")} as category, {NUM.format('unit_price')} as unit_price
from {first_of('products_raw', 'product_id', 'ord1, ord2, ord3, ord4, ord5')}""")
def products(feeds):
    return clean.clean_products(feeds.view("products_raw"), ["ord1", "ord2", "ord3", "ord4", "ord5"]) \
        .drop("ord1", "ord2", "ord3", "ord4", "ord5")


@query("cln15_clean_inventory", f"""
select store_id, product_id, {WHOLE.format('stock_level')} as stock_level,
       {WHOLE.format('reorder_point')} as reorder_point, {DATE.format('last_restock_date')} as last_restock_date
from {first_of('inventory_raw', 'store_id, product_id', 'ord0 desc, ord1 desc, stock_level desc')}""")
def inventory(feeds):
    return clean.clean_inventory(feeds.view("inventory_raw"), ["ord0", "ord1", "stock_level"]).drop("ord0", "ord1")


@query("cln15_bad_inventory_ids", f"""
select {WHOLE.format('store_id')} as store_id, {WHOLE.format('product_id')} as product_id, stock_level, reorder_point,
       cast(last_restock_date as timestamp) as last_restock_date
from {first_of('inventory_bad_ids', 'store_id, product_id', 'last_restock_date desc, ord1 desc, stock_level desc')}""")
def inventory_ids(feeds):
    return clean.clean_inventory(feeds.view("inventory_bad_ids"), feeds.INV_ORDER).drop("ord1")


@query("cln16_clean_by_name", """
select distinct store_id, store_name, coalesce(city, 'Unknown') as city, coalesce(state, 'Unknown') as state,
       coalesce(region, 'Unknown') as region
from (select cast(store_id as varchar) as store_id, store_name, city, case when region='ASIA' then null else state end as state,
             region from stores)""")
def by_name(feeds):
    raw = feeds.sql("""select cast(store_id as string) as store_id, store_name, city,
        case when region='ASIA' then null else state end as state, region from stores""")
    return clean.clean(raw, "dim_store")


@query("cln17_conform", """
select l_orderkey*10+l_linenumber as transaction_id, l_suppkey as store_id, l_partkey as product_id,
       cast(l_quantity as double) as quantity, l_shipdate as timestamp, cast(null as double) as sale_amount from lineitem""")
def conform(feeds):
    raw = feeds.sql("select l_orderkey*10+l_linenumber as tx_id, l_suppkey, l_partkey as sku, l_quantity as qty, "
                    "l_shipdate from lineitem")
    return clean.conform(
        raw, {"transaction_id": "tx_id", "store_id": "l_suppkey", "product_id": "sku", "quantity": "qty",
              "timestamp": "l_shipdate", "sale_amount": None},
        _schema("transaction_id bigint, store_id bigint, product_id bigint, quantity double, "
                "timestamp timestamp_ntz, sale_amount double"))


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


@query("cln18_composite_key", """
select concat(coalesce(store_id, 'nan'), '_', coalesce(product_id, 'nan')) as composite_key, count(*) as n
from inventory_bad_ids group by 1""")
def composite(feeds):
    return feeds.view("inventory_bad_ids").groupBy("store_id", "product_id").agg(F.count(F.lit(1)).alias("n")).select(
        fn.composite_key(F.col("store_id"), F.col("product_id")).alias("composite_key"), "n")


@query("cln19_in_lists", """
select i.store_id, i.product_id, i.stock_level, p.category, s.region
from inventory i join products p on i.product_id=p.product_id join stores s on i.store_id=s.store_id
where p.category in ('PROMO', 'LARGE') and s.region in ('ASIA', 'EUROPE')""")
def in_lists(feeds):
    wide = feeds.view("inventory").join(feeds.view("products"), "product_id").join(feeds.view("stores"), "store_id")
    return clean.where_in(wide, category=["PROMO", "LARGE"], region=["ASIA", "EUROPE"]).select(
        "store_id", "product_id", "stock_level", "category", "region")


@query("cln20_fill_zero", """
select p.product_id, coalesce(p.product_name, '0') as product_name, coalesce(s.region, '0') as region,
       coalesce(s.units, 0) as units, s.last_sale
from products p left join (
  select product_id, min(case when sale_amount>50000 then 'high' end) as region, cast(sum(quantity) as bigint) as units,
         max(timestamp) as last_sale from pos where sale_amount>90000 group by product_id) s
  on p.product_id=s.product_id""")
def fill_zero(feeds):
    sold = feeds.sql("""select product_id, min(case when sale_amount>50000 then 'high' end) as region,
        sum(quantity) as units, max(timestamp) as last_sale from pos where sale_amount>90000 group by product_id""")
    joined = feeds.view("products").select("product_id", "product_name").join(sold, "product_id", "left")
    return fn.fill_all_zero(joined)


@query("cln21_second_precision", "select event_id, date_trunc('second', ts) as ts from events")
def second_precision(feeds):
    return feeds.table("events").select("event_id", fn.to_second(F.col("ts")).alias("ts"))
