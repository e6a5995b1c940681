"""SQL views that map the given tables to the retail feeds.

The texts are plain enough for Spark and DuckDB; ``TS('...')`` stands for a zone-less
timestamp literal. The ``o_`` views at the end are used by the SQL twins only: they restate
what the operators compute.
"""

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS: dict[str, str] = {
    # feeds ----------------------------------------------------------------------------
    "erp": """
select o_orderkey*10+l_linenumber as order_id, o_custkey as customer_id, l_partkey as product_id,
       cast(l_quantity as bigint) as quantity, o_orderdate as order_date, r_name as region,
       cast(p_retailprice as decimal(10,2)) as unit_price, l_shipdate as ord1, l_suppkey as ord2,
       l_extendedprice as ord3
from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
     join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
     join region on n_regionkey=r_regionkey""",
    "pos": """
select l_orderkey*10+l_linenumber as transaction_id, l_suppkey as store_id, l_partkey as product_id,
       cast(l_quantity as bigint) as quantity, l_shipdate as timestamp,
       cast(l_extendedprice as decimal(12,2))*(1-cast(l_discount as decimal(4,2))) as sale_amount
from lineitem""",
    "inventory": """
select l_suppkey as store_id, l_partkey as product_id, (l_orderkey*31+l_linenumber*17)%200 as stock_level,
       10+(l_suppkey*7+l_partkey*3)%40 as reorder_point, l_shipdate as last_restock_date,
       l_orderkey*10+l_linenumber as ord1
from lineitem""",
    "stores": """
select s_suppkey as store_id, s_name as store_name, n_name as city, n_name as state, r_name as region
from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey""",
    "products": """
select p_partkey as product_id, p_name as product_name, p_type as category,
       cast(p_retailprice as decimal(10,2)) as unit_price from part""",
    "crm": """
select c_custkey as customer_id, c_name as customer_name, c_mktsegment as segment,
       r_name as acquisition_channel, date '1995-01-01' + cast(c_custkey % 1000 as int) as signup_date
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey""",
    # the same feeds as delivered: text cells, gaps, several date forms, copies -----------
    "erp_raw": """
select order_id, customer_id, product_id,
       case when order_id%17=0 then 'invalid' when order_id%23=0 then null
            when order_id%5=0 then concat(cast(quantity as string), '.75') else cast(quantity as string) end as quantity,
       case when order_id%3=0 then concat(substr(cast(cast(order_date as date) as string),6,2),'/',
                                          substr(cast(cast(order_date as date) as string),9,2),'/',
                                          substr(cast(cast(order_date as date) as string),1,4))
            else cast(cast(order_date as date) as string) end as order_date,
       case when order_id%13=0 then null else lower(region) end as region,
       case when order_id%19=0 then 'n.a.' when order_id%29=0 then null
            else cast(unit_price as string) end as unit_price,
       ord1, ord2, ord3
from erp""",
    "crm_raw": """
select o_custkey as customer_id,
       case when o_orderkey%3=0 then concat('  ', lower(c_name), ' ')
            when o_orderkey%3=1 then concat('o''neil-', lower(n_name), ' 3rd ', upper(r_name))
            else c_name end as customer_name,
       case when o_orderkey%19=0 then null else c_mktsegment end as segment,
       r_name as acquisition_channel, cast(cast(o_orderdate as date) as string) as signup_date,
       o_orderdate as ord1, o_orderkey as ord2
from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
     join region on n_regionkey=r_regionkey""",
    "pos_raw": """
select transaction_id, store_id, product_id, quantity, cast(cast(timestamp as date) as string) as timestamp,
       case when transaction_id%11=0 then 'free' when transaction_id%31=0 then null
            else cast(sale_amount as string) end as sale_amount, sale_amount as ord1
from pos""",
    "products_raw": """
select l_partkey as product_id,
       case when l_orderkey%2=0 then concat(' ', upper(p_name), '  ') else p_name end as product_name,
       case when l_orderkey%7=0 then null when l_orderkey%7=1 then concat(lower(p_type), ' ')
            else p_type end as category,
       case when l_orderkey%37=0 then 'tbd' else cast(cast(l_extendedprice as decimal(12,2)) as string) end as unit_price,
       l_shipdate as ord1, l_orderkey as ord2, l_linenumber as ord3, l_suppkey as ord4, l_extendedprice as ord5
from lineitem join part on l_partkey=p_partkey""",
    "inventory_raw": """
select store_id, product_id,
       case when ord1%41=0 then 'lost' else cast(stock_level as string) end as stock_level,
       case when ord1%43=0 then null else concat(cast(reorder_point as string), '.5') end as reorder_point,
       case when ord1%47=0 then 'soon' else cast(cast(last_restock_date as date) as string) end as last_restock_date,
       last_restock_date as ord0, ord1
from inventory""",
    "inventory_bad_ids": """
select case when product_id%97=0 then null when product_id%89=0 then 'unknown' else cast(store_id as string) end as store_id,
       cast(product_id as string) as product_id, stock_level, reorder_point, last_restock_date, ord1
from inventory""",
    # versioned dimensions with two versions for part of the keys ------------------------
    "dim_product": """
select p_partkey*2+2 as product_sk, p_partkey as product_id, p_name as product_name, p_type as category,
       cast(p_retailprice as decimal(10,2)) as unit_price, TS('1995-06-01 00:00:00') as effective_date,
       case when p_size>25 then TS('1998-01-01 00:00:00') else null end as end_date, p_size<=25 as is_current
from part
union all
select p_partkey*2+3, p_partkey, p_name, p_type,
       cast(cast(p_retailprice as decimal(10,2))*cast(1.1 as decimal(2,1)) as decimal(10,2)),
       TS('1998-01-01 00:00:00'), null, true
from part where p_size>25""",
    "dim_customer": """
select 1 as customer_sk, 99999 as customer_id, 'Walk-in Customer' as customer_name, 'Retail' as segment,
       'Organic' as acquisition_channel, date '2020-01-01' as signup_date,
       TS('2020-01-01 00:00:00') as effective_date, null as end_date, true as is_current
from region where r_name='AFRICA'
union all
select c.customer_id*2+2, c.customer_id, c.customer_name, c.segment, c.acquisition_channel, c.signup_date,
       TS('1996-01-01 00:00:00'), case when c_acctbal<0 then TS('1999-01-01 00:00:00') else null end, c_acctbal>=0
from crm c join customer on c_custkey=c.customer_id where c.acquisition_channel<>'AFRICA'
union all
select c.customer_id*2+3, c.customer_id, c.customer_name, 'UPGRADED', c.acquisition_channel, c.signup_date,
       TS('1999-01-01 00:00:00'), null, true
from crm c join customer on c_custkey=c.customer_id where c.acquisition_channel<>'AFRICA' and c_acctbal<0""",
    # two deliveries of the customer and product feeds: the first lacks a market that opened
    # later, the second lacks one that sent nothing, with changed values in between
    "crm_first": "select * from crm where acquisition_channel <> 'AFRICA'",
    "crm_second": """
select customer_id, customer_name,
       case when c_acctbal<0 then 'UPGRADED' when n_name='NATION_4' then null else segment end as segment,
       acquisition_channel, signup_date
from crm join customer on c_custkey=customer_id join nation on c_nationkey=n_nationkey
where acquisition_channel <> 'EUROPE'""",
    "products_first": "select * from products where category <> 'LARGE'",
    "products_second": """
select product_id, product_name, case when category='PROMO' then 'CLEARANCE' else category end as category,
       cast(unit_price + case when p_size>40 then 1.00 else 0.00 end as decimal(10,2)) as unit_price
from products join part on p_partkey=product_id where category <> 'SMALL'""",
    # headers of many uploads: an order is an upload, its lines are its columns ----------
    "uploads": """
select o_orderkey as dataset,
       concat(case o_orderstatus when 'F' then 'customer_' when 'O' then 'pos_receipt_' else 'misc_' end,
              case when o_orderpriority='1-URGENT' then 'product' when o_orderpriority='2-HIGH' then 'stock' else 'export' end,
              '.csv') as filename,
       l_linenumber as position,
       case l_partkey%14 when 0 then ' Customer_ID' when 1 then 'name' when 2 then 'tier' when 3 then 'channel'
            when 4 then 'signup_date' when 5 then 'sku' when 6 then 'price' when 7 then 'qty' when 8 then 'store'
            when 9 then 'id' when 10 then 'created_at' when 11 then 'stock' when 12 then 'productname'
            else 'notes' end as column_name
from orders join lineitem on l_orderkey=o_orderkey""",
    # registered and staged dataset types of many tenants --------------------------------
    "typed_uploads": """
select o_custkey as tenant, o_orderdate as seen_at, o_orderkey as upload,
       case o_orderpriority when '1-URGENT' then 'CRM' when '2-HIGH' then 'ERP' when '3-MEDIUM' then 'POS'
            when '5-LOW' then 'Inventory' else 'Products' end as type
from orders""",
    # log events of many runs --------------------------------------------------------------
    "run_events": """
select cast(user_id as string) as run_id, ts as event_time, cast(floor(value) as bigint) as rows_processed,
       case when event_type='view' then event_id%7 else 0 end as rows_loaded,
       cast(0 as bigint) as rows_failed,
       case event_type when 'signup' then 'RUNNING' when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' end
       as pipeline_status, case when event_type='error' then props end as error_message
from events""",
    "lineage_log": """
select cast(event_id as string) as run_id, event_type as source_dataset,
       concat('user_', cast(user_id as string), '.csv') as source_file_name,
       concat('bronze/', event_type) as bronze_path, concat('silver/', event_type) as silver_path,
       cast(null as string) as gold_path, ts as load_timestamp
from events""",
    # SQL twins ------------------------------------------------------------------------------
    "o_erp": """
select order_id, customer_id, product_id, quantity, order_date, upper(region) as region, unit_price from (
  select *, row_number() over (partition by order_id order by ord1, ord2, product_id, quantity, ord3) as rn from erp)
where rn=1""",
    "o_pos": """
select transaction_id, store_id, product_id, quantity, timestamp, sale_amount from (
  select *, row_number() over (partition by transaction_id
                               order by timestamp, store_id, product_id, quantity, sale_amount) as rn from pos)
where rn=1""",
    "o_inv": """
select store_id, product_id, stock_level, reorder_point, last_restock_date from (
  select *, row_number() over (partition by store_id, product_id
                               order by last_restock_date desc, ord1 desc, stock_level desc) as rn from inventory)
where rn=1""",
    "o_customer_revenue": """
select customer_id, sum(quantity*unit_price) as total_revenue, count(order_id) as total_orders,
       cast(sum(quantity*unit_price) as double)/count(order_id) as average_order_value
from o_erp where customer_id is not null group by customer_id""",
    "o_customer_metrics": """
select c.customer_id, c.customer_name, c.segment, c.acquisition_channel, c.signup_date,
       coalesce(r.total_revenue, 0) as total_revenue, coalesce(r.total_orders, 0) as total_orders,
       coalesce(r.average_order_value, 0) as average_order_value
from crm c left join o_customer_revenue r on c.customer_id=r.customer_id""",
    "o_daily": """
select cast(timestamp as date) as date, sum(sale_amount) as daily_revenue,
       count(transaction_id) as daily_transactions
from o_pos group by 1""",
    "o_sales_metrics": """
select date, daily_revenue, daily_transactions,
       case when prev is null or (prev=0 and cur=0) then 0.0
            when prev=0 then sign(cur)*cast('inf' as double) else (cur/prev-1)*100 end as revenue_growth_pct
from (select *, cast(daily_revenue as double) as cur,
             cast(lag(daily_revenue) over (order by date) as double) as prev from o_daily)""",
    "o_units": "select store_id, product_id, cast(sum(quantity) as bigint) as total_qty_sold from o_pos group by 1, 2",
    "o_days": """
select cast(greatest(1, coalesce(datesub('day', min(timestamp), max(timestamp)), 1)) as double) as days from o_pos""",
    "o_inventory_metrics": """
select i.store_id, i.product_id, i.stock_level, i.reorder_point,
       case when i.stock_level>0 then cast(coalesce(u.total_qty_sold,0) as double)/i.stock_level else 0.0 end as stock_turnover,
       cast(coalesce(u.total_qty_sold,0) as double)/(select days from o_days) as inventory_velocity,
       case when coalesce(u.total_qty_sold,0)>0
            then cast(i.stock_level as double)/u.total_qty_sold*(select days from o_days) else 999.0 end
         as days_inventory_outstanding,
       i.stock_level<=i.reorder_point as low_stock_alert
from o_inv i left join o_units u on i.store_id=u.store_id and i.product_id=u.product_id""",
    "o_fact_sales": """
select s.transaction_id, cast(strftime(s.timestamp,'%Y%m%d') as int) as date_id, s.store_id, p.product_sk,
       1 as customer_sk, s.quantity, s.sale_amount
from o_pos s join dim_product p on s.product_id=p.product_id and s.timestamp>=p.effective_date
     and (p.end_date is null or s.timestamp<p.end_date)""",
    "o_fact_orders": """
select s.order_id, cast(strftime(s.order_date,'%Y%m%d') as int) as date_id, coalesce(c.customer_sk,1) as customer_sk,
       p.product_sk, s.quantity, s.unit_price, s.quantity*s.unit_price as total_amount, s.region
from o_erp s join dim_product p on s.product_id=p.product_id and s.order_date>=p.effective_date
     and (p.end_date is null or s.order_date<p.end_date)
     left join dim_customer c on s.customer_id=c.customer_id and s.order_date>=c.effective_date
     and (c.end_date is null or s.order_date<c.end_date)""",
    "o_calendar": """
select cast(strftime(d,'%Y%m%d') as int) as date_id, d as full_date, cast(year(d) as int) as year,
       cast(month(d) as int) as month, cast(day(d) as int) as day, cast(quarter(d) as int) as quarter,
       cast(isodow(d) as int) as day_of_week, isodow(d)>=6 as is_weekend
from (select cast(timestamp as date) as d from pos union select cast(order_date as date) from erp)
where d is not null""",
    # the customer dimension after the first and the second delivery, without surrogate keys
    "o_cust_first": """
select 99999 as customer_id, 'Walk-in Customer' as customer_name, 'Retail' as segment, 'Organic' as acquisition_channel,
       date '2020-01-01' as signup_date, TS('2020-01-01 00:00:00') as effective_date,
       cast(null as timestamp) as end_date, true as is_current
union all
select customer_id, customer_name, segment, acquisition_channel, signup_date,
       TS('2000-01-01 00:00:00'), cast(null as timestamp), true from crm_first where customer_id<>99999""",
    "o_cust_changed": """
select d.customer_id from o_cust_first d join crm_second s on d.customer_id=s.customer_id
where d.is_current and (d.customer_name<>s.customer_name or d.segment<>s.segment
                        or d.acquisition_channel<>s.acquisition_channel)""",
    "o_cust_second": """
select customer_id, customer_name, segment, acquisition_channel, signup_date, effective_date,
       case when customer_id in (select customer_id from o_cust_changed) then TS('2001-01-01 00:00:00')
            else end_date end as end_date,
       is_current and customer_id not in (select customer_id from o_cust_changed) as is_current
from o_cust_first
union all
select s.customer_id, s.customer_name, s.segment, s.acquisition_channel, s.signup_date,
       case when exists (select 1 from o_cust_first d where d.customer_id=s.customer_id)
            then TS('2001-01-01 00:00:00') else TS('2000-01-01 00:00:00') end, cast(null as timestamp), true
from crm_second s
where s.customer_id in (select customer_id from o_cust_changed)
   or not exists (select 1 from o_cust_first d where d.customer_id=s.customer_id and d.is_current)""",
    "o_prod_first": """
select product_id, product_name, category, unit_price, TS('2000-01-01 00:00:00') as effective_date,
       cast(null as timestamp) as end_date, true as is_current from products_first""",
    "o_prod_changed": """
select d.product_id from o_prod_first d join products_second s on d.product_id=s.product_id
where d.product_name<>s.product_name or d.category<>s.category or abs(d.unit_price-s.unit_price)>0.001""",
    "o_prod_second": """
select product_id, product_name, category, unit_price, effective_date,
       case when product_id in (select product_id from o_prod_changed) then TS('2001-01-01 00:00:00') else end_date end
         as end_date,
       product_id not in (select product_id from o_prod_changed) as is_current
from o_prod_first
union all
select s.product_id, s.product_name, s.category, s.unit_price,
       case when exists (select 1 from o_prod_first d where d.product_id=s.product_id)
            then TS('2001-01-01 00:00:00') else TS('2000-01-01 00:00:00') end, cast(null as timestamp), true
from products_second s
where s.product_id in (select product_id from o_prod_changed)
   or not exists (select 1 from o_prod_first d where d.product_id=s.product_id)""",
    "o_cust_changed_null": """
select d.customer_id from o_cust_first d join crm_second s on d.customer_id=s.customer_id
where d.is_current and (d.customer_name is distinct from s.customer_name or d.segment is distinct from s.segment
                        or d.acquisition_channel is distinct from s.acquisition_channel)""",
    # dimensions with broken intervals and doubled current versions, for the audits
    "dim_bad_product": """
select product_sk*10 as product_sk, product_id, effective_date,
       case when category='PROMO' and end_date is not null then TS('1999-01-01 00:00:00') else end_date end as end_date,
       is_current
from dim_product
union all
select product_sk*10+1, product_id, TS('1997-01-01 00:00:00'), TS('1997-01-01 00:00:00'), false
from dim_product where category='LARGE'
union all
select product_sk*10+2, product_id, TS('1999-06-01 00:00:00'), TS('1996-06-01 00:00:00'), is_current
from dim_product where category='SMALL'""",
    "dim_bad_customer": """
select customer_sk*10 as customer_sk, customer_id, effective_date, end_date, is_current from dim_customer
union all
select o_orderkey*10+7, o_custkey, o_orderdate, case when o_orderpriority='5-LOW' then null
       else TS('1999-07-01 00:00:00') end, o_orderpriority='5-LOW'
from orders""",
    # orders with some returns booked as negative quantities, for the scorecard
    "erp_signed": """
select order_id, customer_id, product_id,
       case when region like 'a%' and quantity not like 'invalid' then concat('-', quantity) else quantity end as quantity,
       order_date, region, unit_price
from erp_raw""",
    # a narrow table with many equal rows, for the profile
    "narrow_sales": """
select store_id, quantity, cast(cast(timestamp as date) as string) as day from pos""",
}
