"""Gold metrics, dashboard figures and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold
from ..operators.rows import pct_change
from ..plans import reports
from .registry import query

MONEY = "cast({0} as double)"


def _rounded(df, *cols):
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


@query("agg01_customer_metrics", """
select customer_id, customer_name, segment, acquisition_channel, signup_date, cast(total_revenue as double) as total_revenue,
       total_orders, average_order_value from o_customer_metrics""")
def customer_metrics(feeds):
    return feeds.customer_metrics().withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("jn01_left_join_revenue", """
select c.customer_id, c.segment, cast(r.total_revenue as double) as total_revenue, r.total_orders
from crm c left join o_customer_revenue r on c.customer_id=r.customer_id""")
def left_revenue(feeds):
    return feeds.view("crm").join(gold.customer_revenue(feeds.erp()), "customer_id", "left").select(
        "customer_id", "segment", F.col("total_revenue").cast("double").alias("total_revenue"), "total_orders")


@query("jn02_left_join_units", """
select i.store_id, i.product_id, i.stock_level, u.total_qty_sold
from o_inv i left join (select store_id, product_id, cast(sum(quantity) as bigint) as total_qty_sold from o_pos
                        where sale_amount>60000 group by 1, 2) u
  on i.store_id=u.store_id and i.product_id=u.product_id""")
def left_units(feeds):
    sold = gold.units_sold(feeds.pos().filter("sale_amount > 60000"))
    return feeds.inventory().join(sold, ["store_id", "product_id"], "left").select(
        "store_id", "product_id", "stock_level", "total_qty_sold")


@query("agg02_sales_metrics", """
select date, cast(daily_revenue as double) as daily_revenue, daily_transactions,
       round(revenue_growth_pct, 6) as revenue_growth_pct from o_sales_metrics""")
def sales_metrics(feeds):
    out = feeds.sales_metrics().withColumn("daily_revenue", F.col("daily_revenue").cast("double"))
    return _rounded(out, "revenue_growth_pct")


@query("win01_growth_with_gaps", """
select day, v, case when p is null or (p=0 and v=0) then 0.0 when p=0 then sign(v)*cast('inf' as double)
                    else round((cast(v as double)/p-1)*100, 6) end as growth
from (select day, v, lag(v) over (order by day) as p from (
  select cast(ts as date) as day, cast(sum(case when day(ts)%3=0 then 0 else event_id%100 end) as bigint) as v from events group by 1))""")
def growth(feeds):
    daily = feeds.sql("""select cast(ts as date) as day,
        sum(case when day(ts)%3=0 then 0 else event_id%100 end) as v from events group by 1""")
    return _rounded(pct_change(daily, "day", "v", "growth"), "growth")


@query("agg03_units_sold", "select * from o_units")
def units(feeds):
    return gold.units_sold(feeds.pos())


@query("agg04_active_days", "select cast(days as int) as active_days from o_days")
def days(feeds):
    return gold.active_days(feeds.pos())


@query("agg05_inventory_metrics", """
select store_id, product_id, stock_level, reorder_point, stock_turnover, inventory_velocity,
       days_inventory_outstanding, low_stock_alert from o_inventory_metrics""")
def inventory_metrics(feeds):
    return feeds.inventory_metrics()


@query("agg11_kpi_sales", """
select cast(sum(daily_revenue) as double) as total_revenue, cast(sum(daily_transactions) as bigint) as total_transactions,
       round(avg(revenue_growth_pct), 6) as avg_growth_pct, round(cast(sum(daily_revenue) as double)/30, 6) as avg_daily_revenue
from (select * from o_sales_metrics order by date desc limit 30)""")
def kpi_sales(feeds):
    out = gold.kpi_sales(feeds.sales_metrics())
    return _rounded(out.withColumn("total_revenue", F.col("total_revenue").cast("double")),
                    "avg_growth_pct", "avg_daily_revenue")


@query("agg12_kpi_customers", """
select round(avg(cast(total_revenue as double)), 6) as avg_ltv, round(avg(average_order_value), 6) as avg_aov,
       count(*) as total_customers from o_customer_metrics""")
def kpi_customers(feeds):
    return _rounded(gold.kpi_customers(feeds.customer_metrics()), "avg_ltv", "avg_aov")


@query("agg12_kpi_all_customers", """
select round(avg(cast(total_revenue as double)), 6) as avg_ltv, round(avg(average_order_value), 6) as avg_aov,
       count(*) as total_customers from o_customer_metrics""")
def kpi_all_customers(feeds):
    return _rounded(gold.kpi_customers(feeds.customer_metrics(), rows=None), "avg_ltv", "avg_aov")


@query("agg13_customers_per_segment", "select segment, count(*) as customers from o_customer_metrics group by segment")
def segments(feeds):
    return gold.segment_counts(feeds.customer_metrics())


KPI_INV = """
select round(avg(stock_turnover), 6) as avg_turnover, round(avg(inventory_velocity), 6) as avg_velocity,
       round(coalesce(avg(case when days_inventory_outstanding<999 then days_inventory_outstanding end), 0), 6) as avg_dio,
       count(*) filter (where low_stock_alert) as low_stock_count from o_inventory_metrics"""


@query("agg14_kpi_inventory", KPI_INV)
def kpi_inventory(feeds):
    return _rounded(gold.kpi_inventory(feeds.inventory_metrics()), "avg_turnover", "avg_velocity", "avg_dio")


@query("agg15_stock_by_category", """
select p.category, cast(sum(i.stock_level) as bigint) as stock_level
from o_inv i join dim_product p on i.product_id=p.product_id and p.is_current group by p.category""")
def stock_category(feeds):
    board = reports.inventory_board(feeds.inventory_metrics(), feeds.view("stores"), feeds.view("dim_product"))
    return gold.stock_by_category(board)


# -- the named reports -----------------------------------------------------------------

TOP = """
select customer_id, customer_name, segment, cast(total_spent as double) as total_spent from (
  select c.customer_id, c.customer_name, c.segment, sum(f.total_amount) as total_spent
  from o_fact_orders f join dim_customer c on f.customer_sk=c.customer_sk group by 1, 2, 3
  order by total_spent desc, c.customer_id, c.segment limit 10)"""


@query("agg06_top_customers", TOP)
def agg_top(feeds):
    return rpt_top(feeds)


@query("rpt01_top_customers", TOP)
def rpt_top(feeds):
    out = reports.top_customers(feeds.fact_orders(), feeds.view("dim_customer"))
    return out.withColumn("total_spent", F.col("total_spent").cast("double"))


MONTHS = """
select d.year, d.month, cast(sum(f.sale_amount) as double) as sales_revenue
from o_fact_sales f join o_calendar d on f.date_id=d.date_id group by 1, 2"""


@query("agg07_revenue_by_month", MONTHS)
def agg_month(feeds):
    return rpt_month(feeds)


@query("rpt02_revenue_by_month", MONTHS)
def rpt_month(feeds):
    out = reports.revenue_by_month(feeds.fact_sales(), feeds.calendar())
    return out.withColumn("sales_revenue", F.col("sales_revenue").cast("double"))


REGIONS = "select region, cast(sum(total_amount) as double) as total_revenue from o_fact_orders group by region"


@query("agg08_revenue_by_region", REGIONS)
def agg_region(feeds):
    return rpt_region(feeds)


@query("rpt03_revenue_by_region", REGIONS)
def rpt_region(feeds):
    out = reports.revenue_by_region(feeds.fact_orders())
    return out.withColumn("total_revenue", F.col("total_revenue").cast("double"))


TURNOVER = """
select p.category, round(avg(i.stock_turnover), 6) as avg_turnover_rate,
       round(avg(i.days_inventory_outstanding), 6) as avg_dio
from o_inventory_metrics i join dim_product p on i.product_id=p.product_id and p.is_current group by 1"""


@query("agg09_turnover_by_category", TURNOVER)
def agg_turnover(feeds):
    return rpt_turnover(feeds)


@query("rpt04_turnover_by_category", TURNOVER)
def rpt_turnover(feeds):
    out = reports.turnover_by_category(feeds.inventory_metrics(), feeds.view("dim_product"))
    return _rounded(out, "avg_turnover_rate", "avg_dio")


SEGMENTS = """
select segment, count(distinct customer_id) as total_customers, cast(sum(total_revenue) as double) as total_spend
from o_customer_metrics group by segment"""


@query("agg10_segment_analytics", SEGMENTS)
def agg_segment(feeds):
    return rpt_segment(feeds)


@query("rpt05_segment_analytics", SEGMENTS)
def rpt_segment(feeds):
    out = reports.segment_analytics(feeds.customer_metrics())
    return out.withColumn("total_spend", F.col("total_spend").cast("double"))


@query("rpt10_inventory_board", """
select i.store_id, s.store_name, s.region, i.product_id, p.product_name, p.category, i.stock_level, i.reorder_point,
       i.stock_turnover, i.inventory_velocity, i.days_inventory_outstanding, i.low_stock_alert
from o_inventory_metrics i join stores s on i.store_id=s.store_id
     join dim_product p on i.product_id=p.product_id and p.is_current""")
def board(feeds):
    return reports.inventory_board(feeds.inventory_metrics(), feeds.view("stores"), feeds.view("dim_product"))


@query("rpt11_low_stock", """
select s.store_name, p.product_name, p.category, i.stock_level, i.reorder_point
from o_inventory_metrics i join stores s on i.store_id=s.store_id
     join dim_product p on i.product_id=p.product_id and p.is_current where i.low_stock_alert""")
def low_stock(feeds):
    return reports.low_stock(board(feeds))


@query("rpt12_sales_dashboard", """
select date, cast(daily_revenue as double) as daily_revenue, daily_transactions
from o_sales_metrics order by date desc limit 30""")
def sales_board(feeds):
    return gold.last_days(feeds.sales_metrics()).select(
        "date", F.col("daily_revenue").cast("double").alias("daily_revenue"), "daily_transactions")


@query("rpt12_customer_scatter", """
select total_orders, cast(total_revenue as double) as total_revenue, segment
from o_customer_metrics""")
def customer_scatter(feeds):
    return gold.first_customers(feeds.customer_metrics()).select(
        "total_orders", F.col("total_revenue").cast("double").alias("total_revenue"), "segment")


@query("rpt12_stock_scatter", """
select i.stock_level, i.stock_turnover, p.category, p.product_name
from o_inventory_metrics i join stores s on i.store_id=s.store_id
     join dim_product p on i.product_id=p.product_id and p.is_current""")
def stock_scatter(feeds):
    return board(feeds).select("stock_level", "stock_turnover", "category", "product_name")
