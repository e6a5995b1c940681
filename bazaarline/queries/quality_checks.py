"""Quality suites, scorecards and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.profile import profile, profile_counts
from ..operators.scorecard import scorecard
from .registry import query


def result(dataset: str, expectation: str, passed: str, details: str, source: str) -> str:
    return (f"select '{dataset}' as dataset, '{expectation}' as expectation, {passed} as passed, {details} as details "
            f"from {source}")


def nulls(dataset: str, view: str, col: str) -> str:
    n = f"count(*) filter (where {col} is null)"
    return result(dataset, f"{col} not null", f"{n}=0", f"printf('Found %d nulls', {n})", view)


def unique(dataset: str, view: str, cols: str, label: str) -> str:
    src = f"(select coalesce(sum(n-1), 0) as d from (select count(*) as n from {view} group by {cols}))"
    return result(dataset, f"{label} unique", "d=0", "printf('Found %d duplicates', cast(d as bigint))", src)


def between(dataset: str, view: str, col: str, lo: int, hi: int, value: str | None = None) -> str:
    v = value or col
    n = f"count(*) filter (where {v}<{lo} or {v}>{hi} or ({v} is null and {col} is not null))"
    return result(dataset, f"{col} between {lo} and {hi}", f"{n}=0", f"printf('Found %d out of range values', {n})", view)


def null_pct(dataset: str, view: str, col: str, limit: float = 0.05) -> str:
    n = f"count(*) filter (where {col} is null)"
    share = f"(case when count(*)>0 then cast({n} as double)/count(*) else 0 end)"
    return result(dataset, f"{col} null percent <= {limit * 100}%", f"{share}<={limit}",
                  f"printf('Actual null percent: %.2f%% (%d nulls)', {share}*100, {n})", view)


def dup_pct(dataset: str, view: str, col: str, limit: float) -> str:
    src = f"(select sum(n-1) as d, sum(n) as t from (select count(*) as n from {view} group by {col}))"
    return result(dataset, f"{col} duplicate percent <= {limit * 100}%", f"cast(d as double)/t<={limit}",
                  "printf('Actual duplicate percent: %.2f%% (%d duplicates)', cast(d as double)/t*100, cast(d as bigint))", src)


def schema_ok(dataset: str) -> str:
    return f"select '{dataset}' as dataset, 'schema matches expected columns' as expectation, true as passed, '' as details"


def union(*parts: str) -> str:
    return "\nunion all ".join(parts)


def number(col: str) -> str:
    return (rf"case when regexp_full_match({col}, '\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*') "
            f"then cast({col} as double) end")


@query("dq01_not_null", union(nulls("erp", "erp_raw", "region"), nulls("erp", "erp_raw", "order_id")))
def dq01(feeds):
    return q.run_suite(feeds.view("erp_raw"), "erp", [q.NotNull("region"), q.NotNull("order_id")])


@query("dq02_unique", union(unique("inventory", "inventory_bad_ids", "store_id, product_id", "composite_key"),
                            unique("inventory", "inventory_bad_ids", "store_id", "store_id")))
def dq02(feeds):
    return q.run_suite(feeds.view("inventory_bad_ids"), "inventory", [
        q.Unique(("store_id", "product_id"), "composite_key"), q.Unique(("store_id",))])


@query("dq03_between", union(between("pos", "pos_raw", "quantity", 5, 45),
                             between("erp", "erp_raw", "unit_price", 0, 10000, number("unit_price"))))
def dq03(feeds):
    return q.run_suite(feeds.view("pos_raw"), "pos", [q.Between("quantity", 5, 45)]).unionByName(
        q.run_suite(feeds.view("erp_raw"), "erp", [q.Between("unit_price", 0, 10000)]))


@query("dq04_null_share", union(null_pct("erp", "erp_raw", "region"), null_pct("erp", "erp_raw", "quantity")))
def dq04(feeds):
    return q.run_suite(feeds.view("erp_raw"), "erp", [q.NullPct("region", 0.05), q.NullPct("quantity", 0.05)])


@query("dq05_duplicate_share", union(dup_pct("pos", "pos", "transaction_id", 0.5), dup_pct("pos", "pos", "store_id", 0.5)))
def dq05(feeds):
    return q.run_suite(feeds.view("pos"), "pos", [q.DupPct(("transaction_id",), 0.5), q.DupPct(("store_id",), 0.5)])


@query("dq06_columns", union(
    "select 'pos' as dataset, 'schema matches expected columns' as expectation, false as passed, "
    "'Missing columns: [''customer_id'']' as details from (select count(*) from pos)",
    "select 'pos', 'store_id exists', true, '' from (select count(*) from pos)",
    "select 'pos', 'cashier exists', false, 'Column missing' from (select count(*) from pos)"))
def dq06(feeds):
    return q.run_suite(feeds.view("pos"), "pos", [
        q.HasColumns(("transaction_id", "customer_id")), q.HasColumn("store_id"), q.HasColumn("cashier")])


@query("dq08_medallion_suite", union(
    schema_ok("crm_customers"), nulls("crm_customers", "crm", "customer_id"),
    unique("crm_customers", "crm", "customer_id", "customer_id"),
    *[null_pct("crm_customers", "crm", c) for c in ("customer_name", "segment", "acquisition_channel", "signup_date")],
    schema_ok("products"), nulls("products", "products", "product_id"),
    unique("products", "products", "product_id", "product_id"),
    *[null_pct("products", "products", c) for c in ("product_name", "category", "unit_price")],
    between("products", "products", "unit_price", 0, 10000),
    schema_ok("erp_orders"), nulls("erp_orders", "erp_raw", "order_id"),
    unique("erp_orders", "erp_raw", "order_id", "order_id"),
    *[null_pct("erp_orders", "erp_raw", c) for c in ("quantity", "order_date", "region", "unit_price")],
    between("erp_orders", "erp_raw", "quantity", 0, 1000, number("quantity")),
    schema_ok("pos_transactions"), nulls("pos_transactions", "pos", "transaction_id"),
    unique("pos_transactions", "pos", "transaction_id", "transaction_id"),
    *[null_pct("pos_transactions", "pos", c) for c in ("quantity", "timestamp", "sale_amount")],
    between("pos_transactions", "pos", "sale_amount", 0, 100000),
    schema_ok("inventory"), nulls("inventory", "inventory", "store_id"), nulls("inventory", "inventory", "product_id"),
    unique("inventory", "inventory", "store_id, product_id", "composite_key"),
    *[null_pct("inventory", "inventory", c) for c in ("stock_level", "reorder_point", "last_restock_date")],
    between("inventory", "inventory", "stock_level", 0, 100000)))
def dq08(feeds):
    return q.run_suites({
        "crm_customers": feeds.view("crm"), "products": feeds.view("products"),
        "erp_orders": feeds.view("erp_raw").drop("ord1", "ord2", "ord3"),
        "pos_transactions": feeds.view("pos"), "inventory": feeds.view("inventory").drop("ord1")})


@query("dq09_short_suite", union(
    nulls("crm_customers", "crm_raw", "customer_id"), unique("crm_customers", "crm_raw", "customer_id", "customer_id"),
    nulls("pos_transactions", "pos", "transaction_id"),
    unique("pos_transactions", "pos", "transaction_id", "transaction_id"),
    nulls("inventory", "inventory_bad_ids", "store_id"), nulls("inventory", "inventory_bad_ids", "product_id")))
def dq09(feeds):
    return q.run_suites({"crm_customers": feeds.view("crm_raw"), "pos_transactions": feeds.view("pos"),
                         "inventory": feeds.view("inventory_bad_ids")}, short=True)


# -- scorecards ------------------------------------------------------------------------------

def _flat(df):
    return df.select("completeness", "validity", "uniqueness", "consistency", "quality_score", "overall_score",
                     F.array_join(F.transform("deductions", lambda d: d["reason"]), " | ").alias("reasons"))


def date_ok(col: str) -> str:
    return f"coalesce(try_strptime({col}, '%m/%d/%Y'), try_cast({col} as timestamp))"


ERP_SCORE = f"""
with c as (select count(*) as n,
  count(*) filter (where region is null) as nr, count(*) filter (where quantity is null) as nq,
  count(*) filter (where unit_price is null) as np,
  count(*) filter (where quantity is not null and ({number('quantity')}) is null) as bq,
  count(*) filter (where unit_price is not null and ({number('unit_price')}) is null) as bp,
  count(*) filter (where ({number('quantity')})<0) as gq from erp_signed),
d as (select cast(sum(k-1) as bigint) as dup from (select count(*) as k from erp_signed group by order_id)),
s as (select cast(trunc((1.0::double-(nr+nq+np)::double/(n*7))*100) as int) as completeness,
  greatest(0, cast(trunc((1.0::double-(bq+bp)::double/(n*5))*100) as int)) as validity,
  case when dup>0 then greatest(0, cast(trunc((1.0::double-dup::double/n)*100) as int)) else 100 end as uniqueness,
  greatest(0, cast(trunc((1.0::double-gq::double/n)*100) as int)) as consistency, c.*, d.* from c, d)
select completeness, validity, uniqueness, consistency,
  greatest(0, 100-3*((nq>0)::int+(nr>0)::int+(np>0)::int)-12*(dup>0)::int-5*((bq>0)::int+(bp>0)::int)-10*(gq>0)::int)::double
    as quality_score,
  round_even(completeness*0.3::double+validity*0.3::double+uniqueness*0.2::double+consistency*0.2::double, 1) as overall_score,
  concat_ws(' | ', case when nq>0 then printf('Missing values: %d nulls found in ''quantity''.', nq) end,
    case when nr>0 then printf('Missing values: %d nulls found in ''region''.', nr) end,
    case when np>0 then printf('Missing values: %d nulls found in ''unit_price''.', np) end,
    case when dup>0 then printf('Duplicate primary keys: %d duplicate IDs found in ''order_id''.', dup) end,
    case when bq>0 then printf('Invalid numeric formatting: %d values could not be parsed as numeric in ''quantity''.', bq) end,
    case when bp>0 then printf('Invalid numeric formatting: %d values could not be parsed as numeric in ''unit_price''.', bp) end,
    case when gq>0 then printf('Negative business bounds violated: %d negative value(s) in field ''quantity''.', gq) end) as reasons
from s"""


@query("dq11_scorecard_orders", ERP_SCORE)
def dq11(feeds):
    fields = ["order_id", "customer_id", "product_id", "quantity", "order_date", "region", "unit_price"]
    return _flat(scorecard(feeds.view("erp_signed"), "ERP", {f: f for f in fields}))


@query("dq12_scorecard_inventory", f"""
with c as (select count(*) as n, count(*) filter (where store_id is null) as ns,
  count(*) filter (where store_id is not null and ({number('store_id')}) is null) as bs from inventory_bad_ids),
d as (select cast(sum(k-1) as bigint) as dup from (select count(*) as k from inventory_bad_ids group by store_id, product_id)),
s as (select cast(trunc((1.0::double-ns::double/(n*5))*100) as int) as completeness,
  greatest(0, cast(trunc((1.0::double-bs::double/(n*5))*100) as int)) as validity,
  case when dup>0 then greatest(0, cast(trunc((1.0::double-dup::double/n)*100) as int)) else 100 end as uniqueness,
  100 as consistency, c.*, d.* from c, d)
select completeness, validity, uniqueness, consistency,
  greatest(0, 100-3*(ns>0)::int-10*(dup>0)::int-5*(bs>0)::int)::double as quality_score,
  round_even(completeness*0.3::double+validity*0.3::double+uniqueness*0.2::double+consistency*0.2::double, 1) as overall_score,
  concat_ws(' | ', case when ns>0 then printf('Missing values: %d nulls found in ''store_id''.', ns) end,
    case when dup>0 then printf('Duplicate inventory composite keys: %d matching store-product duplicates found.', dup) end,
    case when bs>0 then printf('Invalid numeric formatting: %d values could not be parsed as numeric in ''store_id''.', bs) end)
    as reasons
from s""")
def dq12(feeds):
    fields = ["store_id", "product_id", "stock_level", "reorder_point", "last_restock_date"]
    return _flat(scorecard(feeds.view("inventory_bad_ids"), "Inventory", {f: f for f in fields}))


# -- profiles ----------------------------------------------------------------------------------

@query("onb01_profile", """
with c as (select count(*) as n, count(*) filter (where region is null)+count(*) filter (where quantity is null)
  +count(*) filter (where unit_price is null) as nulls from erp_raw),
d as (select cast(sum(k-1) as bigint) as dup from (select *, count(*) as k from erp_raw group by all))
select n as rows, 10 as columns, round_even(nulls::double/(n*10)*100, 2) as null_rate,
  round_even(dup::double/n*100, 2) as dup_rate, 'order_id,customer_id,product_id,ord2,ord3' as numeric_fields,
  'order_date,ord1' as date_fields, 'quantity,region,unit_price' as categorical_fields from c, d""")
def onb01(feeds):
    out = profile(feeds.view("erp_raw"))
    return out.drop("schema_definition").withColumns(
        {c: F.array_join(c, ",") for c in ("numeric_fields", "date_fields", "categorical_fields")})


@query("onb01_profile_counts", """
with c as (select count(*) as n from narrow_sales),
d as (select cast(sum(k-1) as bigint) as dup from (select *, count(*) as k from narrow_sales group by all))
select n as rows, 3 as columns, 0.0::double as null_rate, round_even(dup::double/n*100, 2) as dup_rate,
  2 as numeric_count, 1 as date_count, 0 as categorical_count from c, d""")
def onb01_counts(feeds):
    return profile_counts(feeds.view("narrow_sales")).drop("schema_definition")
