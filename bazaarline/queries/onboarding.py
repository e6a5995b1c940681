"""Classification, mapping, dependencies, schema versions and the registry over many uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import onboard
from ..operators.templates import KEYWORDS, TEMPLATES
from .registry import query
from .sources import EDGES

SYN = ",".join(
    f"('{t}',{tr},{len(fields)},'{f}',{fr},'{s}',{sr})"
    for tr, (t, fields) in enumerate(TEMPLATES.items())
    for fr, (f, (_, syns)) in enumerate(fields.items()) for sr, s in enumerate(syns))
KEY = ",".join(f"('{t}','{w}')" for t, words in KEYWORDS.items() for w in words)

SCORES = f"""
syn(type, type_rank, size, field, field_rank, synonym, syn_rank) as (values {SYN}),
kw(type, word) as (values {KEY}),
ds as (select distinct dataset, filename from uploads),
types as (select distinct type, type_rank, size from syn),
hits as (select u.dataset, s.type, count(distinct s.field) as matched from uploads u
         join syn s on trim(lower(u.column_name))=s.synonym group by 1, 2),
scored as (select d.dataset, d.filename, t.type, t.type_rank, coalesce(h.matched, 0) as matched,
  cast(trunc((coalesce(h.matched,0)::double/t.size*0.65::double
    + case when exists (select 1 from kw where kw.type=t.type and contains(lower(d.filename), kw.word)) then 0.35::double else 0.0::double end)
    *100) as int) as score
  from ds d cross join types t left join hits h on h.dataset=d.dataset and h.type=t.type),
ranked as (select *, row_number() over (partition by dataset order by score desc, type_rank) as rn from scored)"""


def _headers(feeds):
    return feeds.view("uploads").withColumnRenamed("column_name", "column")


@query("onb02_scores", f"with {SCORES} select dataset, type, cast(matched as int) as matched, score from scored")
def onb02_scores(feeds):
    return onboard.scores(_headers(feeds)).select("dataset", "type", "matched", "score")


@query("onb02_classify", f"""with {SCORES}
select dataset, filename, case when score>=70 then type else 'Unknown' end as detected_type, score as confidence_score,
       case when score>=90 then 'Auto-Classified' else 'Needs Review' end as status,
       (select coalesce(string_agg(concat(o.type, ':', o.score), ',' order by o.rn), '') from ranked o
        where o.dataset=r.dataset and o.rn>1 and o.score>0) as alternatives
from ranked r where rn=1""")
def onb02(feeds):
    alternatives = F.array_join(F.transform(
        "alternatives", lambda a: F.concat(a["type"], F.lit(":"), a["score"].cast("string"))), ",")
    return onboard.classify(_headers(feeds)).withColumn("alternatives", alternatives).drop("matched_signals")


@query("onb02b_classify_legacy", f"""with {SCORES}
select dataset, case when score>=30 then type else 'Unknown' end as detected_type,
       case when score>=30 then score else 0 end as confidence_score from ranked where rn=1""")
def onb02b(feeds):
    return onboard.classify_legacy(_headers(feeds))


def _typed(feeds):
    """Every upload with the template its file name points to."""
    kind = F.when(F.col("filename").startswith("customer"), "CRM") \
        .when(F.col("filename").startswith("pos"), "POS").otherwise("Products")
    return _headers(feeds).withColumn("type", kind)


MAPPED = f"""
syn(type, type_rank, size, field, field_rank, synonym, syn_rank) as (values {SYN}),
typed as (select dataset, position, column_name, case when filename like 'customer%' then 'CRM'
  when filename like 'pos%' then 'POS' else 'Products' end as type from uploads),
targets as (select type, field, field as synonym, -1 as syn_rank from syn union select type, field, synonym, syn_rank from syn),
best as (select t.dataset, t.type, g.field, t.column_name, g.syn_rank, row_number() over (
    partition by t.dataset, t.type, g.field order by g.syn_rank, t.position, t.column_name) as rn
  from typed t join targets g on g.type=t.type and trim(lower(t.column_name))=g.synonym)"""


@query("onb03_map_columns", f"""with {MAPPED}
select w.dataset, w.type, f.field, b.column_name as column_name,
       case when b.syn_rank is null then null when b.syn_rank<0 then 'exact' else 'synonym' end as how
from (select distinct dataset, type from typed) w join (select distinct type, field from syn) f on f.type=w.type
left join best b on b.dataset=w.dataset and b.type=w.type and b.field=f.field and b.rn=1""")
def onb03(feeds):
    return onboard.map_columns(_typed(feeds), fuzzy=False).withColumnRenamed("column", "column_name")


@query("onb03_map_columns_fuzzy")
def onb03_fuzzy(feeds):
    return onboard.map_columns(_typed(feeds)).withColumnRenamed("column", "column_name")


@query("onb04_missing_dependencies", f"""
select distinct u.tenant, u.type, e.required from typed_uploads u join {EDGES} on u.type=e.type
where u.seen_at>=TS('1999-01-01 00:00:00') and not exists (
  select 1 from typed_uploads a where a.tenant=u.tenant and a.type=e.required)""")
def onb04(feeds):
    uploads = feeds.view("typed_uploads")
    staged = uploads.filter("seen_at >= timestamp_ntz'1999-01-01'")
    registry = uploads.filter("seen_at < timestamp_ntz'1999-01-01'")
    return onboard.missing_dependencies(staged, registry, by=["tenant"]).drop("impact")


@query("onb05_impact", """
select cast(u.upload as varchar) as dataset, u.type, count(*) as projected_rows,
  case u.type when 'CRM' then 'gold_customer_metrics' when 'Inventory' then 'gold_inventory_metrics'
       when 'Products' then 'All Fact Tables & Metrics' else 'gold_sales_metrics' end as gold_table
from typed_uploads u join lineitem on l_orderkey=u.upload group by 1, 2""")
def onb05(feeds):
    lines = feeds.table("lineitem").groupBy(F.col("l_orderkey").alias("upload")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = feeds.view("typed_uploads").join(lines, "upload").select(
        F.col("upload").cast("string").alias("dataset"), "type", "rows")
    return onboard.impact(sizes).select("dataset", "type", "projected_rows", "gold_table")


SCHEMAS = """
sets as (select o_custkey as dataset_name, o_orderdate, o_orderkey,
    list_sort(list(distinct case l_linenumber%5 when 0 then 'id' when 1 then 'name' when 2 then 'tier' when 3 then 'price' else 'qty' end)) as cols
  from orders join lineitem on l_orderkey=o_orderkey group by 1, 2, 3),
firsts as (select dataset_name, arg_min(cols, (o_orderdate, o_orderkey)) as cols from sets
           where o_orderdate<TS('1998-01-01 00:00:00') group by 1),
lasts as (select dataset_name, arg_max(cols, (o_orderdate, o_orderkey)) as cols from sets
          where o_orderdate>=TS('1998-01-01 00:00:00') group by 1)"""


def _schemas(feeds):
    name = F.expr("case l_linenumber%5 when 0 then 'id' when 1 then 'name' when 2 then 'tier' when 3 then 'price' "
                  "else 'qty' end")
    uploads = feeds.table("orders").join(feeds.table("lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("dataset_name"), "o_orderdate", "o_orderkey").agg(
        F.array_sort(F.collect_set(name)).alias("columns"))
    cut = "timestamp_ntz'1998-01-01'"
    order = F.struct("o_orderdate", "o_orderkey")
    history = uploads.filter(f"o_orderdate < {cut}").groupBy("dataset_name").agg(
        F.min_by("columns", order).alias("columns")).withColumn("schema_version", F.lit(1))
    incoming = uploads.filter(f"o_orderdate >= {cut}").groupBy("dataset_name").agg(
        F.max_by("columns", order).alias("columns"))
    return history, incoming


@query("onb06_schema_versions", f"""with {SCHEMAS}
select n.dataset_name,
  case when o.cols is null then 'INITIAL'
       when len(list_filter(n.cols, lambda x: not list_contains(o.cols, x)))>0 and len(list_filter(o.cols, lambda x: not list_contains(n.cols, x)))>0 then 'CHANGED'
       when len(list_filter(n.cols, lambda x: not list_contains(o.cols, x)))>0 then 'ADDED'
       when len(list_filter(o.cols, lambda x: not list_contains(n.cols, x)))>0 then 'REMOVED' else 'NONE' end as change_type,
  case when o.cols is null or n.cols=o.cols then 1 else 2 end as schema_version,
  array_to_string(n.cols, ',') as columns
from lasts n left join firsts o on n.dataset_name=o.dataset_name""")
def onb06(feeds):
    history, incoming = _schemas(feeds)
    return onboard.track_schema(history, incoming).select(
        "dataset_name", "change_type", "schema_version", F.array_join("columns", ",").alias("columns"))


@query("onb07_registry_current", """
select dataset_name, detected_type, rows_count, upload_timestamp from (
  select cast(tenant as varchar) as dataset_name, type as detected_type, upload as rows_count, seen_at as upload_timestamp,
         row_number() over (partition by tenant order by seen_at desc, upload desc) as rn from typed_uploads) where rn=1""")
def onb07(feeds):
    log = feeds.view("typed_uploads").select(
        F.col("tenant").cast("string").alias("dataset_name"), F.col("type").alias("detected_type"),
        F.col("upload").alias("rows_count"), F.col("seen_at").alias("upload_timestamp"))
    return onboard.registry_current(log, ["upload_timestamp", "rows_count"])
