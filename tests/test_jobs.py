from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline import schemas
from bazaarline.ledger import Ledger
from bazaarline.operators import clean, quality
from bazaarline.plans import reports
from bazaarline.plans.medallion import run_medallion, run_replay
from bazaarline.plans.onboarding import onboard
from bazaarline.plans.warehouse import build_gold, load_warehouse
from bazaarline.sources import files, tables
from bazaarline.sources.incremental import MIN_MARK, Watermarks, load_incremental
from bazaarline.streaming import stream_bronze, stream_warehouse
from conftest import rows

CRM = ["customer_id,customer_name,segment,acquisition_channel,signup_date",
       "1, ann lee ,Retail,Social,2023-01-01", "2,bob,SMB,Organic,2023-01-05", "3,o'neil,,Referral,2023-02-01"] + [
    f"{i},name {i},SMB,Organic,2023-01-02" for i in range(10, 40)]
PRODUCTS = ["product_id,product_name,category,unit_price", "100,desk,office,20.5", "101,lamp, light ,5"]
ERP = ["order_id,customer_id,product_id,quantity,order_date,region,unit_price",
       "1,1,100,2,2023-03-01,north,20.5", "2,2,101,4,2023-03-02,south,5", "3,77,100,1,2023-03-03,east,20.5"]
POS = ["transaction_id,store_id,product_id,quantity,timestamp,sale_amount",
       "1,1,100,2,2023-03-01 10:00:00,41", "2,1,101,1,2023-03-01 11:00:00,5", "3,2,100,3,2023-03-04 09:00:00,61.5"]
INV = ["store_id,product_id,stock_level,reorder_point,last_restock_date", "1,100,10,5,2023-02-01", "2,100,2,5,2023-02-02"]
STORES = "store_id bigint, store_name string, city string, state string, region string"


def feed_dir(tmp_path, name="in", **override):
    base = tmp_path / name
    base.mkdir()
    feeds = {"crm_customers": CRM, "products": PRODUCTS, "erp_orders": ERP, "pos_transactions": POS, "inventory": INV}
    feeds.update(override)
    for feed, lines in feeds.items():
        (base / f"{feed}.csv").write_text("\n".join(lines) + "\n")
    return {feed: str(base / f"{feed}.csv") for feed in feeds}


def stores(spark):
    return spark.createDataFrame([(1, "Main", "X", "Y", "north"), (2, "Side", "X", "Y", "south")], STORES)


def snap(lake, name):
    return lake.snapshot(name, schemas.layout(name))


def fact(lake, name):
    return lake.facts(name, schemas.layout(name))


def test_medallion_run_twice_and_reports(spark, lake, tmp_path):
    loaded = run_medallion(spark, lake, feed_dir(tmp_path), "20240101-a", "2024-01-01", stores(spark))
    assert loaded == {"fact_sales": 3, "fact_orders": 3}
    results = Ledger(lake).table("data_quality_results")
    assert results.count() == 37 and results.filter("not passed").count() == 0
    assert rows(snap(lake, "dim_customer").filter("customer_id in (1, 3)"), "customer_name", "segment") == [
        ("O'Neil", "Uncategorized"), ("Ann Lee", "Retail")]
    sks = dict(rows(fact(lake, "fact_orders"), "order_id", "customer_sk"))
    assert sks[3] == 1 and 1 not in (sks[1], sks[2])
    assert Watermarks(lake).get("erp_orders") == datetime(2023, 3, 3)
    run = Ledger(lake).runs().first()
    assert (run.run_id, run.pipeline_status, run.rows_loaded) == ("20240101-a", "SUCCESS", 6)

    # second delivery: one new order, one repeated; a changed segment; nothing new elsewhere
    second = feed_dir(tmp_path, "two", erp_orders=ERP + ["4,1,100,5,2024-02-03,north,20.5", "4,1,100,9,2024-02-03,north,20.5"],
                      crm_customers=CRM[:1] + ["1,ann lee,SMB,Social,2024-01-15"])
    with pytest.raises(quality.QualityError):
        run_medallion(spark, lake, second, "20240201-bad", "2024-02-01", stores(spark))
    assert Watermarks(lake).get("erp_orders") == datetime(2023, 3, 3)
    failed = Ledger(lake).runs().filter("run_id = '20240201-bad'").first()
    assert failed.pipeline_status == "FAILED" and "order_id unique" in failed.error_message

    third = feed_dir(tmp_path, "three", erp_orders=ERP + ["4,1,100,5,2024-02-03,north,20.5"],
                     crm_customers=CRM[:1] + ["1,ann lee,SMB,Social,2024-01-15"])
    assert run_medallion(spark, lake, third, "20240201-c", "2024-02-01", stores(spark)) == {
        "fact_sales": 0, "fact_orders": 1}
    segments = rows(fact(lake, "fact_orders").join(snap(lake, "dim_customer"), "customer_sk").filter("customer_id = 1"),
                    "order_id", "segment")
    assert segments == [(1, "Retail"), (4, "SMB")]
    top = reports.report(lake, "top_customers").collect()
    assert [(r.customer_id, float(r.total_spent)) for r in top][:2] == [(1, 102.5), (1, 41.0)]
    assert reports.report(lake, "duplicate_facts").count() == 0
    assert tuple(reports.report(lake, "orphans").first()) == (0, 0, 0)
    assert rows(reports.report(lake, "low_stock"), "store_name", "product_name") == [("Side", "Desk")]
    gold = {r.customer_id: r for r in lake.read("gold", "customer_metrics").collect()}
    assert gold[1].total_revenue == 143.5 and gold[1].segment == "SMB" and gold[10].total_orders == 0
    for name in ("revenue_by_month", "revenue_by_region", "turnover_by_category", "segment_analytics",
                 "recent_lineage", "inventory_board"):
        assert reports.report(lake, name).count() > 0


def test_replay_registers_feeds(spark, lake, tmp_path):
    inputs = feed_dir(tmp_path)
    run_medallion(spark, lake, inputs, "20240101-a", "2024-01-01", stores(spark))
    assert run_replay(spark, lake, inputs, "20240102-r", "2024-01-02", stores(spark)) == {"fact_sales": 0, "fact_orders": 0}
    registry = rows(Ledger(lake).registry(), "dataset_name", "detected_type", "rows_count")
    assert ("erp_orders", "ERP", 3) in registry and len(registry) == 5
    assert reports.report(lake, "duplicate_facts").count() == 0


def test_onboarding_a_folder(spark, lake, tmp_path):
    up = tmp_path / "up"
    up.mkdir()
    (up / "crm users.csv").write_text("Cust_ID,fullname,tier,channel,signup\n" + "\n".join(
        f"{i},name {i},SMB,Web,2023-01-0{i}" for i in range(1, 6)) + "\n")
    (up / "product catalog.csv").write_text("sku,title,dept,price\n7,desk,office,3.5\n")
    (up / "My Notes-1.csv").write_text("foo,bar\n1,x\n")
    current = {r.dataset_name: r for r in onboard(spark, lake, str(up), "20240101-u", "2024-01-01").collect()}
    assert (current["crm users.csv"].detected_type, current["crm users.csv"].quality_score) == ("CRM", 100.0)
    assert current["product catalog.csv"].rows_count == 1
    assert (current["My Notes-1.csv"].detected_type, current["My Notes-1.csv"].last_run_id) == ("Unknown", "custom_import")
    assert rows(spark.table("custom_my_notes_1"), "foo", "bar") == [(1, "x")]
    assert rows(snap(lake, "dim_product"), "product_id", "product_name", "category") == [(7, "Desk", "Office")]
    assert snap(lake, "dim_customer").count() == 6
    assert rows(Ledger(lake).table("schema_history"), "dataset_name", "change_type") == [
        ("My Notes-1.csv", "INITIAL"), ("crm users.csv", "INITIAL"), ("product catalog.csv", "INITIAL")]
    (up / "My Notes-1.csv").write_text("foo,baz\n1,x\n")
    again = {r.dataset_name: r for r in onboard(spark, lake, str(up), "20240102-u", "2024-01-02").collect()}
    assert again["My Notes-1.csv"].schema_version == 2 and again["crm users.csv"].schema_version == 1
    assert Ledger(lake).lineage_latest("crm users.csv").first().source_dataset == "crm_customers"


def test_streams_equal_the_batch_result(spark, lake, tmp_path):
    from bazaarline.sources.lake import Lake

    src = tmp_path / "src"
    for feed, lines in (("crm_customers", CRM), ("products", PRODUCTS), ("erp_orders", ERP), ("pos_transactions", POS)):
        (src / feed).mkdir(parents=True)
        (src / feed / "one.csv").write_text("\n".join(lines) + "\n")

    def run(feed):
        stream_bronze(spark, str(src / feed), lake, feed, str(tmp_path / f"cb-{feed}")).awaitTermination(120)
        stream_warehouse(spark, lake, feed, str(tmp_path / f"cw-{feed}"), "2024-01-01").awaitTermination(120)

    for feed in ("crm_customers", "products", "erp_orders", "pos_transactions"):
        run(feed)
    batch = Lake(spark, f"file:{tmp_path / 'batch'}")
    run_medallion(spark, batch, {f: str(src / f / "one.csv") for f in ("crm_customers", "products", "erp_orders", "pos_transactions")},
                  "20240101-a", "2024-01-01")
    for name in ("fact_sales", "fact_orders"):
        assert rows(fact(lake, name)) == rows(fact(batch, name))
    for name in ("dim_customer", "dim_product"):
        assert rows(snap(lake, name)) == rows(snap(batch, name))

    # a later file: one old order, one new; each file is read once
    (src / "erp_orders" / "two.csv").write_text("\n".join([ERP[0], ERP[1], "9,2,101,1,2024-05-01,west,5"]) + "\n")
    run("erp_orders")
    assert [r[0] for r in rows(fact(lake, "fact_orders"), "order_id")] == [1, 2, 3, 9]
    assert lake.read("bronze", "erp_orders").count() == 5


def test_unknown_source_and_missing_data(spark, lake):
    assert lake.read("bronze", "nothing") is None
    assert clean.to_silver(lake, "nothing", "r") is None
    df = spark.createDataFrame([("a", None), ("a", None)], "x string, y string")
    lake.replace_partition(df, "bronze", "custom", "run_id", "r")
    clean.to_silver(lake, "custom", "r")
    assert rows(lake.read("silver", "custom"), "x", "y") == [("a", "Unknown")]
    assert load_warehouse(lake, "r", "2024-01-01") == {} and build_gold(lake) == {}


def test_incremental_scan(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, None)], "i int, t timestamp_ntz")
    fresh, mark = load_incremental(df, "t", datetime(2024, 1, 1))
    assert rows(fresh, "i") == [(2,)] and mark.first()[0] == datetime(2024, 1, 2)
    fresh, mark = load_incremental(df, "t", MIN_MARK)
    assert fresh.count() == 2
    nothing, mark = load_incremental(df, "t", datetime(2025, 1, 1))
    assert nothing.count() == 0 and mark.first()[0] == datetime(2025, 1, 1)
    assert load_incremental(df, None, None)[0].count() == 3


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, datetime(2024, 1, 1))], "i int, t timestamp_ntz").write.parquet(path)
    fresh, _ = load_incremental(spark.read.parquet(path), "t", datetime(2024, 1, 1))
    assert "GreaterThan(t" in fresh._jdf.queryExecution().executedPlan().toString()


def test_tables(spark, lake):
    spark.sql("create database if not exists shop")
    created = tables.bootstrap(spark, "shop")
    assert len(created) == len(schemas.WAREHOUSE) + len(schemas.LOGS) and tables.bootstrap(spark, "shop") == created
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tables.load_table(df, "shop.t") == 1 and tables.load_table(df, "shop.t") == 1
    assert tables.load_table(df.limit(0), "shop.t") == 0 and spark.table("shop.t").count() == 2
    assert tables.load_table(df, "shop.t", "replace") == 1 and spark.table("shop.t").count() == 1
    day = spark.sql("select date'2024-01-01' as date, 5.0D as daily_revenue, 1 as daily_transactions, 0.0D as revenue_growth_pct")
    lake.write(day, "gold", "sales_metrics")
    assert tables.publish_gold(lake, "shop") == {"sales_metrics": 1}
    assert tables.publish_gold(lake, "shop") == {"sales_metrics": 1}
    assert rows(spark.table("shop.gold_sales_metrics"), "daily_revenue", "daily_transactions") == [(5.0, 1)]
    facts = spark.range(50).select((F.col("id") % 5).cast("int").alias("date_id"), "id")
    tables.fact_writer(facts, "shop.f", sort_by="id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("shop.f").join(spark.table("shop.f").groupBy("date_id").count(), "date_id")
        assert joined.count() == 50
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quality_report_file(spark, tmp_path):
    results = quality.run_suite(spark.createDataFrame([(1,)], "id int"), "d", [quality.NotNull("id")])
    path = files.write_quality_report(results, str(tmp_path / "q"))
    got = spark.read.json(path).first()
    assert (got.dataset, got.expectation, got.passed, got.details) == ("d", "id not null", True, "Found 0 nulls")


def test_a_failed_snapshot_is_never_read(spark, lake, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    lake.publish(df, "d")
    (tmp_path / "lake" / "warehouse" / "d" / "v=2").mkdir()
    assert rows(lake.snapshot("d", df.schema)) == [(1,)]
    lake.publish(df.unionByName(df), "d")
    assert lake.snapshot("d", df.schema).count() == 2


def test_shared_tables_go_where_the_session_says(spark):
    from bazaarline.session import materialise

    out = materialise(spark.range(3), "probe")
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert out.count() == 3 and out.inputFiles()[0].replace("///", "/").startswith(named.replace("///", "/"))
