"""Files and runs that once lost or mixed data: header orders, torn lines, old uploads, load order, markers."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline import schemas
from bazaarline.ledger import Ledger
from bazaarline.operators import clean, quality
from bazaarline.operators.keys import assign_sk
from bazaarline.operators.profile import profile
from bazaarline.operators.scd import overlap_pairs
from bazaarline.plans.medallion import run_medallion
from bazaarline.plans.onboarding import onboard
from bazaarline.sources.files import read_source
from bazaarline.sources.incremental import Watermarks
from bazaarline.streaming import stream_bronze, stream_warehouse
from conftest import rows
from test_jobs import ERP, POS, PRODUCTS, feed_dir, stores


def test_columns_by_name_in_every_file(spark, lake, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("product_id,product_name,category,unit_price\n1,Kite,Toys,2.0\n")
    (src / "b c.csv").write_text("category,product_id,product_name,unit_price\nGames,7,Ball,3.0\n5,Car\n")
    got = read_source(spark, str(src), schemas.layout("products"), typed=True)
    assert rows(got.where("_corrupt_record is null"), "product_id", "product_name", "category") == [
        (1, "Kite", "Toys"), (7, "Ball", "Games")]
    assert rows(got.where("_corrupt_record is not null"), "_corrupt_record", "product_name") == [("5,Car", None)]
    stream_bronze(spark, str(src / "*.csv"), lake, "products", str(tmp_path / "cp")).awaitTermination(120)
    assert rows(lake.read("bronze", "products"), "product_id", "product_name", "category") == [
        ("1", "Kite", "Toys"), ("7", "Ball", "Games")]
    assert lake.read("quarantine", "products").count() == 1


def test_torn_lines_and_bad_ids_stop_the_run(spark, lake, tmp_path):
    torn = feed_dir(tmp_path, "torn", products=[*PRODUCTS, "2,Kite", "3,Car,Toys,2.0,extra,cells"])
    with pytest.raises(quality.QualityError, match="no malformed line: Found 2"):
        run_medallion(spark, lake, torn, "20240101-a", "2024-01-01", stores(spark))
    run = Ledger(lake).runs().first()
    assert (run.rows_failed, run.pipeline_status) == (2, "FAILED")
    assert lake.read("quarantine", "products").count() == 2 and len(run.error_message) < 4000
    bad = feed_dir(tmp_path, "bad", erp_orders=[*ERP, "x7,1,100,1,2023-03-05,north,1", "8,1,100,1,,north,1"])
    with pytest.raises(quality.QualityError, match="order_id is a number"):
        run_medallion(spark, lake, bad, "20240101-b", "2024-01-01", stores(spark))
    assert Ledger(lake).runs().where("run_id = '20240101-b'").first().rows_failed == 1  # the undated order


def test_uploads_older_than_the_mark_arrive(spark, lake, tmp_path):
    run_medallion(spark, lake, feed_dir(tmp_path), "20240101-a", "2024-01-01", stores(spark))
    up = tmp_path / "up"
    up.mkdir()
    (up / "pos_one.csv").write_text("\n".join([POS[0], "11,1,100,1,2022-01-05 10:00:00,7", "12,1,100,1,2022-01-06 10:00:00,7"]) + "\n")
    (up / "pos_two.csv").write_text("\n".join([POS[0], "13,2,101,1,2022-02-05 10:00:00,7"]) + "\n")
    registry = {r.dataset_name: r for r in onboard(spark, lake, str(up), "20240102-u", "2024-01-02").collect()}
    assert {k: (r.status, r.rows_count) for k, r in registry.items()} == {
        "pos_one.csv": ("Completed", 2), "pos_two.csv": ("Completed", 1)}
    assert rows(lake.facts("fact_sales", schemas.layout("fact_sales")), "transaction_id") == [(i,) for i in (1, 11, 12, 13, 2, 3)]
    assert Watermarks(lake).get("pos_transactions") == datetime(2023, 3, 4, 9)
    for name in registry:
        assert Ledger(lake).lineage_latest(name).first().source_dataset == "pos_transactions"


def test_the_later_load_wins_whatever_its_name(spark, lake, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "one.csv").write_text("\n".join(POS[:2]) + "\n")
    stream_bronze(spark, str(src / "*.csv"), lake, "pos_transactions", str(tmp_path / "a")).awaitTermination(120)
    stream_warehouse(spark, lake, "pos_transactions", str(tmp_path / "b"), "2024-01-01").awaitTermination(120)
    later = spark.createDataFrame([(1, 1, 100, 2, datetime(2023, 3, 1, 10), 99.0)],
                                  "transaction_id long, store_id long, product_id long, quantity long, timestamp timestamp_ntz, sale_amount double")
    clean.write_silver(lake, later, "pos_transactions", "20251231T000000")
    current = clean.silver_current(lake, "pos_transactions")
    assert rows(current, "transaction_id", "sale_amount") == [(1, 99.0)] and "_loaded_at" not in current.columns


def test_snapshots_do_not_need_a_committer_file(spark, lake, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    lake.publish(df, "d")
    base = tmp_path / "lake" / "warehouse" / "d"
    (base / "v=1" / "_SUCCESS").unlink()
    (base / "v=2").mkdir()  # a write that never came to its end
    lake.publish(df.unionByName(df), "d")
    assert lake.snapshot("d", df.schema).count() == 2 and sorted(p.name for p in base.iterdir()) == ["v=1", "v=2", "v=3"]


def test_kinds_are_decided_by_all_values(spark):
    df = spark.createDataFrame([(i, f"2024-01-0{i}" if i < 6 else "junk") for i in range(1, 21)], "n int, d string")
    got = profile(df).first()
    assert (got.date_fields, got.categorical_fields) == ([], ["d"])


def test_inverted_versions_of_one_large_key(spark):
    day = lambda i: datetime(2020, 1, 1 + i)
    versions = [("k", day(i % 20), day((i * 7) % 25)) for i in range(60)]
    df = spark.createDataFrame(versions, "k string, effective_date timestamp_ntz, end_date timestamp_ntz")
    want = sum(a[1] < b[2] and b[1] < a[2] for i, a in enumerate(versions) for b in versions[:i])
    assert [tuple(r) for r in overlap_pairs(df, "k").collect()] == [("k", want)]


def test_keys_in_many_buckets(spark):
    got = assign_sk(spark.range(500).select(F.col("id").alias("k")), "sk", ["k"], start=10, buckets=13)
    assert sorted(r.sk for r in got.collect()) == list(range(11, 511))


def test_a_cluster_must_name_its_shared_folder(spark):
    from types import SimpleNamespace

    from bazaarline.session import shared_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(
        master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda k: None)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake)


def test_two_uploads_for_one_table_are_refused(spark, lake, tmp_path):
    up = tmp_path / "clash"
    up.mkdir()
    (up / "Daily Notes.csv").write_text("foo,bar\n1,x\n")
    (up / "daily-notes.csv").write_text("foo,bar\n2,y\n")
    with pytest.raises(ValueError, match="custom_daily_notes"):
        onboard(spark, lake, str(up), "20240101-u", "2024-01-01")
    assert not spark.catalog.tableExists("custom_daily_notes") and lake.read("bronze", "uploads/Daily Notes") is None
