from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import clean
from bazaarline.operators.rows import dedup
from bazaarline.sources.files import export_csv, read_source
from conftest import rows


def test_erp_orders(spark):
    raw = spark.createDataFrame(
        [(1, "5", 10.5, "2023-01-01", "north"), (2, "invalid", None, "2023-01-02", None), (2, "10", 20.0, "2023-01-02", "south")],
        "order_id int, quantity string, unit_price double, order_date string, region string").withColumn(
        "n", F.monotonically_increasing_id())
    got = rows(clean.clean_erp_orders(raw, ["n"]), "order_id", "quantity", "unit_price", "region", "order_date")
    assert got == [(1, 5, 10.5, "NORTH", datetime(2023, 1, 1)), (2, 0, 0.0, "UNKNOWN", datetime(2023, 1, 2))]


def test_inventory_keeps_last(spark):
    raw = spark.createDataFrame(
        [(0, 1, 101, 10, "5", "2024-01-01"), (1, 1, 101, 20, "5", "2024-01-02"), (2, 2, 102, None, "10", "2024-01-03")],
        "n int, store_id int, product_id int, stock_level int, reorder_point string, last_restock_date string")
    got = rows(clean.clean_inventory(raw, ["n"]).drop("n"), "store_id", "product_id", "stock_level", "reorder_point",
               "last_restock_date")
    assert got == [(1, 101, 20, 5, datetime(2024, 1, 2)), (2, 102, 0, 10, datetime(2024, 1, 3))]


def test_bad_date_stops_orders_but_not_inventory(spark):
    bad = spark.createDataFrame([(1, "1", "soon", "x", "1")],
                                "order_id int, quantity string, order_date string, region string, unit_price string")
    with pytest.raises(Exception, match="not a date"):
        clean.clean_erp_orders(bad, ["order_id"]).collect()
    inv = spark.createDataFrame([(1, 2, 3, 4, "soon")],
                                "store_id int, product_id int, stock_level int, reorder_point int, last_restock_date string")
    assert clean.clean_inventory(inv, ["stock_level"]).first()["last_restock_date"] is None


def test_missing_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(dedup(df, ["k"], ["v"])) == [(1, 3), (None, 1)]
    assert rows(dedup(df, ["k"], ["v"], keep="last")) == [(1, 3), (None, 2)]


def test_hot_key_is_thinned_before_the_shuffle(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_csv_round_trip_with_positions(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,when\n2,"a ""q"", b",2024-01-01\n1,NA,\n2,later,2024-01-02\n')
    df = read_source(spark, str(path), position=True)
    assert rows(df, "id", "name", "when") == sorted(
        [("2", 'a "q", b', "2024-01-01"), ("1", None, None), ("2", "later", "2024-01-02")], key=repr)
    first = dedup(df, ["id"], ["_file", "_block", "_pos"])
    assert rows(first, "id", "name") == [("1", None), ("2", 'a "q", b')]
    out = export_csv(df.select("id", "name"), str(tmp_path / "out"))
    assert rows(read_source(spark, out), "id", "name") == rows(df, "id", "name")


def test_malformed_line_is_kept_aside(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\n3,4,5\n")
    got = rows(read_source(spark, str(path)), "a", "b", "_corrupt_record")
    assert got == [("1", "2", None), ("3", "4", "3,4,5")]


def test_conform_and_where_in(spark):
    df = spark.createDataFrame([(1, "x")], "Cust_ID int, nm string")
    got = clean.conform(df, {"customer_id": "Cust_ID", "customer_name": "nm"}, ["customer_id", "customer_name", "segment"])
    assert rows(got) == [(1, "x", None)]
    assert clean.where_in(got, customer_id=[2]).count() == 0
