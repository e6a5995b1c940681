"""Steps whose cost was found to grow faster than their input: what is read, stored or shuffled, counted on small rows."""

from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from bazaarline.ledger import Ledger
from bazaarline.operators import skew
from bazaarline.operators.profile import profile
from bazaarline.plans import gold_deltas
from bazaarline.plans.medallion import extract
from bazaarline.queries.registry import Feeds
from bazaarline.queries.views import VIEWS
from bazaarline.sources.incremental import Watermarks


def _watched(df, made):
    """``df`` with a column that counts how often its rows are made."""
    @F.udf("int")
    def seen(i):
        made.add(1)
        return i

    return df.withColumn("seen", seen.asNondeterministic()(F.lit(1)))


def test_hot_keys_are_found_in_full_slices_only(spark):
    df = spark.createDataFrame([(7,)] * 25 + [(i,) for i in range(20)] + [(None,)] * 9, "k int")
    assert skew._hot_keys(df, ["k"], 30) is None  # before, every key was counted by value
    assert rows(skew._hot_keys(df, ["k"], 10)) == [(7, 3)]
    assert rows(skew._hot_keys(df.where("k is null"), ["k"], 9)) == []  # no key is hot, but the rows without one are


def test_joins_without_a_hot_key_are_plain(spark):
    left = spark.createDataFrame([(i % 5, i) for i in range(50)] + [(None, 1)], "k int, v int")
    right = spark.createDataFrame([(i, -i) for i in range(4)], "k int, w int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = skew.spread_join(left, right, ["k"], "left")
        assert "salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
        assert rows(plain) == rows(skew.spread_join(left, right, ["k"], "left", hot_rows=3)) == rows(left.join(right, "k", "left").select("k", "v", "w"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_order_feed_is_the_view_with_fewer_joins_of_its_lines(spark):
    feeds = Feeds(spark, "/root/testdata/sf0.001")
    joined, text = feeds.view("erp"), feeds.sql(VIEWS["erp"])
    assert joined.schema == text.schema and joined.exceptAll(text).isEmpty() and text.exceptAll(joined).isEmpty()
    plan = joined._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = next(n for n, line in enumerate(plan) if "l_partkey" in line and "Relation" in line)
    depth = len(plan[above]) - len(plan[above].lstrip(" :+-"))
    path = [line for line in plan[:above] if "Join" in line and len(line) - len(line.lstrip(" :+-")) < depth]
    assert len([line for line in path if "l_" in line]) == 2


def test_profile_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)
    df = _watched(spark.range(40).select((F.col("id") % 10).alias("a")), made)
    assert profile(df).first()["dup_rate"] == 75.0
    assert made.value == 40


def test_extract_makes_the_rows_of_a_frame_once(spark, lake):
    made = spark.sparkContext.accumulator(0)
    data = [(i, None if i % 5 == 0 else datetime(2001, 1, 1 + i)) for i in range(1, 21)]
    df = spark.createDataFrame(data, "transaction_id bigint, timestamp timestamp_ntz")
    df = _watched(df.repartition(2), made)
    done = extract(spark, lake, {"pos_transactions": df.where("seen = 1")}, "r", Watermarks(lake), Ledger(lake))
    assert (done.rows, done.failed) == (16, 4)
    assert made.value == 40  # once for the run, once for the rows in quarantine
    made.value = 0
    done = extract(spark, lake, {"pos_transactions": df.where("seen = 1 and transaction_id % 5 > 0")}, "s", Watermarks(lake), Ledger(lake))
    assert (done.rows, done.failed, made.value) == (16, 0, 20)


def test_gold_keeps_no_copies_of_its_changes(spark, lake, monkeypatch):
    from bazaarline.operators.clean import write_silver

    stored, labels = gold_deltas.materialise, []
    monkeypatch.setattr(gold_deltas, "materialise", lambda df, label: labels.append(label) or stored(df, label))
    stock = spark.createDataFrame([(s, p, 5, 3, datetime(2024, 1, 1)) for s in (1, 2) for p in range(5)],
                                  "store_id bigint, product_id bigint, stock_level bigint, reorder_point bigint, last_restock_date timestamp_ntz")
    write_silver(lake, stock, "inventory", "run-1")
    state = gold_deltas.GoldState(lake).refresh(["run-1"])
    assert labels == ["gold-changes"]  # before: changes, delta and first rows, each a copy of all
    assert gold_deltas.GoldState(lake).read("inventory", state).count() == 10
