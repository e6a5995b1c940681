import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline import schemas
from bazaarline.operators import facts, rows as rowops, scd
from bazaarline.operators.audit import IntegrityError, audit, enforce
from bazaarline.operators.keys import assign_sk
from bazaarline.operators.skew import spread_join
from bazaarline.plans.warehouse import merge_customers, merge_products
from bazaarline.session import materialise
from conftest import rows

CUST = "customer_id bigint, customer_name string, segment string, acquisition_channel string, signup_date date"
PROD = "product_id bigint, product_name string, category string, unit_price double"


def empty(spark, name):
    return spark.createDataFrame([], schemas.layout(name))


def customers(spark, *items):
    return spark.createDataFrame([(i, n, s, "Web", None) for i, n, s in items], CUST)


def test_three_versions_and_point_in_time(spark):
    dim = empty(spark, "dim_customer")
    for segment, at in (("Retail", "2024-01-01"), ("SMB", "2024-03-01"), ("Enterprise", "2024-06-01")):
        merged = merge_customers(dim, customers(spark, (10001, "Customer A", segment)), at,
                                 first_effective="2024-01-01 00:00:00")
        dim = materialise(merged, "dim")
    mine = rows(dim.filter("customer_id = 10001"), "segment", "effective_date", "end_date", "is_current")
    assert mine == [("Enterprise", datetime(2024, 6, 1), None, True),
                    ("Retail", datetime(2024, 1, 1), datetime(2024, 3, 1), False),
                    ("SMB", datetime(2024, 3, 1), datetime(2024, 6, 1), False)]
    assert rows(dim.filter("customer_sk = 1"), "customer_id", "customer_name") == [(99999, "Walk-in Customer")]
    product = materialise(merge_products(empty(spark, "dim_product"), spark.createDataFrame(
        [(20001, "Cloud Compute Instance", "Cloud", 100.0)], PROD), "2024-01-01"), "prod")
    orders = spark.createDataFrame(
        [(50001, 10001, 20001, 2, datetime(2024, 2, 15, 10), "W", 100.0),
         (50002, 10001, 20001, 1, datetime(2024, 4, 10), "W", 100.0),
         (50003, 10001, 20001, 3, datetime(2024, 7, 20), "W", 100.0),
         (50004, 4711, 20001, 3, datetime(2024, 7, 20), "W", 100.0),
         (50005, 10001, 99, 3, datetime(2024, 7, 20), "W", 100.0)],
        schemas.layout("erp_orders").simpleString()[7:-1].replace(":", " "))  # struct<a:b> as DDL
    calendar = facts.calendar((orders, "order_date"))
    fact = facts.fact_orders(orders, product, dim, calendar)
    named = rows(fact.join(dim, "customer_sk"), "order_id", "segment", "total_amount", "date_id")
    assert named == [(50001, "Retail", 200.0, 20240215), (50002, "SMB", 100.0, 20240410),
                     (50003, "Enterprise", 300.0, 20240720), (50004, "Retail", 300.0, 20240720)]
    again = facts.fact_orders(orders, product, dim, calendar, existing=fact)
    assert again.count() == 0


def test_null_is_no_change_unless_asked(spark):
    dim = materialise(merge_customers(empty(spark, "dim_customer"), customers(spark, (5, "A", "Retail")), "2024-01-01"), "d")
    gone = customers(spark, (5, "A", None))
    assert merge_customers(dim, gone, "2024-02-01").filter("customer_id = 5").count() == 1
    assert merge_customers(dim, gone, "2024-02-01", null_safe=True).filter("customer_id = 5").count() == 2


def test_price_tolerance_and_absent_keys(spark):
    first = spark.createDataFrame([(1, "a", "c", 10.0), (2, "b", "c", 5.0)], PROD)
    dim = materialise(merge_products(empty(spark, "dim_product"), first, "2024-01-01"), "p")
    near = spark.createDataFrame([(1, "a", "c", 10.0005)], PROD)
    assert merge_products(dim, near, "2024-02-01").count() == 2
    far = spark.createDataFrame([(1, "a", "c", 10.01)], PROD)
    merged = merge_products(dim, far, "2024-02-01")
    assert rows(merged, "product_id", "is_current") == [(1, False), (1, True), (2, True)]
    assert merged.select("product_sk").distinct().count() == 3


def test_merge_twice_changes_nothing(spark):
    batch = customers(spark, *[(i, f"N{i}", "Retail") for i in range(50)])
    dim = materialise(merge_customers(empty(spark, "dim_customer"), batch, "2024-01-01"), "d")
    assert rows(merge_customers(dim, batch, "2024-02-01")) == rows(dim)


def test_random_histories_never_overlap(spark):
    rng = random.Random(3)
    dim = empty(spark, "dim_customer")
    for month in range(1, 6):
        batch = customers(spark, *[(k, "N", rng.choice("ABC")) for k in range(40) if rng.random() < 0.7])
        dim = materialise(merge_customers(dim, batch, f"2024-0{month}-01"), "d")
    assert scd.overlap_pairs(dim, "customer_id").count() == 0
    current = dim.filter("is_current").groupBy("customer_id").count()
    assert current.filter("count > 1").count() == 0
    sks = [r[0] for r in dim.select("customer_sk").collect()]
    assert sorted(sks) == list(range(1, len(sks) + 1))


@pytest.mark.parametrize("seed", range(4))
def test_overlap_pairs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for sk in range(120):
        start, length = rng.randint(1, 27), rng.choice([-3, 0, 0, 1, 2, 5, None])
        day = lambda d: datetime(2024, 1 + (d - 1) // 28, 1 + (d - 1) % 28, rng.choice([0, 12]))
        begin = day(start)
        end = None if length is None else (begin if length == 0 else day(max(1, start + length)))
        data.append((sk, rng.choice([1, 2, None]), begin, end))
    far = datetime(9999, 12, 31, 23, 59, 59)
    want = {}
    for a in data:
        for b in data:
            if a[0] < b[0] and a[1] == b[1] is not None and a[1] is not None and a[2] < (b[3] or far) and (a[3] or far) > b[2]:
                want[a[1]] = want.get(a[1], 0) + 1
    dim = spark.createDataFrame(data, "sk int, k int, effective_date timestamp_ntz, end_date timestamp_ntz")
    assert rows(scd.overlap_pairs(dim, "k")) == sorted(want.items())


def test_overlaps_of_short_histories_are_compared_in_place(spark, monkeypatch):
    at = lambda d: datetime(2024, 1, d)
    data = [(1, at(1), None), (1, at(5), at(3)), (1, at(4), at(9)), (1, at(4), at(4)), (2, at(1), at(2)), (2, at(2), None),
            (None, at(1), None), (None, at(1), None), (3, None, at(5)), (3, at(1), at(9)), (4, at(2), at(8)), (4, at(2), at(8))]
    dim = spark.createDataFrame(data, "k int, effective_date timestamp_ntz, end_date timestamp_ntz")
    swept = rows(scd.overlap_pairs(dim, "k", wide=0))
    assert swept == rows(scd.overlap_pairs(dim, "k", wide=2)) == [(1, 3), (4, 1)]

    def never(*_):
        raise AssertionError("short histories were swept")

    monkeypatch.setattr(scd, "running_by_instant", never)
    assert rows(scd.overlap_pairs(dim, "k")) == swept


def test_overlaps_of_very_many_inverted_versions(spark):
    """10^5 versions that end before they start beside 10^5 others of the same key: 10^10 pairs, were they compared."""
    n = 100_000
    at = lambda minutes: F.timestamp_seconds(1_700_000_000 + 60 * minutes).cast("timestamp_ntz")
    i = F.col("id")
    inverted = spark.range(n).select(F.lit(1).alias("k"), at(i + 1).alias("effective_date"), at(i).alias("end_date"))
    proper = spark.range(n).select(F.lit(1).alias("k"), at(F.lit(-1)).alias("effective_date"), at(i).alias("end_date"))
    other = spark.createDataFrame([(2, datetime(2024, 1, 1), None), (2, datetime(2024, 2, 1), None)],
                                  "k int, effective_date timestamp_ntz, end_date timestamp_ntz")
    got = dict(rows(scd.overlap_pairs(inverted.unionByName(proper).unionByName(other), "k")))
    # an inverted version i meets the others that end after minute i + 1; those all meet one another
    assert got == {1: sum(n - 1 - (j + 1) for j in range(n - 1)) + n * (n - 1) // 2, 2: 1}


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(1)
    left = spark.createDataFrame([(i, rng.choice([7, 7, 7, 1, 2, 3, None])) for i in range(400)], "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}-{n}") for k in (1, 2, 7) for n in range(2)], "k int, v string")
    plain = {how: rows(left.join(right, "k", how), "i", "k", "v") for how in ("inner", "left")}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for how in ("inner", "left"):
            salted = spread_join(left, right, ["k"], how, hot_rows=50)
            assert rows(salted, "i", "k", "v") == plain[how]
            assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_surrogate_keys_are_dense_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = rows(assign_sk(df, "sk", ["k"], start=10), "k", "sk")
    two = rows(assign_sk(df.repartition(7), "sk", ["k"], start=10), "k", "sk")
    assert one == two and sorted(s for _, s in one) == list(range(11, 5011))


def test_audit_and_gate(spark):
    dim_c = spark.createDataFrame(
        [(1, 5, datetime(2024, 1, 1), None, True), (2, 5, datetime(2024, 2, 1), None, True)],
        "customer_sk bigint, customer_id bigint, effective_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    dim_p = spark.createDataFrame(
        [(1, 5, datetime(2024, 1, 1), None, True)],
        "product_sk bigint, product_id bigint, effective_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    sales = spark.createDataFrame([(1, None), (2, 1)], "transaction_id int, product_sk bigint")
    orders = spark.createDataFrame([(1, 1, None)], "order_id int, customer_sk bigint, product_sk bigint")
    checks = audit(sales, orders, dim_c, dim_p)
    assert dict(rows(checks)) == {
        "orphan_sales_prod": 1, "orphan_orders_cust": 0, "orphan_orders_prod": 1, "overlapping_cust": 1,
        "overlapping_prod": 0, "dup_cust": 1, "dup_prod": 0}
    with pytest.raises(IntegrityError):
        enforce(checks)


def test_upsert_and_unseen(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(rowops.upsert(old, new, ["k"])) == [(1, "a"), (2, None), (3, "c")]
    assert rows(rowops.insert_absent(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(rowops.unseen(new, old, ["k"])) == [(3, "c")]


def test_growth(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 5.0), (4, 10.0), (5, 0.0)], "d int, v double")
    got = [r.g for r in rowops.pct_change(df, "d", "v", "g").orderBy("d").collect()]
    assert got == [0.0, 0.0, float("inf"), 100.0, -100.0]


def test_lookups_read_the_facts_few_times(spark, monkeypatch):
    import re

    import __spark_entry__ as entry
    from bazaarline.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, most in (("rpt13_point_in_time_proof", 4), ("wh07_fact_orders", 3)):
            plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
            assert len(re.findall(r"l_orderkey#\d+L?[^\n]*\] parquet", plan)) <= most
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
